"""The same queries as DuckDB SQL, written with plain window frames and interval joins."""

from __future__ import annotations

from catalog.inputs import SPLIT, STEP_DAY, TICKERS
from streakline.config import FIELDS
from streakline.families import AVERAGE, FAMILIES, HIGH_LOW, MOVING_AVG, BucketFamily
from streakline.schemas import wide_column

ORACLES: dict[str, str] = {}

ORDER_BARS = """
bars AS (
  SELECT o_orderpriority AS stock,
         CAST(o_orderdate + CASE isodow(o_orderdate) WHEN 6 THEN INTERVAL 2 DAY WHEN 7 THEN INTERVAL 1 DAY
              ELSE INTERVAL 0 DAY END AS DATE) AS stock_valuation_date,
         CAST(arg_min(o_totalprice, o_orderkey) AS DECIMAL(12,4)) AS open_value,
         CAST(max(o_totalprice) AS DECIMAL(12,4)) AS high_value,
         CAST(min(o_totalprice) AS DECIMAL(12,4)) AS low_value,
         CAST(arg_max(o_totalprice, o_orderkey) AS DECIMAL(12,4)) AS close_value,
         CAST(count(*) AS DECIMAL(18,0)) AS volume_value
  FROM orders GROUP BY 1, 2)"""

PART_BARS = """
ticks AS (
  SELECT CAST(l_partkey AS VARCHAR) AS stock, CAST(l_shipdate AS DATE) AS stock_valuation_date,
         l_extendedprice AS price, CAST(l_quantity AS DECIMAL(18,0)) AS size,
         row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS tick
  FROM lineitem),
bars AS (
  SELECT stock, stock_valuation_date,
         CAST(arg_min(price, tick) AS DECIMAL(12,4)) AS open_value,
         CAST(max(price) AS DECIMAL(12,4)) AS high_value,
         CAST(min(price) AS DECIMAL(12,4)) AS low_value,
         CAST(arg_max(price, tick) AS DECIMAL(12,4)) AS close_value,
         CAST(sum(size) AS DECIMAL(18,0)) AS volume_value
  FROM ticks GROUP BY 1, 2)"""

EVENT_BARS = """
bars AS (
  SELECT event_type AS stock, CAST(ts AS DATE) AS stock_valuation_date,
         CAST(arg_max(value, event_id) AS DECIMAL(12,4)) AS close_value
  FROM events GROUP BY 1, 2)"""

CLASSIFIED = """
measured AS (
  SELECT stock, stock_valuation_date, close_value AS stock_value,
         min(close_value) OVER w AS minimum_value, max(close_value) OVER w AS maximum_value,
         CAST(sum(CAST(close_value * 10000 AS BIGINT)) OVER w90 AS DOUBLE) / (count(close_value) OVER w90 * 10000.0::DOUBLE) AS avg_90,
         stddev_samp(CAST(close_value AS DOUBLE)) OVER w90 AS stddev_90,
         CAST(sum(CAST(close_value * 10000 AS BIGINT)) OVER w50 AS DOUBLE) / (count(close_value) OVER w50 * 10000.0::DOUBLE) AS avg_short,
         CAST(sum(CAST(close_value * 10000 AS BIGINT)) OVER w200 AS DOUBLE) / (count(close_value) OVER w200 * 10000.0::DOUBLE) AS avg_long,
         CAST(sum(close_value) OVER w50 AS DECIMAL(24,4)) * CAST(count(close_value) OVER w200 AS DECIMAL(9,0)) AS crossed_short,
         CAST(sum(close_value) OVER w200 AS DECIMAL(24,4)) * CAST(count(close_value) OVER w50 AS DECIMAL(9,0)) AS crossed_long
  FROM bars
  WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w50 AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w90 AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)),
bucketed AS (
  SELECT *,
         CASE WHEN maximum_value = minimum_value THEN 'mid_range'
              WHEN stock_value - minimum_value <= 0.20 * (maximum_value - minimum_value) THEN 'near_record_low'
              WHEN stock_value - minimum_value <= 0.40 * (maximum_value - minimum_value) THEN 'lower_range'
              WHEN stock_value - minimum_value <= 0.60 * (maximum_value - minimum_value) THEN 'mid_range'
              WHEN stock_value - minimum_value <= 0.87 * (maximum_value - minimum_value) THEN 'higher_range'
              ELSE 'near_record_high' END AS highest_lowest_valuation,
         CASE WHEN CAST(stock_value AS DOUBLE) < avg_90 - stddev_90 THEN 'below'
              WHEN CAST(stock_value AS DOUBLE) > avg_90 + stddev_90 THEN 'above'
              ELSE 'within' END AS average_valuation,
         CASE WHEN crossed_short > crossed_long THEN 'bullish_alignment' ELSE 'bearish_alignment' END AS moving_avg_comparison
  FROM measured),
flagged AS (
  SELECT *,
         CASE WHEN highest_lowest_valuation = lag(highest_lowest_valuation) OVER w THEN 0 ELSE 1 END AS new_1,
         CASE WHEN average_valuation = lag(average_valuation) OVER w THEN 0 ELSE 1 END AS new_2,
         CASE WHEN moving_avg_comparison = lag(moving_avg_comparison) OVER w THEN 0 ELSE 1 END AS new_3
  FROM bucketed WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date)),
days AS (
  SELECT *,
         CAST(sum(new_1) OVER w AS BIGINT) AS high_low_streak_run,
         CAST(sum(new_2) OVER w AS BIGINT) AS average_streak_run,
         CAST(sum(new_3) OVER w AS BIGINT) AS moving_avg_streak_run
  FROM flagged
  WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

CLASSIFIED_SELECT = """
SELECT stock, stock_valuation_date, stock_value, minimum_value, maximum_value, avg_90,
       round(stddev_90, 4) AS stddev_90, avg_short, avg_long,
       highest_lowest_valuation, average_valuation, moving_avg_comparison,
       high_low_streak_run, average_streak_run, moving_avg_streak_run
FROM days"""

SNAPSHOT_COLUMNS = """md5(CAST(stock_valuation_date AS VARCHAR) || '-' || stock) AS id,
       stock_valuation_date, stock, stock_value, highest_lowest_valuation,
       minimum_value AS minimum_close, maximum_value AS maximum_close, average_valuation, moving_avg_comparison"""

LAST_SNAPSHOT = f"""SELECT {SNAPSHOT_COLUMNS} FROM days
QUALIFY row_number() OVER (PARTITION BY stock ORDER BY stock_valuation_date DESC) = 1"""

UPSERTED = """SELECT * FROM metric m WHERE NOT EXISTS
(SELECT 1 FROM advanced a WHERE a.stock = m.stock AND a.start_date = m.start_date)
UNION ALL SELECT * FROM advanced"""

METRIC_ID = "md5(CAST(start_date AS VARCHAR) || '-' || stock) AS id"


# The ids of the buckets, spelled out so that a wrong one in the library shows.
DIMS = {
    "high_low": "(1, 'near_record_low'), (2, 'lower_range'), (3, 'mid_range'), (4, 'higher_range'), (5, 'near_record_high')",
    "average": "(1, 'above'), (2, 'below'), (3, 'within')",
    "moving_avg": "(1, 'bullish_alignment'), (2, 'bearish_alignment')",
}


def _dim(family: BucketFamily, name: str = "dim") -> str:
    return f"\n{name}(id, bucket_name) AS (VALUES {DIMS[family.name]})"


def _metric(family: BucketFamily, source: str = "days", name: str = "metric", dim: str = "dim") -> str:
    return f"""
{name}_streaks AS (
  SELECT stock, {family.bucket_column}, min(stock_valuation_date) AS start_date, max(stock_valuation_date) AS end_date,
         CAST(date_diff('day', min(stock_valuation_date), max(stock_valuation_date)) + 1 AS INTEGER) AS day_length
  FROM {source} GROUP BY stock, {family.run_column}, {family.bucket_column}),
{name} AS (
  SELECT {METRIC_ID}, stock, CAST({dim}.id AS INTEGER) AS {family.key_column}, start_date, end_date, day_length
  FROM {name}_streaks JOIN {dim} ON {family.bucket_column} = bucket_name)"""


OLD_DAYS = f"\nold_days AS (SELECT * FROM days WHERE stock_valuation_date < DATE '{SPLIT}')"
FIRST_NEW = f"""
first_new AS (
  SELECT * FROM days WHERE stock_valuation_date >= DATE '{SPLIT}'
  QUALIFY row_number() OVER (PARTITION BY stock ORDER BY stock_valuation_date) = 1)"""


def _with(*parts: str, select: str) -> str:
    return "WITH RECURSIVE" + ",".join(parts) + "\n" + select.strip()


def order(name: str, select: str, *parts: str) -> None:
    ORACLES[name] = _with(ORDER_BARS, *parts, select=select)


def part(name: str, select: str, *parts: str) -> None:
    ORACLES[name] = _with(PART_BARS, *parts, select=select)


def _quoted(field: str, ticker: str) -> str:
    return f'"{wide_column(field, ticker)}"'


# --- scans, landing, dimensions -------------------------------------------------------------------

BAR_COLUMNS = "stock, stock_valuation_date, open_value, high_value, low_value, close_value, volume_value"
order("order_bars", "SELECT * FROM bars")
part("part_bars", "SELECT * FROM bars")
order(
    "bars_in_range",
    f"""SELECT * FROM bars WHERE stock_valuation_date >= DATE '1997-01-01' AND stock_valuation_date < DATE '1998-01-01'
    AND stock IN ('{TICKERS[0]}', '{TICKERS[1]}')""",
)
order("bars_full_history", "SELECT * FROM bars")
order("bars_yesterday", "SELECT * FROM bars WHERE stock_valuation_date = DATE '2000-01-04'")

_wide_columns = ",\n         ".join(
    f"coalesce(CAST(max(CASE WHEN stock = '{t}' THEN {f}_value END) AS VARCHAR), '') AS {_quoted(f, t)}"
    for f in FIELDS
    for t in TICKERS
)
WIDE = f"""
wide AS (
  SELECT CAST(stock_valuation_date AS VARCHAR) AS date,
         {_wide_columns}
  FROM bars GROUP BY 1)"""


def _landed(ticker: str, position: int) -> str:
    close, opened, volume = (_quoted(f, ticker) for f in ("close", "open", "volume"))
    nan = f"WHEN day(CAST(date AS DATE)) = 7 AND {close} <> '' THEN 'nan' " if position == 0 else ""
    stale = f"WHEN day(CAST(date AS DATE)) % 10 = 0 AND ingest_seq = 1 THEN {opened} "
    kept = ", ".join(_quoted(f, ticker) for f in ("high", "low", "open"))
    return (
        f"CASE {nan}{stale}ELSE {close} END AS {close}, {kept}, "
        f"CASE WHEN {volume} <> '' THEN {volume} || '.0' ELSE '' END AS {volume}"
    )


STAGING = f"""
copies AS (
  SELECT *, CAST(unnest(CASE WHEN day(CAST(date AS DATE)) % 10 = 0 THEN [1, 2] ELSE [1] END) AS BIGINT) AS ingest_seq FROM wide),
staging AS (
  SELECT date, ingest_seq, {", ".join(_landed(t, i) for i, t in enumerate(TICKERS))} FROM copies)"""

DEDUPED = "\ndeduped AS (SELECT * FROM staging QUALIFY row_number() OVER (PARTITION BY date ORDER BY ingest_seq DESC) = 1)"

_melted = "\n  UNION ALL ".join(
    f"SELECT date, '{t}' AS stock, " + ", ".join(f"{_quoted(f, t)} AS {f}" for f in FIELDS) + " FROM deduped" for t in TICKERS
)
LONG_TEXT = f"\nlong_text AS ({_melted})"
LIVE = """
live AS (
  SELECT md5(date || '-' || stock) AS id, CAST(date AS DATE) AS stock_valuation_date, stock,
         TRY_CAST(nullif(trim("close"), '') AS DECIMAL(12,4)) AS close_value,
         TRY_CAST(nullif(trim(high), '') AS DECIMAL(12,4)) AS high_value,
         TRY_CAST(nullif(trim(low), '') AS DECIMAL(12,4)) AS low_value,
         TRY_CAST(nullif(trim(open), '') AS DECIMAL(12,4)) AS open_value,
         TRY_CAST(nullif(trim(volume), '') AS DECIMAL(18,0)) AS volume_value
  FROM long_text)"""

LANDED = (WIDE, STAGING, DEDUPED, LONG_TEXT, LIVE)

order("last_saved_date", "SELECT max(CAST(date AS DATE)) AS max_date FROM staging", WIDE, STAGING)
order(
    "next_business_day_slice",
    f"""SELECT * FROM bars WHERE stock_valuation_date = (
      SELECT min(stock_valuation_date) FROM bars WHERE isodow(stock_valuation_date) < 6 AND stock_valuation_date >= (
        SELECT CAST(max(stock_valuation_date) + CASE isodow(max(stock_valuation_date)) WHEN 5 THEN INTERVAL 3 DAY
               WHEN 6 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS DATE)
        FROM bars WHERE stock_valuation_date < DATE '{SPLIT}'))""",
)
order("pivot_wide", "SELECT * FROM wide", WIDE)
order("wide_csv_roundtrip", "SELECT * FROM wide", WIDE)
order("append_rows", "SELECT * FROM bars")
for _name, _family in (("dim_high_low", HIGH_LOW), ("dim_average", AVERAGE), ("dim_moving_avg", MOVING_AVG)):
    order(
        _name,
        f"""SELECT CAST(dim.id AS INTEGER) AS id, bucket_name, day_count FROM dim LEFT JOIN
        (SELECT {_family.bucket_column} AS bucket_name, count(*) AS day_count FROM days GROUP BY 1) USING (bucket_name)""",
        CLASSIFIED,
        _dim(_family),
    )

# --- landing to live ------------------------------------------------------------------------------

order("dedup_by_date", "SELECT * FROM deduped", WIDE, STAGING, DEDUPED)
order("unpivot_live", "SELECT * FROM long_text", *LANDED)
order("typed_bars", "SELECT * FROM live", *LANDED)
_faults = " UNION ALL ".join(
    f"""SELECT date, stock, '{f}' AS field, "{f}" AS raw_value FROM long_text
    WHERE nullif(trim("{f}"), '') IS NOT NULL AND TRY_CAST("{f}" AS DECIMAL(18,4)) IS NULL"""
    for f in FIELDS
)
order("rejected_rows", _faults, *LANDED)
order("surrogate_key", "SELECT md5(CAST(stock_valuation_date AS VARCHAR) || '-' || stock) AS id, stock, stock_valuation_date FROM bars")
order(
    "incremental_filter",
    f"SELECT * FROM bars WHERE stock = '{TICKERS[0]}' OR stock_valuation_date > "
    f"(SELECT max(b.stock_valuation_date) FROM bars b WHERE b.stock = bars.stock AND b.stock_valuation_date < DATE '{SPLIT}')",
)
_kept = "stock, stock_valuation_date, open_value, high_value, low_value, close_value"
order(
    "upsert_live",
    f"""SELECT {_kept}, CAST(CASE WHEN stock_valuation_date >= DATE '1999-01-01' THEN volume_value + 1
    ELSE volume_value END AS DECIMAL(18,0)) AS volume_value FROM bars""",
)
order(
    "upsert_live_append_only",
    f"""SELECT {_kept}, CAST(CASE WHEN stock_valuation_date >= DATE '{SPLIT}' THEN volume_value + 1
    ELSE volume_value END AS DECIMAL(18,0)) AS volume_value FROM bars""",
)
order("ingest", "SELECT * FROM live", *LANDED)
order(
    "late_rows",
    f"""SELECT * FROM bars WHERE day(stock_valuation_date) = 12 AND stock_valuation_date <=
    (SELECT max(b.stock_valuation_date) FROM bars b WHERE b.stock = bars.stock
     AND b.stock_valuation_date < DATE '{SPLIT}' AND day(b.stock_valuation_date) <> 12)""",
)

PART_LIVE = """
live AS (
  SELECT md5(CAST(stock_valuation_date AS VARCHAR) || '-' || stock) AS id, stock_valuation_date, stock,
         CASE WHEN day(stock_valuation_date) = 7 AND stock LIKE '%7' THEN NULL ELSE close_value END AS close_value,
         high_value, low_value, open_value, volume_value FROM bars),
marked AS (
  SELECT *, stock_valuation_date < DATE '2000-01-01' AND day(stock_valuation_date) <> 12 AS known,
         max(CASE WHEN stock_valuation_date < DATE '2000-01-01' AND day(stock_valuation_date) <> 12 THEN stock_valuation_date END)
           OVER (PARTITION BY stock) AS high_water FROM live)"""
_live = "id, stock_valuation_date, stock, {} AS close_value, high_value, low_value, open_value, volume_value"
_raised = "CAST(CASE WHEN known AND day(stock_valuation_date) = 14 THEN close_value + 1 ELSE close_value END AS DECIMAL(12,4))"
part(
    "part_ingest",
    f"SELECT {_live.format(_raised)} FROM marked WHERE known OR high_water IS NULL OR stock_valuation_date > high_water",
    PART_LIVE,
)
part(
    "part_late_rows",
    f"""SELECT {_live.format("close_value")} FROM marked
    WHERE stock_valuation_date <= high_water AND (NOT known OR day(stock_valuation_date) = 14)""",
    PART_LIVE,
)
part(
    "part_rejected_rows",
    """SELECT CAST(stock_valuation_date AS VARCHAR) AS date, stock, 'close' AS field, 'nan' AS raw_value FROM bars
    WHERE day(stock_valuation_date) = 7 AND stock LIKE '%7'
    UNION ALL SELECT blank, stock, 'date', blank FROM
      (SELECT DISTINCT stock, CASE WHEN CAST(stock AS BIGINT) % 2 = 1 THEN ' ' END AS blank,
              open_value, high_value, low_value, close_value, volume_value FROM bars WHERE day(stock_valuation_date) = 15)""",
)
part(
    "part_landed_balance",
    """, dateless AS (SELECT DISTINCT stock, open_value, high_value, low_value, close_value, volume_value FROM bars
      WHERE day(stock_valuation_date) = 15),
    kinds AS (SELECT CASE WHEN high_water IS NULL OR stock_valuation_date > high_water THEN 'new' WHEN NOT known THEN 'behind'
                          WHEN day(stock_valuation_date) = 14 THEN 'restated' ELSE 'unchanged' END AS outcome FROM marked)
    SELECT outcome, count(*) AS n FROM kinds GROUP BY outcome
    UNION ALL SELECT 'dateless', count(*) FROM dateless
    UNION ALL SELECT 'landed', (SELECT count(*) FROM dateless) + (SELECT count(*) FROM bars)""",
    PART_LIVE,
)
part(
    "part_upsert_live",
    f"""SELECT {_kept}, CAST(CASE WHEN stock_valuation_date >= DATE '1999-01-01' THEN volume_value + 1
    ELSE volume_value END AS DECIMAL(18,0)) AS volume_value FROM bars""",
)

# --- indicators and classifiers -------------------------------------------------------------------

_value = "stock, stock_valuation_date, stock_value AS close_value"
order("record_extremes", f"SELECT {_value}, minimum_value, maximum_value FROM measured", CLASSIFIED)
order("rolling_avg_stddev", f"SELECT {_value}, avg_90, round(stddev_90, 4) AS stddev_90 FROM measured", CLASSIFIED)
order("moving_averages", f"SELECT {_value}, avg_short, avg_long FROM measured", CLASSIFIED)
order("classified", CLASSIFIED_SELECT, CLASSIFIED)
part("part_classified", CLASSIFIED_SELECT, CLASSIFIED)
order("classified_increment", f"{CLASSIFIED_SELECT} WHERE stock_valuation_date >= DATE '{SPLIT}'", CLASSIFIED)
order("last_snapshot", LAST_SNAPSHOT, CLASSIFIED)
for _name, _family in (("classify_high_low", HIGH_LOW), ("classify_average", AVERAGE), ("classify_crossover", MOVING_AVG)):
    order(_name, f"SELECT stock, stock_valuation_date, {_family.bucket_column} FROM days", CLASSIFIED)
order(
    "classify_high_low_custom",
    """SELECT stock, stock_valuation_date,
         CASE WHEN maximum_value = minimum_value THEN 'mid_range'
              WHEN stock_value - minimum_value <= 0.10 * (maximum_value - minimum_value) THEN 'near_record_low'
              WHEN stock_value - minimum_value <= 0.25 * (maximum_value - minimum_value) THEN 'lower_range'
              WHEN stock_value - minimum_value <= 0.50 * (maximum_value - minimum_value) THEN 'mid_range'
              WHEN stock_value - minimum_value <= 0.80 * (maximum_value - minimum_value) THEN 'higher_range'
              ELSE 'near_record_high' END AS highest_lowest_valuation FROM measured""",
    CLASSIFIED,
)
order(
    "bucket_position",
    """SELECT stock, stock_valuation_date, CASE WHEN maximum_value > minimum_value THEN
       CAST(stock_value - minimum_value AS DOUBLE) / CAST(maximum_value - minimum_value AS DOUBLE) END AS bucket_position
       FROM measured""",
    CLASSIFIED,
)
ORACLES["next_business_day"] = """
SELECT o_orderkey, CAST(o_orderdate + CASE isodow(o_orderdate) WHEN 5 THEN INTERVAL 3 DAY WHEN 6 THEN INTERVAL 2 DAY
       ELSE INTERVAL 1 DAY END AS DATE) AS next_business_day FROM orders"""
ORACLES["prev_business_day"] = """
SELECT o_orderkey, CAST(o_orderdate - CASE isodow(o_orderdate) WHEN 1 THEN INTERVAL 3 DAY
       ELSE INTERVAL 1 DAY END AS DATE) AS prev_business_day FROM orders"""

# --- streaks, marts, increments -------------------------------------------------------------------


def _increment(family: BucketFamily, old: str = OLD_DAYS, fresh: str = FIRST_NEW) -> tuple[str, ...]:
    key = family.key_column
    return (
        CLASSIFIED,
        old,
        fresh,
        _dim(family),
        _metric(family, "old_days"),
        f"""
open_rows AS (SELECT * FROM metric QUALIFY row_number() OVER (PARTITION BY stock ORDER BY start_date DESC) = 1),
snapshot AS (SELECT stock, stock_valuation_date, stock_value, {family.bucket_column}, CAST(dim.id AS INTEGER) AS day_key
             FROM first_new JOIN dim ON {family.bucket_column} = bucket_name),
extended AS (
  SELECT t.id, t.stock, t.{key}, t.start_date, s.stock_valuation_date AS end_date,
         CAST(date_diff('day', t.start_date, s.stock_valuation_date) + 1 AS INTEGER) AS day_length
  FROM open_rows t JOIN snapshot s ON t.stock = s.stock AND t.{key} = s.day_key),
switched AS (
  SELECT t.* FROM open_rows t JOIN snapshot s ON t.stock = s.stock AND t.{key} <> s.day_key
  UNION ALL
  SELECT md5(CAST(s.stock_valuation_date AS VARCHAR) || '-' || s.stock), s.stock, s.day_key,
         s.stock_valuation_date, s.stock_valuation_date, 1
  FROM open_rows t JOIN snapshot s ON t.stock = s.stock AND t.{key} <> s.day_key),
opened AS (
  SELECT md5(CAST(s.stock_valuation_date AS VARCHAR) || '-' || s.stock), s.stock, s.day_key,
         s.stock_valuation_date, s.stock_valuation_date, 1
  FROM snapshot s WHERE s.stock NOT IN (SELECT stock FROM open_rows)),
advanced AS (SELECT * FROM extended UNION ALL SELECT * FROM switched UNION ALL SELECT * FROM opened)""",
    )


for _family in FAMILIES:
    _n = _family.name
    order(f"{_n}_runs", f"SELECT stock, stock_valuation_date, {_family.bucket_column}, {_family.run_column} FROM days", CLASSIFIED)
    order(f"{_n}_streaks", "SELECT * FROM metric_streaks", CLASSIFIED, _dim(_family), _metric(_family))
    order(f"{_n}_metric_full", "SELECT * FROM metric", CLASSIFIED, _dim(_family), _metric(_family))
    part(f"part_{_n}_metric_full", "SELECT * FROM metric", CLASSIFIED, _dim(_family), _metric(_family))
    order(f"advance_{_n}", "SELECT * FROM advanced", *_increment(_family))
    order(f"upsert_streaks_{_n}", UPSERTED, *_increment(_family))
    # Advancing an old mart by all later days must give what a rebuild over all days gives.
    order(f"advance_many_days_{_n}", "SELECT * FROM metric", CLASSIFIED, _dim(_family), _metric(_family))
    order(
        f"dq_freshness_{_n}",
        f"""SELECT bars.stock, stock_valuation_date, close_value, newest_end_date FROM bars LEFT JOIN
        (SELECT stock, max(end_date) AS newest_end_date FROM metric WHERE stock <> '{TICKERS[-1]}' GROUP BY 1) USING (stock)
        WHERE newest_end_date IS NULL OR stock_valuation_date > newest_end_date""",
        CLASSIFIED,
        OLD_DAYS,
        _dim(_family),
        _metric(_family, "old_days"),
    )

HIGH_LOW_MART = (CLASSIFIED, _dim(HIGH_LOW), _metric(HIGH_LOW))
HIGH_LOW_STEP = _increment(HIGH_LOW)
ON_STEP_DAY = _increment(
    HIGH_LOW,
    f"\nold_days AS (SELECT * FROM days WHERE stock_valuation_date < DATE '{STEP_DAY}')",
    f"\nfirst_new AS (SELECT * FROM days WHERE stock_valuation_date = DATE '{STEP_DAY}')",
)

part("part_advance_many_days", "SELECT * FROM metric", *HIGH_LOW_MART)
# Days without a price have no bucket, belong to no streak and end the one before.
_gaps = """
all_bars AS (SELECT * FROM bars),
gap_days AS (
  SELECT stock, stock_valuation_date,
         CASE WHEN ((date_diff('day', DATE '1970-01-01', stock_valuation_date) * 7 + CAST(stock AS BIGINT)) % 5 + 5) % 5 <> 0
              THEN close_value END AS v
  FROM all_bars),
ranged AS (
  SELECT *, min(v) OVER w AS lo, max(v) OVER w AS hi FROM gap_days
  WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
placed AS (
  SELECT *, CASE WHEN v IS NULL THEN NULL WHEN hi = lo THEN 3 WHEN v - lo <= 0.20 * (hi - lo) THEN 1
                 WHEN v - lo <= 0.40 * (hi - lo) THEN 2 WHEN v - lo <= 0.60 * (hi - lo) THEN 3
                 WHEN v - lo <= 0.87 * (hi - lo) THEN 4 ELSE 5 END AS bucket FROM ranged),
parted AS (
  SELECT *, sum(CASE WHEN bucket = before THEN 0 ELSE 1 END) OVER (PARTITION BY stock ORDER BY stock_valuation_date) AS run
  FROM (SELECT *, lag(bucket) OVER (PARTITION BY stock ORDER BY stock_valuation_date) AS before FROM placed)),
gap_metric AS (
  SELECT md5(CAST(min(stock_valuation_date) AS VARCHAR) || '-' || stock) AS id, stock,
         CAST(bucket AS INTEGER) AS highest_lowest_valuation_key, min(stock_valuation_date) AS start_date,
         max(stock_valuation_date) AS end_date,
         CAST(date_diff('day', min(stock_valuation_date), max(stock_valuation_date)) + 1 AS INTEGER) AS day_length
  FROM parted WHERE bucket IS NOT NULL GROUP BY stock, run, bucket)"""
part("part_metric_full_null", "SELECT * FROM gap_metric", _gaps)
part("part_advance_many_days_null", "SELECT * FROM gap_metric", _gaps)
CORRECTED = PART_BARS.replace("\nbars AS", "\nraw_bars AS") + """,
bars AS (
  SELECT stock, stock_valuation_date, CAST(CASE WHEN stock LIKE '%0' AND stock_valuation_date BETWEEN DATE '1999-03-01' AND DATE '1999-04-30'
                                                THEN close_value + 1000 ELSE close_value END AS DECIMAL(12,4)) AS close_value
  FROM raw_bars)"""
ORACLES["part_corrected_streaks"] = _with(CORRECTED, *HIGH_LOW_MART, select="SELECT * FROM metric")
CORRECTED_ORDERS = ORDER_BARS.replace("\nbars AS", "\nraw_bars AS") + """,
bars AS (
  SELECT stock, stock_valuation_date, CAST(CASE WHEN stock_valuation_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-14'
                                                THEN round(close_value / CAST(2 AS DECIMAL(1,0)), 4) ELSE close_value END AS DECIMAL(12,4)) AS close_value
  FROM raw_bars)"""
for _family in FAMILIES:
    ORACLES[f"corrected_streaks_{_family.name}"] = _with(CORRECTED_ORDERS, CLASSIFIED, _dim(_family), _metric(_family), select="SELECT * FROM metric")
part("part_build_or_advance", "SELECT * FROM metric", *HIGH_LOW_MART)
for _family in FAMILIES:
    # Batches over stored state must give what a rebuild over all days gives.
    part(f"part_store_{_family.name}", "SELECT * FROM metric", CLASSIFIED, _dim(_family), _metric(_family))
order(
    "streak_extremes",
    """SELECT d.stock, highest_lowest_valuation, min(stock_valuation_date) AS start_date, max(stock_valuation_date) AS end_date,
       max(high_value) AS high_value, min(low_value) AS low_value, max(stock_value) AS highest_close,
       min(stock_value) AS lowest_close, CAST(count(*) AS INTEGER) AS trading_days,
       CAST(date_diff('day', min(stock_valuation_date), max(stock_valuation_date)) + 1 AS INTEGER) AS day_length
       FROM days d JOIN bars USING (stock, stock_valuation_date) GROUP BY d.stock, high_low_streak_run, highest_lowest_valuation""",
    CLASSIFIED,
)
order(
    "bucket_record_max",
    """SELECT stock, stock_valuation_date, highest_lowest_valuation, stock_value,
       max(stock_value) OVER (PARTITION BY stock, highest_lowest_valuation ORDER BY stock_valuation_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bucket_record_max FROM days""",
    CLASSIFIED,
)
_summary = """SELECT stock, highest_lowest_valuation_key, count(*) AS streak_count, CAST(sum(day_length) AS BIGINT) AS total_days,
       CAST(sum(day_length) AS DOUBLE) / count(*) AS average_days, max(day_length) AS longest_days FROM metric GROUP BY 1, 2"""
order("bucket_summary", _summary, *HIGH_LOW_MART)
part("part_bucket_summary", _summary, *HIGH_LOW_MART)
part("part_store_summary", _summary, *HIGH_LOW_MART)
order(
    "daily_tracking",
    f"""SELECT {BAR_COLUMNS}, lag(close_value) OVER w AS previous_close, close_value - lag(close_value) OVER w AS day_change
    FROM bars WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date)""",
)
_steps = {
    "closed_streaks": "SELECT * FROM metric WHERE end_date < (SELECT max(stock_valuation_date) - INTERVAL 1 DAY FROM first_new)",
    "trailing_streaks": "SELECT * FROM open_rows",
    "trailing_streaks_by_day": """SELECT * FROM metric WHERE end_date = (
       SELECT CAST(max(stock_valuation_date) - CASE isodow(max(stock_valuation_date))
              WHEN 1 THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END AS DATE) FROM first_new)""",
    "snapshot_with_key": """SELECT stock, stock_valuation_date, stock_value, highest_lowest_valuation,
       CAST(dim.id AS INTEGER) AS highest_lowest_valuation_key FROM days JOIN dim ON highest_lowest_valuation = bucket_name
       QUALIFY row_number() OVER (PARTITION BY stock ORDER BY stock_valuation_date DESC) = 1""",
    "extend_streaks": "SELECT * FROM extended",
    "switch_streaks": "SELECT * FROM switched",
}
for _name, _select in _steps.items():
    order(_name, _select, *ON_STEP_DAY)
    part(f"part_{_name}", _select, *ON_STEP_DAY)
part("part_advance_high_low", "SELECT * FROM advanced", *HIGH_LOW_STEP)
part("part_upsert_streaks_high_low", UPSERTED, *HIGH_LOW_STEP)
part("part_last_snapshot", LAST_SNAPSHOT, CLASSIFIED)
part("part_classified_increment", f"{CLASSIFIED_SELECT} WHERE stock_valuation_date >= DATE '{SPLIT}'", CLASSIFIED)

# --- alerts ---------------------------------------------------------------------------------------

_latest = """
latest AS (SELECT stock, highest_lowest_valuation_key, start_date, end_date, day_length FROM metric
           QUALIFY row_number() OVER (PARTITION BY stock ORDER BY start_date DESC) = 1)"""
order("latest_streak_alerts", "SELECT * FROM latest", *HIGH_LOW_MART, _latest)
part("part_latest_streak_alerts", "SELECT * FROM latest", *HIGH_LOW_MART, _latest)
order(
    "bucket_break_events",
    """SELECT *, CASE WHEN to_key > from_key THEN 'up' ELSE 'down' END AS direction FROM (
       SELECT stock, start_date AS event_date, lag(highest_lowest_valuation_key) OVER w AS from_key,
              highest_lowest_valuation_key AS to_key, lag(day_length) OVER w AS left_after_days
       FROM metric WINDOW w AS (PARTITION BY stock ORDER BY start_date)) WHERE from_key IS NOT NULL""",
    *HIGH_LOW_MART,
)
order(
    "alert_payload",
    "SELECT stock, highest_lowest_valuation_key AS valuation_key, start_date, end_date, day_length FROM latest",
    *HIGH_LOW_MART,
    _latest,
)
order(
    "alert_json",
    """SELECT '{"stock":"' || stock || '","valuation_key":' || highest_lowest_valuation_key || ',"start_date":"' || start_date
       || '","end_date":"' || end_date || '","day_length":' || day_length || '}' AS value FROM latest""",
    *HIGH_LOW_MART,
    _latest,
)
order(
    "reconcile",
    """SELECT stock, valuation_key, start_date, end_date, day_length,
       CAST(count(*) FILTER (side = 1) AS BIGINT) AS expected_copies, CAST(count(*) FILTER (side = 2) AS BIGINT) AS delivered_copies
       FROM (SELECT stock, highest_lowest_valuation_key AS valuation_key, start_date, end_date, day_length, 1 AS side FROM metric
             UNION ALL SELECT stock, highest_lowest_valuation_key, start_date, end_date, day_length, 2 FROM old_metric)
       GROUP BY 1, 2, 3, 4, 5 HAVING count(*) FILTER (side = 1) <> count(*) FILTER (side = 2)""",
    *HIGH_LOW_MART,
    OLD_DAYS,
    _metric(HIGH_LOW, "old_days", "old_metric"),
)

# --- back-test ------------------------------------------------------------------------------------

_joined = """
joined AS (
  SELECT b.stock, stock_valuation_date, close_value, highest_lowest_valuation_key, start_date, end_date, day_length
  FROM bars b JOIN metric m ON b.stock = m.stock AND stock_valuation_date >= start_date AND stock_valuation_date <= end_date)"""
order("streak_days", "SELECT * FROM joined", *HIGH_LOW_MART, _joined)
part("part_streak_days", "SELECT * FROM joined", *HIGH_LOW_MART, _joined)
order(
    "wide_csv_apart",
    f"""SELECT DISTINCT CAST(stock_valuation_date AS VARCHAR) AS date, day(stock_valuation_date) NOT IN (3, 4) AS landed,
        CAST({1 + len(FIELDS) * len(TICKERS)} + CASE day(stock_valuation_date) WHEN 3 THEN -1 WHEN 4 THEN 2 ELSE 0 END AS INTEGER) AS n_fields FROM bars""",
)
part(
    "part_dq_one_pass",
    """SELECT check_name, CAST(row_count AS BIGINT) AS row_count,
       CAST(CASE WHEN check_name = 'row_count' THEN 0 ELSE row_count END AS BIGINT) AS listed_rows
       FROM (SELECT 'row_count' AS check_name, count(*) AS row_count FROM metric
             UNION ALL SELECT 'stock_not_null', 0
             UNION ALL SELECT 'end_date_not_null', count(*) FILTER (right(stock, 1) = '7') FROM metric
             UNION ALL SELECT 'highest_lowest_valuation_key_accepted', count(*) FILTER (right(stock, 1) = '3') FROM metric
             UNION ALL SELECT 'not_reversed', 0
             UNION ALL SELECT 'right_length', count(*) FILTER (right(stock, 1) = '5') FROM metric)""",
    *HIGH_LOW_MART,
)
part(
    "part_streak_days_all_families",
    """SELECT d.stock, stock_valuation_date, stock_value, family, valuation_key, start_date, end_date
       FROM days d JOIN spans s ON d.stock = s.stock AND stock_valuation_date >= start_date AND stock_valuation_date <= end_date""",
    CLASSIFIED,
    *(c for f in FAMILIES for c in (_dim(f, f"{f.name}_dim"), _metric(f, "days", f"{f.name}_metric", f"{f.name}_dim"))),
    "\nspans AS ("
    + " UNION ALL ".join(f"SELECT stock, '{f.name}' AS family, {f.key_column} AS valuation_key, start_date, end_date FROM {f.name}_metric" for f in FAMILIES)
    + ")",
)
ORACLES["part_trading_days"] = """
WITH ordered AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
closed AS (SELECT day FROM ordered GROUP BY day HAVING count(*) % 9 = 0),
cal AS (
  SELECT day, is_trading, CAST(sum(CASE WHEN is_trading THEN 1 ELSE 0 END) OVER (ORDER BY day) AS INTEGER) AS ordinal
  FROM (SELECT CAST(d AS DATE) AS day, isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT day FROM closed) AS is_trading
        FROM generate_series(DATE '1990-01-01', DATE '2005-12-31', INTERVAL 1 DAY) AS g(d))),
open_days AS (SELECT day, ordinal FROM cal WHERE is_trading),
per_day AS (
  SELECT c.day, c.is_trading, c.ordinal,
         (SELECT min(o.day) FROM open_days o WHERE o.day >= c.day) AS opens,
         (SELECT o.day FROM open_days o WHERE o.ordinal = c.ordinal + 2) AS settles,
         (SELECT max(o.day) FROM open_days o WHERE o.day < c.day) AS before,
         (SELECT e.ordinal FROM cal e WHERE e.day = last_day(c.day)) - c.ordinal AS left_in_month
  FROM cal c WHERE c.day IN (SELECT day FROM ordered))
SELECT o_orderkey, o.day, ordinal, is_trading, opens, settles, before, left_in_month FROM ordered o JOIN per_day p ON o.day = p.day"""
order(
    "streak_running_extremes",
    """SELECT stock, stock_valuation_date, close_value,
       min(stock_valuation_date) OVER w AS start_date, max(stock_valuation_date) OVER w AS end_date,
       min(close_value) OVER w AS running_min_close, max(close_value) OVER w AS running_max_close,
       highest_lowest_valuation_key, day_length FROM joined
       WINDOW w AS (PARTITION BY stock, start_date ORDER BY stock_valuation_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    *HIGH_LOW_MART,
    _joined,
)

_keyed = """
keyed AS (
  SELECT stock, stock_valuation_date, stock_value AS close_value, CAST(dim.id AS INTEGER) AS highest_lowest_valuation_key,
         high_low_streak_run AS streak_run
  FROM days JOIN dim ON highest_lowest_valuation = bucket_name),
looked AS (
  SELECT *, lead(stock_valuation_date) OVER w AS next_date, lead(close_value) OVER w AS next_close,
         lead(highest_lowest_valuation_key) OVER w AS next_key
  FROM keyed WINDOW w AS (PARTITION BY stock ORDER BY stock_valuation_date)),
buys AS (
  SELECT stock, stock_valuation_date AS signal_date, next_date AS trade_date, next_close AS price, streak_run
  FROM looked WHERE highest_lowest_valuation_key = 4 AND next_key = 4),
sells AS (
  SELECT stock, stock_valuation_date AS signal_date, next_date AS trade_date, next_close AS price, streak_run,
         least(close_value, next_close) AS floor_price
  FROM looked WHERE highest_lowest_valuation_key = 5 AND next_key = 5)"""
KEYED = (CLASSIFIED, _dim(HIGH_LOW), _keyed)

# The first buy of each streak and its first better sale; shares in whole thousandths, prices in 1e-4.
_traded = """
first_buys AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock, streak_run ORDER BY signal_date) AS nth FROM buys)
  WHERE nth = 1 AND price > 0),
matched AS (
  SELECT b.stock, b.signal_date AS purchase_signal_date, b.trade_date AS purchased_date, b.price AS purchased_price,
         b.streak_run AS purchase_run, min(s.signal_date) AS sale_signal_date
  FROM first_buys b LEFT JOIN sells s ON s.stock = b.stock AND s.signal_date > b.signal_date AND s.floor_price > b.price
  GROUP BY ALL),
trades AS (
  SELECT m.stock, CAST(CAST((200000000000::HUGEINT + CAST(purchased_price * 10000 AS HUGEINT)) // (2 * CAST(purchased_price * 10000 AS HUGEINT))
                            AS DECIMAL(17,0)) * 0.001 AS DECIMAL(20,3)) AS shares,
         purchase_signal_date, purchased_date, purchased_price, purchase_run, sale_signal_date, s.trade_date AS sale_date,
         s.price AS sale_unit_price, s.streak_run AS sale_run
  FROM matched m LEFT JOIN sells s ON s.stock = m.stock AND s.signal_date = m.sale_signal_date),
priced AS (SELECT *, CAST(shares * sale_unit_price AS DECIMAL(38,7)) AS sale_price FROM trades)"""

_breakdowns = """
streak_window AS (
  SELECT stock, streak_run, min(close_value) AS min_close, max(close_value) AS max_close FROM keyed GROUP BY 1, 2),
price_window AS (
  SELECT w.*, (SELECT min(stock_valuation_date) FROM keyed k WHERE k.stock = w.stock AND k.streak_run = w.streak_run
               AND k.close_value = w.min_close) AS min_date,
         (SELECT min(stock_valuation_date) FROM keyed k WHERE k.stock = w.stock AND k.streak_run = w.streak_run
               AND k.close_value = w.max_close) AS max_date
  FROM streak_window w),
purchases AS (
  SELECT t.stock, purchase_signal_date, purchased_date, purchased_price, min_close AS min_window_price, min_date AS min_price_date,
         max_close AS max_window_price, max_date AS max_price_date,
         CAST(purchased_price - min_close AS DOUBLE) / CAST(purchased_price AS DOUBLE) * 100 AS drawdown_pct
  FROM priced t JOIN price_window w ON w.stock = t.stock AND w.streak_run = t.purchase_run),
sales AS (
  SELECT t.stock, sale_signal_date, sale_date, sale_price,
         CAST(CAST(shares AS DECIMAL(20,3)) * min_close AS DECIMAL(38,7)) AS min_window_sale, min_date AS min_sale_date,
         CAST(CAST(shares AS DECIMAL(20,3)) * max_close AS DECIMAL(38,7)) AS max_window_sale, max_date AS max_sale_date,
         CAST(max_close - sale_unit_price AS DOUBLE) / CAST(sale_unit_price AS DOUBLE) * 100 AS potential_increment_pct
  FROM priced t JOIN price_window w ON w.stock = t.stock AND w.streak_run = t.sale_run)"""
BACKTEST = (*KEYED, _traded, _breakdowns)

_shown = "stock, stock_valuation_date, close_value, highest_lowest_valuation_key"
order("ticker_filter", f"SELECT {_shown} FROM keyed WHERE stock = '{TICKERS[1]}'", *KEYED)
order("next_day_lookup", f"SELECT {_shown}, next_date, next_close, next_key FROM looked", *KEYED)
order("buy_signals", "SELECT stock, signal_date, trade_date, price FROM buys", *KEYED)
order("sell_candidates", "SELECT stock, signal_date, trade_date, price, floor_price FROM sells WHERE floor_price > 400000", *KEYED)
_trips = """SELECT b.stock, b.trade_date AS purchased_date, b.price AS purchased_price,
       arg_min(s.trade_date, s.signal_date) AS sale_date, arg_min(s.price, s.signal_date) AS sale_unit_price
       FROM buys b JOIN sells s ON s.stock = b.stock AND s.signal_date > b.signal_date AND s.floor_price > b.price
       GROUP BY b.stock, b.signal_date, b.trade_date, b.price"""
order("round_trips", _trips, *KEYED)
part("part_round_trips", _trips, *KEYED)
_trade_columns = """stock, shares, purchase_signal_date, purchased_date, purchased_price, sale_signal_date, sale_date,
       sale_unit_price, sale_price"""
order("streak_trades", f"SELECT {_trade_columns} FROM priced", *KEYED, _traded)
part("part_streak_trades", f"SELECT {_trade_columns} FROM priced", *KEYED, _traded)
order("purchase_breakdown", "SELECT * FROM purchases", *BACKTEST)
order("sale_breakdown", "SELECT * FROM sales", *BACKTEST)
order(
    "max_drawdown",
    "SELECT * FROM purchases QUALIFY row_number() OVER (PARTITION BY stock ORDER BY drawdown_pct DESC, purchased_date) = 1",
    *BACKTEST,
)
order(
    "max_increment",
    "SELECT * FROM sales QUALIFY row_number() OVER (PARTITION BY stock ORDER BY potential_increment_pct DESC, sale_date, sale_price DESC) = 1",
    *BACKTEST,
)
_stable = """SELECT stock, max(stock_valuation_date) AS last_date,
       max(CASE WHEN highest_lowest_valuation_key NOT IN (4, 5) THEN stock_valuation_date END) AS last_outside_date,
       coalesce(bool_and(highest_lowest_valuation_key IN (4, 5)) FILTER (stock_valuation_date > since), true) AS is_stable
       FROM (SELECT *, CAST(max(stock_valuation_date) OVER (PARTITION BY stock) - INTERVAL 36 MONTH AS DATE) AS since FROM keyed)
       GROUP BY stock"""
order("stable_stocks", _stable, *KEYED)
part("part_stable_stocks", _stable, *KEYED)

# --- data quality ---------------------------------------------------------------------------------

order("dq_unique", "SELECT date, count(*) AS copies FROM staging GROUP BY 1 HAVING count(*) > 1", WIDE, STAGING)
order(
    "dq_not_null",
    """SELECT stock, stock_valuation_date, concat_ws(',', CASE WHEN close_value IS NULL THEN 'close_value' END,
       CASE WHEN volume_value IS NULL THEN 'volume_value' END) AS null_columns
       FROM live WHERE close_value IS NULL OR volume_value IS NULL""",
    *LANDED,
)
order(
    "dq_accepted_values",
    """SELECT highest_lowest_valuation AS unexpected_value, count(*) AS row_count FROM days
       WHERE highest_lowest_valuation NOT IN ('lower_range', 'mid_range', 'higher_range') GROUP BY 1""",
    CLASSIFIED,
)
part(
    "part_dq_accepted_values",
    """SELECT highest_lowest_valuation AS unexpected_value, count(*) AS row_count FROM days
       WHERE highest_lowest_valuation NOT IN ('near_record_low', 'lower_range', 'mid_range', 'higher_range', 'near_record_high') GROUP BY 1""",
    CLASSIFIED,
)
part(
    "part_dq_streak_cover",
    """SELECT b.stock, stock_valuation_date, CAST(2 AS BIGINT) AS streak_count
       FROM bars b JOIN metric m ON b.stock = m.stock AND stock_valuation_date BETWEEN start_date AND end_date
       WHERE date_diff('day', DATE '1970-01-01', start_date) % 3 = 0""",
    *HIGH_LOW_MART,
)
order("dq_relationships", "SELECT * FROM metric WHERE highest_lowest_valuation_key > 3", *HIGH_LOW_MART)
order(
    "dq_streak_cover",
    f"SELECT stock, stock_valuation_date, CAST(0 AS BIGINT) AS streak_count FROM bars WHERE stock_valuation_date >= DATE '{SPLIT}'",
)
order(
    "dq_streak_shape",
    """SELECT * EXCLUDE (previous_end, true_length) FROM (
         SELECT *, CASE WHEN day_length <> true_length THEN 'wrong_length' WHEN previous_end >= start_date THEN 'overlap' END AS fault
         FROM (SELECT *, lag(end_date) OVER (PARTITION BY stock ORDER BY start_date) AS previous_end,
                      date_diff('day', start_date, end_date) + 1 AS true_length
               FROM (SELECT * REPLACE (CAST(end_date + CASE highest_lowest_valuation_key WHEN 1 THEN INTERVAL 1 DAY
                                            ELSE INTERVAL 0 DAY END AS DATE) AS end_date) FROM metric)))
       WHERE fault IS NOT NULL""",
    *HIGH_LOW_MART,
)

# --- streaming ------------------------------------------------------------------------------------

ORACLES["streak_stream"] = _with(EVENT_BARS, *HIGH_LOW_MART, select="SELECT * FROM metric")

# --- events as of their time, versions of a table ---------------------------------------------------

_lines = """, placed AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS stock, CAST(o_orderdate AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
for _name, _compare in (("part_asof", ">="), ("part_asof_forward", "<=")):
    part(
        _name,
        f"""{_lines}
        SELECT l_orderkey, l_linenumber, CASE WHEN abs(day - stock_valuation_date) <= 90 THEN stock_valuation_date END AS price_date,
               CASE WHEN abs(day - stock_valuation_date) <= 90 THEN close_value END AS close_value
        FROM placed r ASOF LEFT JOIN bars b ON r.stock = b.stock AND r.day {_compare} b.stock_valuation_date""",
    )
part(
    "part_asof_nearest",
    f"""{_lines},
    both_sides AS (SELECT r.*, b.stock_valuation_date AS d1, b.close_value AS c1, a.stock_valuation_date AS d2, a.close_value AS c2
      FROM placed r ASOF LEFT JOIN bars b ON r.stock = b.stock AND r.day >= b.stock_valuation_date
      ASOF LEFT JOIN bars a ON r.stock = a.stock AND r.day <= a.stock_valuation_date),
    chosen AS (SELECT *, d2 IS NULL OR day - d1 <= d2 - day AS early FROM both_sides)
    SELECT l_orderkey, l_linenumber, CASE WHEN abs(day - CASE WHEN early THEN d1 ELSE d2 END) <= 90 THEN CASE WHEN early THEN d1 ELSE d2 END END AS price_date,
           CASE WHEN abs(day - CASE WHEN early THEN d1 ELSE d2 END) <= 90 THEN CASE WHEN early THEN c1 ELSE c2 END END AS close_value FROM chosen""",
)
part(
    "part_merge_files",
    """, picked AS (SELECT stock, stock_valuation_date, close_value FROM bars WHERE CAST(stock AS BIGINT) % 50 = 0 AND year(stock_valuation_date) = 1997),
    moved AS (SELECT stock, stock_valuation_date, close_value FROM picked
      UNION ALL SELECT stock, CAST(stock_valuation_date + INTERVAL 4 YEAR AS DATE), close_value FROM picked)
    SELECT stock, stock_valuation_date, CAST(close_value + 1 AS DECIMAL(12,4)) AS close_value FROM moved
    UNION ALL SELECT stock, stock_valuation_date, close_value FROM bars b
    WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.stock = b.stock AND m.stock_valuation_date = b.stock_valuation_date)""",
)
part(
    "part_table_as_of",
    f"""SELECT stock, stock_valuation_date, close_value, unnest(CASE WHEN stock_valuation_date < DATE '{SPLIT}' THEN [0, 1] ELSE [1] END) AS version FROM bars""",
)
