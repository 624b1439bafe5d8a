"""Quality rules: fixed limits first, then outliers by a minimum covariance determinant for each language and source.

Only DataFrame functions. The statistics of a text are array expressions of its own row. The estimate works on a
stored table of a few numbers per document: sums over groups, combined before the shuffle, so a source may hold any
share of the rows. Sums are of whole numbers and the least-distance subset is cut on a fixed grid of distances;
results do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streakline.llm.common import ORIGINAL, SPACE_CLASS, packed, stored, unpacked

WINDOW = 5
UNIT = 10_000
STATISTICS = ("length", "symbols", "lines", "repeats")


@dataclass(frozen=True)
class QualityParams:
    """Limits. ``share`` is the share of rows in the least-distance subset, at least (rows + 5) / 2 of them: half, so that
    the estimate stands as long as less than half of a group is junk. ``consistency`` is its factor for four normal
    dimensions (share / P(chi2(6) <= chi2(4) quantile of share)). ``steps`` limits the concentration steps, None does
    not; ``patience`` is the step from which the determinant has to fall. After ``trial`` steps the ``finalists`` of least
    determinant go on, the other starts of the group end. ``floors`` are the least standard deviations, in the
    units of the transformed statistics, so that a statistic that is nearly constant in a group does not make every
    small departure an outlier. ``cutoff`` is the largest squared distance that is kept, about the 1 - 1e-6 quantile
    of chi2(4). Groups of fewer than ``min_rows`` rows take the estimate of their language."""

    min_words: int = 10
    max_repeat_percent: int = 20
    share: float = 0.5
    consistency: float = 2.109
    steps: int | None = None
    patience: int = 10
    trial: int = 2
    finalists: int = 2
    floors: tuple[float, float, float, float] = (2.0, 0.6, 0.6, 0.06)
    cutoff: float = 33.4
    min_rows: int = 100


def _statistics(docs: DataFrame, text: str, carried: list[Column]) -> DataFrame:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` beside the carried columns.

    Windows are compared by 64-bit hashes of their words' hashes. Positions are sorted only where a hash occurs twice."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [f"c{i}" for i in range(len(carried))]
    base = docs.select(*[c.alias(n) for c, n in zip(carried, names, strict=True)], content.alias("text"))
    words = F.array_remove(F.split("text", SPACE_CLASS + "+"), "")
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    read = base.select(
        *names,
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        words.alias("words"),
        lines.alias("lines"),
    )
    hashed = read.select(
        *names,
        "n_symbols",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    counts = [*names, "n_symbols", "n_words", "word_chars", "n_dup_lines"]
    starts = F.when(F.size("hashes") >= WINDOW, F.sequence(F.lit(0), F.size("hashes") - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = hashed.select(*counts, F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + k) for k in range(WINDOW)])).alias("windows"))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = windows.select(*counts, F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).alias("placed"))

    def repeated(s, j):
        here, before, after = s["h"], F.get(F.col("placed"), j - 1)["h"], F.get(F.col("placed"), j + 1)["h"]
        return F.when(before.eqNullSafe(here) | after.eqNullSafe(here), s["i"]).otherwise(F.lit(-1))

    positions = F.sort_array(F.filter(F.transform("placed", repeated), lambda i: i >= 0))
    found = sorted_.select(*counts, F.when(F.col("placed").isNotNull(), positions).otherwise(F.array().cast("array<int>")).alias("positions"))
    covered = F.transform("positions", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("positions"), j + 1) - p, F.lit(WINDOW))))
    return found.select(*counts, F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_repeat_words"))


def _scaled(x: Column) -> Column:
    return F.round(x * UNIT).cast("bigint")


def _add_distance(rows: DataFrame) -> DataFrame:
    """``d2`` by the factor of the group's covariance, forward substitution."""
    for i in range(4):
        rest = F.col(f"x{i}") / UNIT - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 4)), F.col("y0") * F.col("y0")))


def _factored(estimates: DataFrame, keep: list[str], params: QualityParams, factor: float) -> DataFrame:
    """Mean, and lower factor of ``factor`` times the covariance plus the floors, from sums of whole numbers."""
    n = F.col("n").cast("double")
    df = estimates
    for i in range(4):
        df = df.withColumn(f"m{i}", F.col(f"s{i}").cast("double") / n / UNIT)
    for i in range(4):
        for j in range(i + 1):
            value = (F.col(f"s{i}{j}").cast("double") / n / (UNIT * UNIT) - F.col(f"m{i}") * F.col(f"m{j}")) * factor
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + params.floors[i] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(params.floors[i] ** 2 / 4)))
            else:
                value = value / F.col(f"l{j}{j}")
            df = df.withColumn(f"l{i}{j}", value)
    return df.select(*keep, *[f"m{i}" for i in range(4)], *[f"l{i}{j}" for i in range(4) for j in range(i + 1)])


def _bin(x: Column, width: float, most: int) -> Column:
    return F.least(F.greatest(F.floor(x / width), F.lit(-most)), F.lit(most)).cast("int")


def _quantile_bins(rows: DataFrame, keys: list[str], bins: Column, wanted: dict[str, Column]) -> DataFrame:
    """``keys``, the first bin at which each number of ``wanted`` is reached, and ``rows``; a group has a bounded number of bins."""
    counted = rows.groupBy(*keys, bins.alias("bin")).agg(F.count("*").alias("n"))
    through = Window.partitionBy(*keys).orderBy("bin")
    total = Window.partitionBy(*keys)
    return (
        counted.withColumn("upto", F.sum("n").over(through))
        .withColumn("rows", F.sum("n").over(total))
        .groupBy(*keys)
        .agg(*[F.min(F.when(F.col("upto") >= least, F.col("bin"))).alias(name) for name, least in wanted.items()], F.first("rows").alias("rows"))
    )


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    whole = "decimal(38,0)"
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f"x{i}").cast(whole)).alias(f"s{i}") for i in range(4)],
        *[F.sum(F.col(f"x{i}").cast(whole) * F.col(f"x{j}").cast("decimal(19,0)")).cast(whole).alias(f"s{i}{j}") for i in range(4) for j in range(i + 1)],
    )


def _least_sums(far: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The sums over each key's subset of least distances: all rows of the first bins that hold ``share`` of its rows,
    (rows + 5) / 2 at least. Rows are summed by bin, in one pass, and then the bins, of which a key has a bounded number."""
    by_bin = _sums(far, [*keys, "bin"])
    own = Window.partitionBy(*keys)
    rows = F.sum("n").over(own)
    enough = F.least(rows, F.greatest(rows * share, F.floor((rows + 5) / 2)))
    nearer = F.sum("n").over(own.orderBy("bin")) - F.col("n")
    subset = by_bin.withColumn("inside", nearer < enough).where("inside")
    names = [c for c in by_bin.columns if c not in (*keys, "bin", "n")]
    return subset.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in names])


def _starts(vectors: DataFrame, params: QualityParams) -> DataFrame:
    """A row per group and start: ``group``, ``start``, ``rows``, centres and a diagonal factor, from quantiles of each
    statistic. Start 0 is the median and twice the floors; the others are the middle and the width of the middle half,
    of the shortest half (on sixteenths of the rows), of the lower and of the upper half."""
    sixteenths = {f"q{k}": F.col("rows") * (k / 16) for k in range(17)}
    of_statistics = []
    for i in range(4):
        unit = params.floors[i] / 4
        q = _quantile_bins(vectors, ["group"], _bin(F.col(f"x{i}") / UNIT, unit, 4000), sixteenths)
        shortest = F.least(*[F.struct((F.col(f"q{k + 8}") - F.col(f"q{k}")).alias("width"), F.col(f"q{k}").alias("low"), F.col(f"q{k + 8}").alias("high")) for k in range(9)])
        halves = [(F.col("q4"), F.col("q12")), (shortest["low"], shortest["high"]), (F.col("q0"), F.col("q8")), (F.col("q8"), F.col("q16"))]
        places = [F.struct(((F.col("q8") + 0.5) * unit).alias("m"), F.lit(2 * params.floors[i]).alias("l"))]
        for low, high in halves:
            # Half the width holds a quarter of a normal distribution on each side of the middle.
            places.append(F.struct(((low + high + 1) / 2 * unit).alias("m"), F.greatest((high - low + 1) * (unit / 2 / 0.6745), F.lit(params.floors[i])).alias("l")))
        of_statistics.append(q.select("group", *(["rows"] if i == 0 else []), F.array(*places).alias(f"places{i}")))
    joined = of_statistics[0]
    for other in of_statistics[1:]:
        joined = joined.join(other, "group")
    each = joined.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(4))))
    numbers = [F.get(F.col(f"places{i}"), F.col("start"))["m"].alias(f"m{i}") for i in range(4)]
    for i in range(4):
        for j in range(i + 1):
            numbers.append((F.get(F.col(f"places{i}"), F.col("start"))["l"] if i == j else F.lit(0.0)).alias(f"l{i}{j}"))
    return each.select("group", "start", "rows", *numbers)


def _estimates(vectors: DataFrame, params: QualityParams) -> DataFrame:
    """Concentration steps from several starts: distances, the subset of least distances, its mean and covariance, and
    again until the subset stays the same; of a group's starts, the one with the least determinant. A start that is not
    among the best after the first steps goes no further. Squared distances
    are cut on a grid of 32nds up to 1 and of 32nds of a power of two above. Starts that have met go on as one. From
    ``patience`` steps on, a determinant that does not fall ends a start too: the grid could let it run in a circle."""
    keys = ["group", "start"]
    numbers = [f"m{i}" for i in range(4)] + [f"l{i}{j}" for i in range(4) for j in range(i + 1)]
    size = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, 4)), F.log(F.col("l00")))
    grid = F.when(F.col("d2") < 1, F.floor(F.col("d2") * 32)).otherwise(32 + F.least(F.floor(32 * F.log2("d2")), F.lit(6400))).cast("int")
    active, ended, step = stored(_starts(vectors, params), "starts"), [], 0
    while True:
        step += 1
        far = _add_distance(vectors.join(active.select(*keys, *numbers), "group")).withColumn("bin", grid)
        now = _factored(_least_sums(far, keys, params.share), keys, params, params.consistency).withColumn("size", size)
        before = active.select(*keys, "rows", F.struct(*numbers).alias("old"), size.alias("old_size"))
        same = F.struct(*numbers).eqNullSafe(F.col("old"))
        over = same | (F.lit(step >= params.patience) & (F.col("size") >= F.col("old_size"))) | F.lit(step == params.steps)
        joined = now.join(before, keys).withColumn("over", over)
        now = stored(joined.groupBy("group", "rows", "size", *numbers).agg(F.min("start").alias("start"), F.max("over").alias("over")), "estimate")
        ended.append(now.where("over").drop("over"))
        active = now.where("not over").select(*keys, "rows", *numbers)
        if step == params.trial:
            ahead = Window.partitionBy("group").orderBy("size", "start")
            ranked = reduce(DataFrame.unionByName, ended[:-1], now.drop("over")).join(active.select(*keys, F.lit(True).alias("goes_on")), keys, "left")
            finalists = ranked.withColumn("rank", F.row_number().over(ahead)).where((F.col("rank") <= params.finalists) & F.col("goes_on"))
            active = stored(finalists.select(*keys, "rows", *numbers), "finalists")
        if active.isEmpty():
            break
    every = reduce(DataFrame.unionByName, ended)
    best = every.groupBy("group").agg(F.min(F.struct("size", "start", "rows", *numbers)).alias("best"))
    return stored(best.select("group", "best.rows", *[f"best.{x}" for x in numbers]), "estimate")


def quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", params: QualityParams | None = None) -> DataFrame:
    """The documents' columns and ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept`` and ``distance2`` (squared distance, null where the fixed limits fail).

    A null text counts as empty and fails. A null language or source is a value of its own. Repeated rows count as
    often as they occur. Columns named like a new one are replaced.
    """
    return _judged(_grouped(docs, text, lang, source, packed(docs)), docs.columns, params or QualityParams())


def verdicts(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source", params: QualityParams | None = None
) -> DataFrame:
    """As ``quality``, with ``doc_id`` as the only column of the documents; texts are not stored on the way."""
    own = F.struct(F.col(f"`{doc_id}`").alias("doc_id"))
    return _judged(_grouped(docs, text, lang, source, own), ["doc_id"], params or QualityParams())


def _grouped(docs: DataFrame, text: str, lang: str, source: str, own: Column) -> DataFrame:
    group = F.to_json(F.struct(F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source")))
    language = F.to_json(F.struct(F.col(f"`{lang}`").alias("lang")))
    return _statistics(docs, text, [own, group, language]).withColumnsRenamed({"c0": ORIGINAL, "c1": "group", "c2": "language"})


def _judged(stats: DataFrame, columns: list[str], params: QualityParams) -> DataFrame:
    n = F.col("n_words")
    failed = (n < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_percent * n)
    rows = stored(stats.withColumn("base_failed", failed), "quality_statistics")
    passed = rows.where("not base_failed")
    some = F.greatest(n, F.lit(1))
    mean = F.col("word_chars") / some
    # The middle of a language's mean word lengths, on a grid of sixteenths; it only centres a statistic.
    centre = _quantile_bins(passed.select("language", mean.alias("mean")), ["language"], _bin(F.col("mean"), 1 / 16, 1600), {"bin": F.col("rows") * 0.5})
    centre = stored(centre.select("language", ((F.col("bin") + 0.5) / 16).alias("centre")), "centre")
    vector = {
        # Deviation of the mean word length in units that do not depend on the number of words.
        "x0": _scaled(F.sqrt(F.least(n, F.lit(200)).cast("double")) * (mean - F.col("centre"))),
        "x1": _scaled(F.log1p(100 * F.col("n_symbols") / some)),
        "x2": _scaled(F.log1p(F.col("n_dup_lines").cast("double"))),
        "x3": _scaled(F.col("n_repeat_words") / some),
    }
    slim = passed.select("group", "language", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    vectors = stored(slim.join(centre, "language").withColumns(vector).select("group", "language", *vector), "quality_vectors")
    # A group of enough rows has its own estimate; a language has one where it has a smaller group.
    sizes = vectors.groupBy("group", "language").agg((F.count("*") >= params.min_rows).alias("own"))
    of_language = F.concat(F.lit("language "), F.col("language"))
    small = F.min("own").over(Window.partitionBy("language"))
    levels = F.array_compact(F.array(F.when(F.col("own"), F.col("group")), F.when(~F.col("all_own"), of_language)))
    levels = stored(sizes.withColumn("all_own", small).select("group", levels.alias("levels")), "levels")
    leveled = stored(vectors.join(levels, "group").select(F.explode("levels").alias("group"), *vector), "quality_levels")
    estimates = _estimates(leveled, params)
    large = stored(estimates.where(F.col("rows") >= params.min_rows), "estimates_of_groups")
    groups = large.select(F.col("group"), F.lit(True).alias("own"))
    scored = (
        rows.join(centre, "language", "left")
        .join(groups, "group", "left")
        .withColumn("group", F.when(F.col("own"), F.col("group")).otherwise(F.concat(F.lit("language "), "language")))
        .withColumns(vector)
        .join(estimates.drop("rows"), "group", "left")
    )
    scored = _add_distance(scored).withColumn("d2", F.when(~F.col("base_failed"), F.col("d2")))
    new = {
        name: F.col(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    } | {"kept": ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= params.cutoff), "distance2": F.col("d2")}
    return unpacked(scored, columns, **new)
