"""A larger trial with skew: ten times the line items, and half as many again on one part.

    python trials/skew.py [sf_dir] [scratch folder]

Prints seconds per step. The table is made in the scratch folder and left there.
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from catalog.inputs import SPLIT, new, old, part_bars  # noqa: E402
from streakline.families import HIGH_LOW  # noqa: E402
from streakline.operators import backtest, incremental, indicators, streaks  # noqa: E402
from streakline.plans.marts import write_and_read  # noqa: E402
from streakline.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    spark = build_session(
        "local[8]", "skew", **{"spark.sql.shuffle.partitions": "16", "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.checkpoint.dir": scratch}
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = lines.agg(F.max("l_partkey")).first()[0] + 1
    orders = lines.agg(F.max("l_orderkey")).first()[0] + 1
    many = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(14))))
    hot = F.col("copy") >= 10
    many = many.withColumns(
        {"l_partkey": F.when(hot, 0).otherwise(F.col("l_partkey") + F.col("copy") * parts), "l_orderkey": F.col("l_orderkey") + F.col("copy") * orders}
    ).drop("copy")
    many.write.mode("overwrite").parquet(f"{scratch}/lineitem.parquet")
    print(f"rows {spark.read.parquet(f'{scratch}/lineitem.parquet').count()}, split {SPLIT}")

    def timed(name: str, df, path: str | None = None):
        start = time.perf_counter()
        out = write_and_read(df, f"{scratch}/{path}") if path else df.write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
        return out

    bars = timed("ticks to bars", part_bars(spark, scratch), "bars")
    days = timed("classified", indicators.classified(bars), "days")
    timed("full mart", streaks.metric_full(indicators.classified(bars), HIGH_LOW))
    metric = timed("mart up to the split", streaks.metric_full(old(days), HIGH_LOW), "metric")
    timed("advance by all later days", incremental.advance_many_days(metric, new(days), HIGH_LOW))
    timed("one trade per streak", backtest.streak_trades(backtest.signals(backtest.keyed_days(days))))
    spark.stop()


if __name__ == "__main__":
    main()
