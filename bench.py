"""Times the headline queries on one machine and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query is evaluated whole into Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog.queries import QUERIES
from streakline.session import build_session, remove_scratch

HEADLINE = (
    "order_bars",
    "part_bars",
    "typed_bars",
    "ingest",
    "classified",
    "part_classified",
    "high_low_metric_full",
    "part_high_low_metric_full",
    "part_average_metric_full",
    "part_moving_avg_metric_full",
    "advance_high_low",
    "advance_many_days_high_low",
    "part_advance_many_days",
    "part_latest_streak_alerts",
    "bucket_break_events",
    "part_streak_days",
    "streak_running_extremes",
    "part_round_trips",
    "part_streak_trades",
    "purchase_breakdown",
    "sale_breakdown",
    "dq_freshness_high_low",
    "dq_streak_cover",
    "streak_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["high_low_metric_full"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    remove_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
