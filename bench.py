"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.  Each query runs once to warm
up and then ``$BENCH_RUNS`` times; its best time counts.  Results go to Spark's
``noop`` sink, which computes every row and moves none to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlake.queries import QUERIES  # noqa: E402
from wattlake.session import build_session  # noqa: E402

HEADLINE = (
    "quarter_hour_agg",
    "fact_staging",
    "fact_load",
    "fact_by_hour",
    "last_seven_days_hourly",
    "denormalized_report",
    "sample_average",
    "upsert_device",
    "scd2_device",
    "measures_hourly",
    "rollup_location",
    "rollup_date",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="bench",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = None
        for attempt in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            if attempt:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 4)
    print(
        json.dumps(
            {
                "metric": "total_headline_query_time",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
