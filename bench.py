"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wxengine.catalog.queries import QUERIES  # noqa: E402
from wxengine.session import build_session  # noqa: E402

HEADLINE = (
    "agg_hourly",
    "agg_daily",
    "agg_weekly",
    "agg_monthly",
    "agg_monthly_from_days",
    "rolling_hour",
    "rolling_day",
    "rolling_week",
    "rolling_month",
    "rolling_all",
    "rolling_mode_station",
    "mode_bucket_global",
    "dynamic_select_hourly",
    "dedup_readings",
    "json_extract",
    "scan_json_landing",
    "station_join_3way",
    "station_fanout",
    "station_latest",
    "geo_distinct",
    "incremental_append",
    "stream_agg_hourly",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "wxengine-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session also pays for class loading.
    QUERIES["agg_hourly"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
