"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS.
Every query is run once to warm up and then timed; the median is reported.
Results are computed completely and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from hazardgrid.plans.queries import QUERIES
from hazardgrid.session import build_session

HEADLINE = [
    "delivery_performance",
    "cap_alerts_parsed",
    "weather_risk_daily",
    "event_validation_strict",
    "event_validation_ingest_age",
    "audit_stream_union",
    "air_quality_daily",
    "area_risk_daily",
    "area_risk_daily_joined",
    "weather_upsert",
    "air_quality_upsert",
    "risk_row_scores",
    "station_discovery",
    "kpi_trend",
    "stream_silver",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "hazardgrid-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
