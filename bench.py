"""Time the headline reports; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Every query is run
to completion over its whole input. The best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import time

from checks.cases import QUERIES
from meterqa.session import build_session

HEADLINES = (
    "reporting_modes",
    "weekly_missing_report",
    "daily_plot_table",
    "hourly_plot_table",
    "month_hourly_grid",
    "qa_combined",
    "qa_by_measurement",
    "negatives_by_month",
    "monthly_stats",
    "monthly_stats_stitched",
    "monthly_stats_windowed",
    "daily_series",
    "daily_series_consent",
    "moving_avg_30",
    "moving_avg_consent",
    "meters_from_sites",
    "meters_from_consents",
    "meters_from_catchment",
    "wh_lag",
    "daily_source_reconcile",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["moving_avg_30"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    seconds = {}
    for name in [n for n in names if n] or HEADLINES:
        best = None
        for _ in range(runs):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - begun
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
