"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the input and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattspan.plans.catalogue import registered  # noqa: E402
from wattspan.session import build_session  # noqa: E402
from wattspan.sources.marketviews import table  # noqa: E402

HEADLINE = [
    "clean_da_prices", "clean_rt_prices", "clean_weather", "quality_report", "price_lags",
    "model_matrix", "model_matrix_history", "walk_forward_folds", "forecast_naive_week",
    "forecast_seasonal_dow", "forecast_lear", "forecast_gbt", "forecast_metrics", "dispatch_ceiling",
    "dispatch_capped", "daily_backtest", "sensitivity_sweep", "profit_concentration",
    "price_history_recent", "end_to_end_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "wattspan-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    table(spark, sf_dir, "events").count()  # JVM and reader start-up
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
