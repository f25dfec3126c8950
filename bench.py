"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query is run to its last row with Spark's no-op sink, so nothing is pruned
away and nothing is sent to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import load
from registry.modelling import fitted
from shelfwise.session import build_session

HEADLINES = (
    "flagship_features",
    "extended_features",
    "clean_products",
    "daily_sales",
    "coverage_lifespan",
    "lag_features",
    "rolling_features",
    "velocity_features",
    "target_encoding",
    "store_summary",
    "nearest_features",
    "training_set",
    "fit_encoder",
    "time_split",
    "run_forecast",
    "allocate_stock",
    "apply_sales",
    "apply_changes_transactions",
    "product_stock",
    "forecast_vs_actual_week",
    "shortage_alerts",
    "list_transactions",
    "transactions_view",
    "stock_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases = load()
    names = sys.argv[1:] or HEADLINES
    # One untimed run loads classes, so that the first query is not charged for them.
    cases["clean_products"].query(spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    if "run_forecast" in names:
        # Training is timed by itself; the forecast then loads the saved model.
        start = time.perf_counter()
        fitted(spark, folder)
        times["train_demand"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        cases[name].query(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
