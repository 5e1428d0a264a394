"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bindings.queries import QUERIES  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

HEADLINE = [
    "decimal_text", "loaded_batches", "contract_violations", "regression_metrics", "categorical_psi", "numeric_profile",
    "quantile_bins", "numeric_psi", "monitoring_signals", "flat_monitoring_report", "alert_state", "group_statistics",
    "correlation_matrix", "iqr_outliers", "duplicate_copies", "selected_families", "promotion_decisions",
    "linear_batch_predictions",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the workers
    times = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
