"""Benchmark: build every model layer once (the warehouse build), then run the
headline queries on the written layers.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line.  Each timed action writes to Spark's ``noop`` sink,
which computes every row and column without collecting to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cost_reconciliation", "allocate_percent", "telemetry_reconciliation_daily", "token_economics",
    "application_cost", "optimization_recommendations", "unit_economics", "experiment_governance",
    "fact_financial_monthly", "control_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="tokenledger-bench-")
    from pyspark.sql import SparkSession

    shuffle = max(8, cpus * 2)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tokenledger-bench")
             .config("spark.sql.shuffle.partitions", str(shuffle))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from tokenledger.plans.pipeline import Pipeline
    from tokenledger.registry import all_queries

    timings: dict[str, float] = {}
    p = Pipeline(spark, sf_dir)
    t0 = time.perf_counter()
    p.materialize()
    timings["build_all_layers"] = round(time.perf_counter() - t0, 3)

    reg = all_queries()
    for name in HEADLINE:
        t = time.perf_counter()
        reg[name].build(p).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "layer_build_plus_headline_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "layers": p.layer_seconds,
        "cores": cpus,
        "shuffle_partitions": shuffle,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
