"""Time the registered queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores; names given as arguments are run
instead of the headline queries. Each query is run to the end of its result through the `noop` sink.
"""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "daily_bars", "minute_bars", "silver_roundtrip", "gold_features", "gold_latest", "gold_halo_window",
    "upsert_bars", "quality_report", "chrono_split", "impute_scale", "binary_encode", "exact_median",
    "event_index", "walk_forward_folds", "fold_scores", "ridge_scores", "hyperband_survivors", "ks_drift",
    "chi2_drift", "reference_window", "replay_sample", "online_step", "stream_bars", "stream_gold",
    "stream_decode", "weekly_best",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.TemporaryDirectory(prefix="tidemark-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", shared.name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.queries import QUERIES

    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority").count().collect()  # warm-up
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    shared.cleanup()
    print(json.dumps({
        "metric": "total query seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
