"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline list

Every query runs three times, from plan building to the last row written to Spark's
no-op sink. The median run counts; ``first`` has the first runs, which also compile the plan.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from parcelflow.catalog import QUERIES

HEADLINE = (
    "profile_order_status profile_timeline profile_fan_out profile_numeric_ranges "
    "profile_zip_ambiguity zip_centroid_median item_features payment_features order_features "
    "order_targets non_delivery_dataset model_inputs clean_blank_to_null csv_round_trip "
    "strict_cast_quarantine pk_violations fk_violations chronological_rank "
    "chronological_split split_coverage metric_report manifest_compare table_fingerprint "
    "delivery_history"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="parcelflow-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(sorted(runs)[1], 3)
        first[name] = round(runs[0], 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first": first,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
