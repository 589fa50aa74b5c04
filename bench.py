"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

import catalogue
from kalendra.session import configure

HEADLINE = [
    "dedup_exact_event", "dedup_exact_slot", "collapse_colocated", "mention_counter", "group_size",
    "remove_duplicates", "fuzzy_pairs", "dedup_embed_or", "dedup_embed_and", "jaccard_pairs",
    "token_groups", "canonical_locations", "diff_a", "diff_a_status", "payload_a", "diff_b",
    "payload_b", "publish_batches", "upcoming_n", "clean_load", "normalise_eventbrite",
    "normalise_hamburg", "normalise_kiel_magazin", "normalise_rausgegangen",
    "normalise_unser_luebeck", "harvest_links", "csv_drop_rows", "snapshot_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    here = os.path.dirname(os.path.abspath(__file__))
    paths = [here, os.environ.get("PYTHONPATH")]
    os.environ["PYTHONPATH"] = os.pathsep.join(p for p in paths if p)  # for the Python workers
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("kalendra-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kalendra-bench-"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
