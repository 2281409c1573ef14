"""Benchmark: index build plus the headline query batches at $BENCH_SF_DIR.

Prints one JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lexiq.plans import catalog  # noqa: E402

HEADLINE = [
    "recipe_search",        # flagship: 8-clause relevance recipe, top 10 per benchmark item
    "keyword_multi_field",  # keyword search over body + source
    "phrase",               # positional phrase matching
    "one_of_terms",         # OR of terms with rank weights
    "bool_nested",          # nested must / should / must_not
    "match_all",            # universal posting list minus a term
    "topk_per_query",       # one query per conversation turn, top 5
    "highlights",           # late materialization + fragments
    "mean_metrics",         # retrieval evaluation
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="lexiq-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("lexiq-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", f"{scratch}/ckpt")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    t = time.time()
    catalog.docs_index(spark, sf_dir)
    times["index_build"] = round(time.time() - t, 3)
    print(f"index_build: {times['index_build']}s", file=sys.stderr, flush=True)
    for name in HEADLINE:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
