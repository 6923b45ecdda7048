"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up (class loading, generated code) and three times for the clock, which covers building the
plan and running it into a sink that discards the rows. The median counts; the spread between the fastest and the slowest
run says which differences mean something.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lumisift.checks.catalog import QUERIES  # noqa: E402
from lumisift.session import local_session, ship_package  # noqa: E402

HEADLINE = [
    "q1_scan_cosine_topk", "q1_scan_l2_all", "q2_hash_search", "q2_bundle_aware", "q3_hash_limit", "q5_per_shard_limit",
    "h1_bit_sampling", "h2_lsh", "q22_batch_topk", "q22_batch_hash_topk", "q22_batch_hash_all", "q24_recall", "q25_hash_docfreq", "s8_extract_features",
    *[name for name in QUERIES if name.startswith(("d0", "d1"))],
]


RUNS = 3


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", memory="16g")
    ship_package(spark)
    seconds, spread = {}, {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        runs = [timed(spark, sf_dir, name) for _ in range(RUNS)]
        seconds[name], spread[name] = round(statistics.median(runs), 3), round(max(runs) - min(runs), 3)
    images = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    per_second = {n: round(images / s, 1) for n, s in seconds.items() if n.startswith(("d0", "d1", "h1", "h2", "s8"))}
    quality = [r.asDict() for r in QUERIES["q24_recall"](spark, sf_dir).collect()]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "items_per_sec": per_second, "spread": spread,
        "recall_at_10": round(sum(r["hit"] for r in quality) / max(1, sum(r["wanted"] for r in quality)), 4),
        "candidate_ratio": round(sum(r["candidates"] for r in quality) / max(1, sum(r["docs"] for r in quality)), 4),
    }))


if __name__ == "__main__":
    main()
