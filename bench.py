"""Time the headline queries and print one line of JSON.

BENCH_SF_DIR names the data, BENCH_CPUS the number of local slots.  Each query
runs to a sink that keeps nothing, all of them twice; the better run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from workload.queries import queries  # noqa: E402

HEADLINE = (
    "index_chunks",
    "chunks_line",
    "chunks_custom_pattern",
    "chunks_top_level",
    "line_spans",
    "merkle_roots",
    "merkle_nodes",
    "corpus_root",
    "conversation_roots",
    "obfuscated",
    "embedding_ids",
    "sync_status",
    "file_diff",
    "chunk_diff",
    "reuse_embeddings",
    "manifest_latest",
    "stream_index",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chunkloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: [] for name in names}
    for _ in range(2):
        for name in names:
            start = time.perf_counter()
            frame = queries()[name](spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
            print(f"{name}: {runs[name][-1]:.3f}", file=sys.stderr, flush=True)
    times = {name: round(min(seconds), 3) for name, seconds in runs.items()}
    spark.stop()
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
