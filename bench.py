"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced end to end with the ``noop`` sink (every row and column
computed, nothing collected) after a short warm-up.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docsift.plans.catalog import queries  # noqa: E402
from docsift.session import local_session  # noqa: E402

HEADLINE = [
    "rag_retrieve", "rag_answer", "answer_rounds", "fetch_context", "vector_topk", "filtered_topk",
    "page_chunks", "section_chunks", "hash_embeddings", "embed_chunks", "scrape_links",
    "absolute_links", "chunk_upsert", "vector_upsert", "insert_if_absent", "transcripts",
    "ingest_job", "index_job", "chat_job",
]


def run(spark, fn, sf) -> float:
    t0 = time.time()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus=cpus, app="docsift-bench")
    q = queries()
    # warm-up: JVM, file listing, one Python worker per core (UDF path), and
    # the Parquet writer and checkpoint paths (a small store job)
    run(spark, q["word_count"], sf)
    run(spark, q["embed_chunks"], sf)
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    small = small if os.path.isdir(small) else sf
    run(spark, q["rag_retrieve"], small)
    run(spark, q["index_job"], small)
    times = {}
    for name in names:
        times[name] = round(run(spark, q[name], sf), 3)
    sf_name = os.path.basename(sf.rstrip("/"))
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_name.replace("sf", ""),
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
