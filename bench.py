"""Benchmark at $BENCH_SF_DIR on local[$BENCH_CPUS]. Prints one JSON line.

Headline (``value``): the reference's batch job end to end -- raw posts in
CSV (the ``posts`` view written once as a headerless CSV, untimed) are
loaded, scored, turned into the hashtag graph, and vertices, edges and the
top-N JSON export are written (``plans.batch.run_batch``).

``queries``: the job plus per-query wall times of registered queries, each
run as a full ``noop`` write (the whole plan executes, nothing is collected
to the driver). ``turn_*`` and ``doc_*`` are stress cases beyond
the reference's workload (every word of whole texts as a tag).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagweave.plans.batch import run_batch  # noqa: E402
from tagweave.plans.catalog import QUERIES  # noqa: E402
from tagweave.session import build_session, scratch_path  # noqa: E402
from tagweave.sources.fixtures import raw_view  # noqa: E402

HEADLINE = [
    "load_parquet_normalized",   # scan + normalise (S3, P1-P6, P19)
    "sentiment_distribution",    # A5 + P15
    "vertices",                  # G1 on posts
    "edges",                     # G2 on posts (short posts, array pairs)
    "top_subgraph_edges",        # G3: L1 + broadcast semi-joins
    "degree_centrality",         # G5
    "to_wire",                   # ST7
    "turn_edges",                # G2 on conversation turns (large vocabulary)
    "turn_pagerank_5",           # G4, 5 iterations
    "doc_pair_totals",           # whole documents, every word a tag (hot rows), closed form
    "turn_slider_edges",         # G3 for ten settings from one index
    "weights_sentiment",         # N3 as join and sum
    "token_spans",               # tokens with offsets of whole documents
    "stream_graph_edges",        # live graph: availableNow stream, then the current edges
    "doc_graph_summary",         # whole documents, every pair of words
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # many initial shuffle partitions, coalesced at run time by adaptive execution:
    # small shuffles shrink, the large pair aggregates keep partitions that fit in memory
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(8 * cpus)))
    spark = build_session(f"local[{cpus}]", app_name="tagweave-bench",
                          shuffle_partitions=parts,
                          extra_conf={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    # warm-up: JVM, codegen caches, file listing (not timed)
    QUERIES["sentiment_label"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    csv_path = scratch_path(spark, "bench-posts-csv")
    raw_view(spark, sf_dir, "posts").write.option("header", "false").csv(csv_path)
    t0 = time.perf_counter()
    res = run_batch(spark, csv_path, "csv", scratch_path(spark, "bench-graph"), top_n=20)
    job = round(time.perf_counter() - t0, 3)
    times["batch_job_csv"] = job
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "batch_job_csv_wall", "value": job, "unit": "sec",
                      "posts": res.counts["posts"], "posts_per_sec": round(res.counts["posts"] / job, 1),
                      "queries_total": round(sum(times.values()), 3),
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
