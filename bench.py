"""Headline timings: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is forced with a ``noop`` write (all columns computed, nothing
collected).  A short warm-up on sf0.001 runs first (JVM and Python workers).
``index_4096`` is the reference's benchmark shape (indexing at 4 KB chunks,
index written); ``mb_per_sec`` reports its text throughput.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from simdex import queries as Q  # noqa: E402
from simdex.operators.hamming_join import band_layout, candidate_share  # noqa: E402
from simdex.operators.index import build_index  # noqa: E402
from simdex.operators.lookup import lookup  # noqa: E402
from simdex.session import get_session  # noqa: E402
from simdex.sources.documents import load_documents  # noqa: E402
from simdex.sources.index_store import read_index, write_index  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def sf_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def run(spark, sf_dir, scratch):
    docs = load_documents(spark, sf_dir)
    out = {}

    def timed(name, fn):
        t = time.time()
        fn()
        out[name] = round(time.time() - t, 3)

    def index_job(size):
        def go():
            write_index(build_index(docs, size), os.path.join(scratch, f"idx{size}-{time.time_ns()}"))
        return go

    timed("index_4096", index_job(4096))
    idx_path = os.path.join(scratch, f"idx512-{time.time_ns()}")
    timed("index_512", lambda: write_index(build_index(docs, 512), idx_path))

    def lookup_job():
        idx = read_index(spark, idx_path, 512)
        lookup(idx, Q._bench_queries(spark, sf_dir), Q.K).write.format("noop").mode("overwrite").save()
    timed("lookup", lookup_job)

    def query(name):
        return lambda: Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in ("search_text", "near_duplicate_pairs", "dedup_documents", "plagiarism_matches",
                 "content_distribution"):
        timed(name, query(name))
    return out


def shares(n):
    """Share of all pairs that the banded join takes as candidates for n hashes a side and for
    ten times as many (even bits)."""
    return [round(candidate_share(band_layout(Q.K, m, m)), 6) for m in (n, 10 * n)]


def main():
    spark = get_session(f"local[{CPUS}]", CPUS * 2, app_name="simdex-bench",
                        extra={"spark.driver.memory": "16g",
                               "simdex.scan.partitions": str(CPUS * 2)})
    scratch = tempfile.mkdtemp(prefix="simdex-bench-")
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(SF_DIR):
        run(spark, warm, scratch)
    times = run(spark, SF_DIR, scratch)
    n_bytes = load_documents(spark, SF_DIR).agg(F.sum(F.octet_length("content"))).first()[0]
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec",
                      "queries": times, "sf": sf_of(SF_DIR), "cpus": CPUS,
                      "text_mb": round(n_bytes / 1e6, 2),
                      "dedup_candidate_share": shares(load_documents(spark, SF_DIR).count()),
                      "index_4096_mb_per_sec": round(n_bytes / 1e6 / times["index_4096"], 2)}))


if __name__ == "__main__":
    main()
