from pyspark.sql import functions as F

from simdex.operators.chunking import chunk_count, chunk_fixed
from simdex.operators.index import build_index, hash_buckets, index_summary
from simdex.operators.results import hash_log
from tests.conftest import docs_df


def test_chunks_of_reference_inputs(spark):
    docs = docs_df(spark, {1: "This is a sample test file.", 2: "Hello, world! This is a test file.",
                           3: ""})
    rows = chunk_fixed(docs, 10).orderBy("doc_id", "chunk_idx").collect()
    sizes = {}
    for r in rows:
        sizes.setdefault(r.doc_id, []).append(r.size)
    assert sizes == {1: [10, 10, 7], 2: [10, 10, 10, 4]}
    assert [r.offset for r in rows if r.doc_id == 2] == [0, 10, 20, 30]
    # chunks concatenate back to the source
    assert b"".join(bytes(r.chunk) for r in rows if r.doc_id == 2) == b"Hello, world! This is a test file."
    counts = {r.doc_id: r.n for r in docs.select("doc_id", chunk_count("content", 10).alias("n")).collect()}
    assert counts == {1: 3, 2: 4, 3: 0}


def test_chunk_boundaries_and_multibyte(spark):
    docs = docs_df(spark, {1: "a" * 90, 2: "a" * 100, 3: "a" * 110, 4: "é" * 5})
    n = {r.doc_id: r.n for r in chunk_fixed(docs, 10).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert n == {1: 9, 2: 10, 3: 11, 4: 1}
    cut = chunk_fixed(docs_df(spark, {1: "é" * 5}), 3).orderBy("chunk_idx").collect()
    assert [r.size for r in cut] == [3, 3, 3, 1]
    assert b"".join(bytes(r.chunk) for r in cut) == ("é" * 5).encode()


def test_index_hashes_and_views(spark):
    docs = docs_df(spark, {2: "Hello, world! This is a test file."})
    idx = build_index(docs, 10).orderBy("chunk_idx").collect()
    got = [format(r.hash & 0xFFFFFFFFFFFFFFFF, "x") for r in idx]
    assert got == ["df736b2afdeb7aff", "96541c8b4bb490b3", "fc76dfde7f5d3e9", "ba80c4229bd2b8e"]
    summ = index_summary(build_index(docs, 10)).collect()[0]
    assert (summ.n_chunks, summ.n_bytes, summ.n_distinct_hashes) == (4, 34, 4)
    b = hash_buckets(build_index(docs_df(spark, {1: "ab ab ab ab"}), 3)).collect()
    assert [(r.block, r.chunk_idxs, r.n_chunks) for r in b] == [(0, [0, 1, 2, 3], 4)]


def test_stride_overlaps(spark):
    docs = docs_df(spark, {1: "abcdefghij"})
    rows = chunk_fixed(docs, 4, stride=2).orderBy("offset").collect()
    assert [(r.offset, bytes(r.chunk)) for r in rows] == [
        (0, b"abcd"), (2, b"cdef"), (4, b"efgh"), (6, b"ghij"), (8, b"ij")]


def test_hash_log_lines(spark):
    hashes = [0x1a2b3c, 0x4d5e6f, 0x7a8b9c, 0xabcdef]
    df = spark.createDataFrame([(1, i, (i + 1) * 100, h) for i, h in enumerate(hashes)],
                               "doc_id bigint, chunk_idx int, offset bigint, hash bigint")
    lines = [r.line for r in hash_log(df).orderBy("chunk_idx").collect()]
    assert lines == ["1a2b3c=>100", "4d5e6f=>200", "7a8b9c=>300", "abcdef=>400"]


def test_hash_log_compat(spark):
    def n_lines(n):
        df = spark.createDataFrame([(1, i, i * 10, i + 1, n) for i in range(n)],
                                   "doc_id bigint, chunk_idx int, offset bigint, hash bigint, n int")
        return hash_log(df, compat=True, n_chunks=F.col("n")).count()
    assert (n_lines(4), n_lines(10), n_lines(12)) == (4, 0, 9)
