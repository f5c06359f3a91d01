"""Content of hits by row locators, replaced, withdrawn and changed documents; merged sketches."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simdex.operators.index import build_index
from simdex.operators.lookup import lookup_exact
from simdex.plans.distribution import content_distribution
from simdex.plans.sketches import sketched_distribution, write_sketches
from simdex.sources import located_index
from simdex.sources.index_store import IndexReadError
from simdex.sources.located_index import (MISSING, STALE, add_documents, current_documents, joined_content, located_content,
                                          located_documents, opened_by_tasks, read_located, with_places, withdraw)

WORDS = ["river", "stone", "über", "hill", "x1", "under"]


@pytest.fixture()
def corpus(spark, tmp_dir):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 40)))) for i in range(200)]
    texts += [(7, "a second text with id seven"), (7, texts[7][1]), (None, "no id here"), (300, ""), (301, None), (302, "river " * 5000)]
    path = os.path.join(tmp_dir, "docs")
    spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    return path, [(i, t) for i, t in texts if t is not None]


def every_chunk(spark, path):
    """All chunks found by their own hash, with content."""
    idx = read_located(spark, path)
    q = idx.select(F.col("hash").cast("string").alias("query_id"), F.col("hash").alias("qhash")).distinct()
    return located_content(with_places(lookup_exact(idx, q), idx), current_documents(spark, path))


def chunks_of(texts, size=40):
    out = Counter()
    for i, t in texts:
        raw = t.encode()
        out.update((i, o, raw[o:o + size]) for o in range(0, len(raw), size))
    return out


def got(df):
    return Counter((r.doc_id, r.offset, bytes(r.content)) for r in df.collect())


def test_content_of_every_chunk(spark, corpus, tmp_dir, monkeypatch):
    docs, texts = corpus
    monkeypatch.setattr(located_index, "BATCH_BYTES", 500)
    path = os.path.join(tmp_dir, "index")
    with pytest.raises(IndexReadError):
        read_located(spark, path)
    add_documents(located_documents(spark, docs), 40, path)
    found = every_chunk(spark, path)
    assert got(found) == chunks_of(texts)
    idx = read_located(spark, path)
    asked = idx.select(F.col("hash").cast("string").alias("query_id"), F.col("hash").alias("qhash")).distinct()
    hits = with_places(lookup_exact(idx, asked), idx)
    table = located_documents(spark, docs)
    assert got(joined_content(hits, current_documents(spark, path), table)) == chunks_of(texts)
    part = joined_content(hits, current_documents(spark, path), table.where("doc_id <> 302").withColumn(
        "content", F.when(F.col("doc_id") == 9, F.encode(F.lit("other"), "UTF-8")).otherwise(F.col("content"))))
    assert {r.doc_id: r.reason for r in part.where("reason is not null").collect()} == {9: STALE, 302: MISSING, None: MISSING}
    assert part.count() == sum(chunks_of(texts).values())
    assert [opened_by_tasks(p) for p in ("/a/b", "file:/a", "hdfs://n/a", "viewfs://c/a")] == [True, True, True, False]
    assert found.where("reason is not null").count() == 0


def test_text_is_not_moved(spark, corpus, tmp_dir):
    path = os.path.join(tmp_dir, "index")
    add_documents(located_documents(spark, corpus[0]), 40, path)
    plan = every_chunk(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert f"{corpus[0]}" not in plan          # no scan of the documents' table at all


def test_replaced_and_withdrawn(spark, corpus, tmp_dir):
    docs, texts = corpus
    path, newer = os.path.join(tmp_dir, "index"), os.path.join(tmp_dir, "newer")
    add_documents(located_documents(spark, docs), 40, path)
    spark.createDataFrame([(3, "a new text of three"), (7, "seven"), (None, "still none"), (900, "added")],
                          "doc_id bigint, text string").coalesce(1).write.parquet(newer)
    add_documents(located_documents(spark, newer), 40, path)
    withdraw(spark.createDataFrame([(5,), (900,), (12345,)], "doc_id bigint"), path)
    left = [(i, t) for i, t in texts if i not in (3, 7, None, 5)] + [(3, "a new text of three"), (7, "seven"), (None, "still none")]
    assert got(every_chunk(spark, path)) == chunks_of(left)
    # taken in again after it was withdrawn
    add_documents(located_documents(spark, docs).where("doc_id = 5"), 40, path)
    assert got(every_chunk(spark, path)) == chunks_of(left + [t for t in texts if t[0] == 5])
    # a version without its documents doesn't count
    os.remove(os.path.join(path, "documents", "version=4", "_SUCCESS"))
    assert got(every_chunk(spark, path)) == chunks_of(left)


def test_changed_and_missing_sources(spark, tmp_dir):
    docs, path = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "index")
    spark.createDataFrame([(1, "river stone one"), (2, "river stone two")], "doc_id bigint, text string").coalesce(1).write.parquet(docs)
    add_documents(located_documents(spark, docs), 40, path)
    (file,) = [f for f in os.listdir(docs) if f.endswith(".parquet")]
    import pyarrow as pa
    import pyarrow.parquet as pq
    name = os.path.join(docs, file)
    crc = os.path.join(docs, f".{file}.crc")
    if os.path.exists(crc):
        os.remove(crc)

    def reasons():
        return {r.doc_id: (r.content, r.reason) for r in every_chunk(spark, path).collect()}
    pq.write_table(pa.table({"doc_id": [1, 2], "text": ["river stone one", "something else"]}), name)
    assert reasons() == {1: (b"river stone one", None), 2: (None, STALE)}
    pq.write_table(pa.table({"doc_id": [1], "text": ["river stone one"]}), name)
    assert reasons() == {1: (b"river stone one", None), 2: (None, MISSING)}
    os.remove(name)
    assert reasons() == {1: (None, MISSING), 2: (None, MISSING)}


def test_sketches_of_parts(spark, tmp_dir):
    rows = spark.range(60_000).select(
        (F.col("id") % 500).alias("doc_id"), (F.col("id") / 500).cast("int").alias("chunk_idx"), F.lit(10).alias("size"), F.lit(2).alias("n_words"),
        F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % 3 == 1, "fr").alias("lang"), F.lit("s").alias("source"),
        F.when(F.col("id") % 7 == 0, F.lit(-1)).otherwise(F.xxhash64(F.col("id") % 30_000)).alias("hash"))
    for i in range(3):
        write_sketches(rows.where(F.col("doc_id") % 3 == i), tmp_dir + "/s", str(i))
    write_sketches(rows.where("doc_id % 3 = 1"), tmp_dir + "/s", "1")        # tried again: nothing is counted twice
    exact = {(r.lang, r.source): r for r in content_distribution(rows).collect()}
    found = sketched_distribution(spark, tmp_dir + "/s", 2).collect()
    assert len(found) == len(exact) == 3
    for r in found:
        e = exact[r.lang, r.source]
        assert (r.n_chunks, r.n_bytes) == (e.n_chunks, e.n_bytes)
        assert abs(r.n_distinct_hashes - e.n_distinct_hashes) < 0.04 * e.n_distinct_hashes
        assert r.top[0]["item"] == -1 and abs(r.top[0]["count"] - e.largest_bucket) < 0.002 * e.n_chunks
