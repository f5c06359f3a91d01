import os
import random

from pyspark.sql import functions as F

from simdex.operators.index import build_index
from simdex.plans.dedup import dedup_documents, near_duplicate_pairs
from simdex.plans.graph import connected_components
from simdex.plans.plagiarism import plagiarism_matches
from simdex.plans.search import search_corpus, search_text
from simdex.sources.documents import scan_files
from simdex.sources.index_store import IndexReadError, read_index, write_index
from tests.conftest import docs_df
from tests.samples import ORIGINAL, EDITED

FILLER = ("Completely unrelated words about harbours, engines, winter gardens and "
          "railway timetables fill this paragraph so the documents differ. ")


def test_search_text_finds_passage(spark):
    doc = ORIGINAL + FILLER * 3
    docs = docs_df(spark, {1: doc, 2: FILLER * 4})
    hits = search_text(docs, ORIGINAL).collect()
    assert [(r.doc_id, r.offset, r.distance, r.match_type) for r in hits] == [(1, 0, 0, "exact")]
    assert bytes(hits[0].content).decode() == ORIGINAL


def test_search_plagiarized_is_fuzzy(spark):
    docs = docs_df(spark, {1: ORIGINAL})
    hits = search_corpus(docs, spark.createDataFrame([("p", EDITED)], "query_id string, text string"),
                         10).collect()
    assert [(r.offset, r.distance, r.match_type) for r in hits] == [(0, 5, "fuzzy")]
    assert search_corpus(docs, spark.createDataFrame([("p", EDITED)],
                                                     "query_id string, text string"), 3).count() == 0


def test_connected_components_brute_force(spark):
    rnd = random.Random(7)
    nodes = list(range(60))
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(40, 55)]
    comp = {n: n for n in nodes}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        comp[max(ra, rb)] = min(ra, rb)
    expect = {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}
    N = spark.createDataFrame([(n,) for n in nodes], "node bigint")
    E = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = {r.node: r.component for r in connected_components(N, E).collect()}
    assert got == expect


def test_dedup_groups_copies(spark):
    a = ORIGINAL + " " + FILLER
    docs = docs_df(spark, {1: a, 2: a, 3: a.replace("evening", "early"), 4: FILLER * 2 + "tail words here",
                           5: "!!!"})
    pairs = near_duplicate_pairs(docs, 10).collect()
    kinds = sorted((r.doc_a, r.doc_b, r.kind) for r in pairs)
    assert (1, 2, "exact") in kinds
    groups = {r.doc_id: (r.group_id, r.keep) for r in dedup_documents(docs, 10).collect()}
    assert groups[1] == (1, True) and groups[2] == (1, False)
    assert groups[4] == (4, True) and groups[5] == (5, True)


def test_plagiarism_scores(spark):
    refs = docs_df(spark, {100: ORIGINAL})
    subs = docs_df(spark, {1: ORIGINAL + FILLER, 2: FILLER * 3})
    rows = plagiarism_matches(refs, subs, chunk_size=64).collect()
    assert {r.doc_id for r in rows} == {1}
    r = rows[0]
    assert r.ref_id == 100 and r.matched_chunks >= 4 and r.min_distance == 0


def test_index_store_roundtrip_and_errors(spark, tmp_dir):
    docs = docs_df(spark, {1: ORIGINAL, 2: EDITED})
    idx = build_index(docs, 64)
    path = write_index(idx, os.path.join(tmp_dir, "sample.idx"))
    back = read_index(spark, path)
    cols = ["doc_id", "chunk_idx", "offset", "size", "n_words", "hash", "chunk_size"]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, idx.select(*cols).collect()))
    assert read_index(spark, path, chunk_size=128).count() == 0
    for bad in ("", os.path.join(tmp_dir, "missing.idx")):
        try:
            read_index(spark, bad)
            raise AssertionError("expected an error")
        except IndexReadError:
            pass
    corrupt = os.path.join(tmp_dir, "corrupt.idx")
    with open(corrupt, "wb") as f:
        f.write(b"corrupted data")
    empty_dir = os.path.join(tmp_dir, "empty.idx")
    os.makedirs(empty_dir)
    open(os.path.join(empty_dir, "part-0.parquet"), "wb").close()
    for bad in (corrupt, empty_dir):
        try:
            read_index(spark, bad)
            raise AssertionError("expected an error")
        except IndexReadError:
            pass


def test_scan_files(spark, tmp_dir):
    for name, text in (("a.txt", ORIGINAL), ("b.txt", "Hello, world! This is a test file.")):
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    files = scan_files(spark, tmp_dir, glob="*.txt")
    idx = build_index(files, 10, keep=("doc_id", "path"))
    sizes = {os.path.basename(r.path): r.n for r in idx.groupBy("path").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"a.txt": 33, "b.txt": 4}


def test_stream_index_equals_batch(spark, tmp_dir):
    from simdex.streaming.incremental import document_stream, incremental_index
    src = os.path.join(tmp_dir, "in")
    rows = [(i, t) for i, t in enumerate([ORIGINAL, EDITED, FILLER * 5])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(os.path.join(src, "b1"))
    schema = spark.read.parquet(os.path.join(src, "b1")).schema
    stream = document_stream(spark, os.path.join(src, "*"), schema)
    q = incremental_index(stream, 64, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination()
    got = read_index(spark, os.path.join(tmp_dir, "out"))
    batch = build_index(docs_df(spark, dict(rows)), 64)
    cols = ["doc_id", "chunk_idx", "offset", "size", "hash"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def test_ranged_file_chunks_equal_whole_file(spark, tmp_dir):
    from simdex.operators.index import index_chunks
    from simdex.sources.ranged_files import read_file_chunks
    texts = {"a.txt": (ORIGINAL + FILLER) * 7, "b.txt": "Hello, world! This is a test file.",
             "c.txt": ""}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    cols = ["doc_id", "chunk_idx", "offset", "size", "n_words", "hash"]
    for size, stride in ((64, None), (50, 20)):
        whole = build_index(scan_files(spark, tmp_dir, glob="*.txt"), size, stride=stride)
        ranged = index_chunks(read_file_chunks(spark, tmp_dir, size, stride=stride, glob="*.txt",
                                               range_bytes=3 * (stride or size)))
        assert sorted(map(tuple, ranged.select(*cols).collect())) == \
            sorted(map(tuple, whole.select(*cols).collect()))


def test_search_in_several_length_passes(spark):
    docs = docs_df(spark, {1: ORIGINAL + FILLER, 2: FILLER + ORIGINAL})
    texts = [("a", ORIGINAL[:40]), ("b", ORIGINAL[:64]), ("c", FILLER[:50]), ("d", ORIGINAL)]
    q = spark.createDataFrame(texts, "query_id string, text string")
    one = search_corpus(docs, q, 10, with_content=False).collect()
    many = search_corpus(docs, q, 10, with_content=False, block_rows=1).collect()
    key = lambda r: (r.query_id, r.doc_id, r.offset, r.distance)
    assert sorted(map(key, one)) == sorted(map(key, many))
    assert {r.query_id for r in one} >= {"a", "d"}


def test_components_of_long_shuffled_chains(spark):
    from simdex.plans.graph import star_components
    for n in (80, 5000):
        number = lambda c: (c * 7919 + 13) % 1000003
        edges = spark.range(n - 1).select(number(F.col("id")).alias("src"), number(F.col("id") + 1).alias("dst"))
        found, rounds = star_components(edges)
        least = min((i * 7919 + 13) % 1000003 for i in range(n))
        assert found.count() == n and {r.component for r in found.select("component").distinct().collect()} == {least}
        assert rounds < 30


def test_append_keeps_earlier_rows(spark, tmp_dir):
    from simdex.streaming.incremental import document_stream, incremental_index
    out, ckpt, src = (os.path.join(tmp_dir, n) for n in ("out", "ckpt", "in"))
    write_index(build_index(docs_df(spark, {0: ORIGINAL, 1: FILLER}), 64), out)
    rows = {2: EDITED, 3: FILLER * 5, 4: "tail"}
    for i, t in rows.items():
        spark.createDataFrame([(i, t)], "doc_id bigint, text string").write.parquet(os.path.join(src, f"b{i}"))
        stream = document_stream(spark, os.path.join(src, "*"), "doc_id bigint, text string")
        incremental_index(stream, 64, out, ckpt).awaitTermination()
    whole = build_index(docs_df(spark, {0: ORIGINAL, 1: FILLER, **rows}), 64)
    cols = ["doc_id", "chunk_idx", "offset", "size", "hash"]
    want = sorted(map(tuple, whole.select(*cols).collect()))
    assert sorted(map(tuple, read_index(spark, out).select(*cols).collect())) == want
    # an unfinished part doesn't count
    from simdex.sources.index_store import write_part
    write_part(build_index(docs_df(spark, {9: "x"}), 64), out, "late")
    os.remove(os.path.join(out, "part=late", "_SUCCESS"))
    assert sorted(map(tuple, read_index(spark, out).select(*cols).collect())) == want


def test_wordless_texts_match_nothing(spark):
    refs = docs_df(spark, {100: "!!! ...", 101: "\u4e2d\u6587"})
    subs = docs_df(spark, {1: "??? !!!", 2: "..."})
    assert plagiarism_matches(refs, subs, chunk_size=4).count() == 0


def test_unanswered_texts(spark):
    from simdex.plans.search import unanswered
    q = spark.createDataFrame([("a", ORIGINAL), ("b", None), ("c", ""), ("d", "nothing of the kind " * 4)],
                              "query_id string, text string")
    hits = search_corpus(docs_df(spark, {1: ORIGINAL}), q, 3)
    assert sorted(map(tuple, unanswered(q, hits).collect())) == [
        ("b", "search text is missing"), ("c", "search text is empty"), ("d", "no matches found")]


def test_search_reads_the_corpus_once_and_writes_nothing(spark, tmp_dir):
    docs_df(spark, {1: ORIGINAL, 2: FILLER}).write.parquet(os.path.join(tmp_dir, "docs"))
    docs = spark.read.parquet(os.path.join(tmp_dir, "docs"))
    q = spark.createDataFrame([("a", ORIGINAL), ("b", FILLER[:30])], "query_id string, text string")
    plan = search_corpus(docs, q, scope="file")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "Join" not in plan


def test_drop_duplicates_keeps_one_of_a_group(spark):
    from simdex.plans.dedup import drop_duplicates
    docs = docs_df(spark, {1: ORIGINAL, 2: ORIGINAL, 3: FILLER})
    assert sorted(r.doc_id for r in drop_duplicates(docs, dedup_documents(docs)).collect()) == [1, 3]


def test_size_checks_have_no_single_partition(spark):
    from simdex.operators import sizing
    small = sizing.stored(spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("t")))
    assert sizing.is_small(small) and not sizing.is_small(small, 100)
    joined = sizing.join_small(spark.range(100).select(F.col("id").alias("k")), small, "k", max_bytes=100)
    assert "SinglePartition" not in joined._jdf.queryExecution().executedPlan().toString()
    path = small._simdex_path.removeprefix("file:")
    assert os.path.isdir(path)
    sizing.drop_stored(small)
    assert not os.path.exists(path)


def test_hits_in_the_last_range_of_a_file(spark, tmp_dir):
    from simdex.operators.index import index_chunks
    from simdex.operators.lookup import lookup
    from simdex.sources.ranged_files import file_content, read_file_chunks
    body = FILLER * 40
    body = body[:len(body) // 64 * 64]
    with open(os.path.join(tmp_dir, "big file.txt"), "w", encoding="utf-8") as f:
        f.write(body + ORIGINAL[:64])
    open(os.path.join(tmp_dir, ".hidden"), "w").close()
    os.makedirs(os.path.join(tmp_dir, "sub"))
    with open(os.path.join(tmp_dir, "sub", "b.txt"), "w") as f:
        f.write("below")
    idx = index_chunks(read_file_chunks(spark, tmp_dir, 64, range_bytes=128))
    assert {r.path for r in idx.select("path").distinct().collect()} == \
        {r.path for r in scan_files(spark, tmp_dir).select("path").collect()}
    read_back = read_index(spark, write_index(idx, os.path.join(tmp_dir, "f.idx")))
    q = build_index(docs_df(spark, {1: ORIGINAL[:64]}), 64).select(F.lit("q").alias("query_id"), F.col("hash").alias("qhash"))
    hits = lookup(read_back, q, 0).join(read_back.select("doc_id", "path").distinct(), "doc_id")
    got = file_content(hits).collect()
    assert [(r.offset, bytes(r.content).decode()) for r in got] == [(len(body), ORIGINAL[:64])]
    assert idx.select("path").distinct().count() == 1
    assert read_file_chunks(spark, tmp_dir, 64, recursive=True).select("path").distinct().count() >= 2


def test_chain_components_far_ids(spark, tmp_dir):
    """Gaps, ids a million apart (their numbers are equal), a repeated and a null id: a row a document."""
    import duckdb

    from simdex import queries
    ids = [*range(30), 44, 45, 1_000_003, 1_000_004, 2_000_007, 90_000_000, 7, None]
    spark.createDataFrame([(i, "x") for i in ids], "doc_id bigint, text string") \
        .repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    want = sorted(con.execute(queries.ORACLE["chain_components"]).fetchall(), key=str)
    got = sorted(map(tuple, queries.QUERIES["chain_components"](spark, tmp_dir).collect()), key=str)
    assert got == want and len(got) == len(ids)
