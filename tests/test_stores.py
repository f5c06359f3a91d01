"""The file data source, the bucketed index, searches at many lengths."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from simdex.functions.chunk_votes import WordBits
from simdex.functions.simhash import with_simhash
from simdex.operators.index import build_index
from simdex.plans.search import _hits, search_corpus
from simdex.sources import file_source
from simdex.sources.bucketed_store import _table_name, lookup_bucketed, read_bucketed, write_bucketed
from simdex.sources.documents import scan_files
from simdex.sources.index_store import IndexReadError
from simdex.sources.ranged_files import read_file_chunks

from .conftest import docs_df

CHUNKS = "doc_id bigint, chunk_size int, chunk_idx int, offset bigint, size int, n_words int, hash bigint"


@pytest.fixture()
def raw_files(tmp_dir):
    rng = random.Random(5)
    for name, n in (("a.txt", 5000), ("b c.txt", 64), ("empty.txt", 0), ("_hidden.txt", 90), (".dot.txt", 90), ("x.log", 70),
                    ("sub/a.txt", 333)):
        os.makedirs(os.path.dirname(os.path.join(tmp_dir, name)), exist_ok=True)
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(rng.randbytes(n))
    return tmp_dir


@pytest.mark.parametrize("stride, recursive", [(None, False), (24, True), (100, True)])
def test_file_source_equals_ranged_files(spark, raw_files, stride, recursive):
    got = file_source.read_chunks(spark, raw_files, 64, stride=stride, glob="*.txt", recursive=recursive, range_bytes=700)
    want = read_file_chunks(spark, raw_files, 64, stride=stride, glob="*.txt", recursive=recursive, range_bytes=700)
    assert got.columns == want.columns

    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    assert rows(got) == rows(want)
    assert got.rdd.getNumPartitions() > 7        # the file of 5,000 bytes alone has 8 ranges
    names = {r.path for r in scan_files(spark, raw_files, glob="*.txt", recursive=recursive).collect()}
    assert {r.path for r in got.collect()} == {p for p in names if not p.endswith("empty.txt")}


def test_file_source_opens_no_file_without_chunk(spark, raw_files):
    slim = file_source.read_chunks(spark, raw_files, 64, columns=("offset", "size"))
    full = file_source.read_chunks(spark, raw_files, 64)
    assert slim.columns == ["doc_id", "path", "offset", "size"]
    want = sorted((r.path, r.offset, len(r.chunk)) for r in full.collect())
    assert sorted((r.path, r.offset, r["size"]) for r in slim.collect()) == want
    os.truncate(os.path.join(raw_files, "a.txt"), 5000)
    reader = file_source.FileChunkReader(slim.drop("doc_id").schema, {"path": raw_files, "chunk_size": "64"})
    gone = file_source.FileRange("file:/no/such/file", 130, 0, 130)
    assert [b.column("size").to_pylist() for b in reader.read(gone)] == [[64, 64, 2]]
    with pytest.raises(FileNotFoundError):
        next(iter(file_source.FileChunkReader(full.drop("doc_id").schema, {"path": raw_files, "chunk_size": "64"}).read(gone)))


def test_file_source_rejects(spark, tmp_dir):
    file_source.register(spark)
    empty = spark.read.format("file_chunks").option("chunk_size", 8).load(tmp_dir)
    assert empty.count() == 0
    for options, path in (({}, tmp_dir), ({"chunk_size": 0}, tmp_dir), ({"chunk_size": 8}, tmp_dir + "/none")):
        with pytest.raises(Exception):
            spark.read.format("file_chunks").options(**options).load(path).collect()


def test_bucketed_lookup(spark, tmp_dir):
    rng = random.Random(8)
    hashes = [rng.getrandbits(62) for _ in range(300)] + [-1] * 500 + [0] * 3 + [77] * 41
    rows = [(i // 9, 16, i % 9, i % 9 * 16, 16, 3, h) for i, h in enumerate(hashes)]
    path = os.path.join(tmp_dir, "bucketed")
    chunks = spark.createDataFrame(rows, CHUNKS)
    with pytest.raises(IndexReadError):
        read_bucketed(spark, path)
    table = write_bucketed(chunks, path, 8, hot_rows=40)
    # the hot hash lies in several buckets, every other hash at one place
    salts = {r.hash: r.n for r in table.groupBy("hash").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts.pop(-1) == 13 and salts.pop(77) == 2 and set(salts.values()) == {1}
    asked = [("hot", -1), ("warm", 77), ("zero", 0), ("none", 5), ("null", None)] + [(str(i), hashes[i]) for i in range(50)]
    queries = spark.createDataFrame(asked, "query_id string, qhash bigint")
    want = sorted((q, r[0], r[2]) for q, h in asked if h for r in rows if r[6] == h)
    for limit in (None, 0):
        got = lookup_bucketed(table, queries, max_bytes=limit)
        assert sorted((r.query_id, r.doc_id, r.chunk_idx) for r in got.collect()) == want


def test_bucketed_index_is_not_moved(spark, tmp_dir):
    chunks = spark.range(20000).select((F.col("id") % 100).alias("doc_id"), F.lit(8).alias("chunk_size"),
                                       (F.col("id") / 100).cast("int").alias("chunk_idx"), (F.col("id") * 8).alias("offset"),
                                       F.lit(8).alias("size"), F.lit(1).alias("n_words"), F.xxhash64("id").alias("hash"))
    path = os.path.join(tmp_dir, "bucketed")
    write_bucketed(chunks, path, 8)
    # a session that knows the folder only: the table is declared anew
    spark.sql(f"DROP TABLE {_table_name(path)}")
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = read_bucketed(other, path)
    queries = other.range(5000).select(F.col("id").cast("string").alias("query_id"), F.xxhash64("id").alias("qhash"))
    hits = lookup_bucketed(table, queries, max_bytes=0)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    left = plan[plan.index("SortMergeJoin"):]
    scan = left.index("Bucketed: true")
    assert "Exchange" not in left[:scan]          # between the join and the index's scan
    assert hits.count() == 5000


def test_search_at_many_lengths(spark):
    rng = random.Random(2)
    words = ["river", "stone", "über", "x", "longer_word_here", "42", "-", "\n"]
    texts = {i: " ".join(rng.choices(words, k=rng.randint(1, 60))) for i in range(1, 9)}
    texts[9] = "word"
    docs = docs_df(spark, texts)
    asked = [(f"{i}-{n}", t.encode()[:n].decode(errors="ignore")) for i, t in texts.items() for n in (3, 17, 40, 90, 10 ** 6)]
    asked.append(("long", texts[1] + " tail" * 3))
    asked = [a for a in asked if a[1]]
    queries = spark.createDataFrame(asked, "query_id string, text string")
    got = search_corpus(docs, queries, 12, scope="file")
    hashed = with_simhash(queries, "text", "qhash").collect()
    want = set()
    for size in sorted({len(a[1].encode()) for a in asked}):
        chunks = build_index(docs, size).collect()
        for q in hashed:
            if len(q.text.encode()) == size and q.qhash:
                for c in chunks:
                    d = ((c.hash ^ q.qhash) & ((1 << 64) - 1)).bit_count()
                    if d <= 12:
                        want.add((q.query_id, c.doc_id, c.chunk_idx, d))
    exact = {w[:2] for w in want if w[3] == 0}
    want = {w for w in want if w[3] == 0 or w[:2] not in exact}
    assert {(r.query_id, r.doc_id, r.chunk_idx, r.distance) for r in got.collect()} == want


def test_time_does_not_follow_the_number_of_lengths():
    rng = np.random.default_rng(4)
    content = b" ".join(rng.choice([b"river", b"stone", b"under", b"hill"], 500))
    took = []
    for n in (200, 20_000):
        sizes = np.sort(rng.choice(np.arange(300, 300_000), n, replace=False))
        hashes = rng.integers(-2 ** 62, 2 ** 62, n)
        bits, best = WordBits(), 9.0
        for _ in range(3):
            t = time.perf_counter()
            _hits(content, sizes, np.arange(n + 1), sizes, hashes, 10, bits)
            best = min(best, time.perf_counter() - t)
        took.append(best)
    assert took[1] < 20 * took[0]                  # a hundred times the lengths


@pytest.mark.parametrize("folder", [False, True])
def test_stream_of_a_table(spark, tmp_dir, folder):
    """The streamed table is one file or a folder of part files."""
    import shutil

    from simdex import queries
    rows = spark.createDataFrame([(i, f"text number {i} " * 60) for i in range(9)] + [(9, None)], "doc_id bigint, text string")
    rows.coalesce(1 if not folder else 3).write.parquet(f"{tmp_dir}/{'documents.parquet' if folder else 'part'}")
    if not folder:
        part = next(n for n in os.listdir(f"{tmp_dir}/part") if n.endswith(".parquet"))
        shutil.copy(f"{tmp_dir}/part/{part}", f"{tmp_dir}/documents.parquet")
    got = queries.QUERIES["incremental_index"](spark, tmp_dir)
    want = queries.QUERIES["simhash_chunks"](spark, tmp_dir).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() >= 18


def test_hits_are_sent_on_as_they_come():
    """Many hits of long texts: no batch holds more than the bound and a row, and no hit is lost."""
    import pyarrow as pa

    from simdex.functions.chunk_votes import chunk_hashes
    from simdex.plans.search import _answers
    text = b"one two three four five " * 400
    n, docs = len(text), pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "content": [text] * 6})
    own = next(chunk_hashes(text, np.array([n]), WordBits()))[2]
    ids, sizes, hashes = [f"q{i}" for i in range(30)], np.full(30, n), np.repeat(own, 30)
    got = list(_answers(iter([docs]), ids, sizes, hashes, 3, "file", "string", 100_000))
    assert max(b.nbytes for b in got) < 100_000 + 2 * n and sum(b.num_rows for b in got) == 180
    assert all(set(b.column("match_type").to_pylist()) <= {"exact"} for b in got)


def test_many_ranges_share_partitions(spark, tmp_dir, monkeypatch):
    """Ranges beyond the bound are read together: the same rows from fewer tasks."""
    for i in range(40):
        with open(os.path.join(tmp_dir, f"f{i}.txt"), "wb") as f:
            f.write(bytes([65 + i % 26]) * (50 + 7 * i))
    options = {"path": tmp_dir, "chunk_size": "16", "range_bytes": "32"}
    schema = file_source.read_chunks(spark, tmp_dir, 16).drop("doc_id").schema
    reader = file_source.FileChunkReader(schema, options)

    def rows():
        return [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    want, before = rows(), len(reader.partitions())
    monkeypatch.setattr(file_source, "MAX_PARTITIONS", 9)
    assert before > 200 and len(reader.partitions()) <= 9 and rows() == want


@pytest.mark.parametrize("k", [0, 3, 10, 64])
def test_judged_chunks_lose_no_hit(k, monkeypatch):
    """Chunks left out before their cut words are hashed are none within k: cut and long words, none, short lengths."""
    from simdex.functions import chunk_votes
    from simdex.plans import search
    rng = random.Random(k)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 6, 9, 70]))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(300)).encode() for _ in range(6)] + [b"?! " * 90, b"x" * 500, b"a"]
    asked = []
    for _ in range(60):
        t, n = rng.choice(texts), rng.choice([1, 5, 16, 40, 64, 90, 200, 333, 900])
        at = rng.randrange(max(1, len(t) - n))
        asked.append(t[at // n * n:at // n * n + n])
    sizes = np.array(sorted(map(len, asked)))
    asked.sort(key=len)
    hashes = np.concatenate([next(chunk_votes.chunk_hashes(a, np.array([len(a)]), WordBits()))[2] for a in asked])
    lengths, first = np.unique(sizes, return_index=True)
    monkeypatch.setattr(chunk_votes, "SLICE_BYTES", 400)
    got = []
    for few in (100, 0):
        monkeypatch.setattr(search, "FEW_QUERIES", few)
        got.append([sorted(h for part in _hits(t, lengths, np.append(first, len(sizes)), sizes, hashes, k, WordBits())
                           for h in zip(*(c.tolist() for c in part))) for t in texts])
    assert got[0] == got[1] and sum(map(len, got[0])) >= 60
    # each hit's fingerprint is that of its bytes alone
    for t, hits in zip(texts, got[0]):
        for _, n, c, h, d in hits[:40]:
            piece = t[c * n:(c + 1) * n]
            assert next(chunk_votes.chunk_hashes(piece, np.array([len(piece)]), WordBits()))[2][0] == h


@pytest.mark.parametrize("scope", ["file", "corpus"])
def test_many_queries_of_a_length(scope, monkeypatch):
    """Chunks asked by bands, some documents at a time, have the hits of one by one; those kept as exact are the same, fewer rows."""
    import pyarrow as pa

    from simdex.functions.chunk_votes import chunk_hashes
    from simdex.plans import search
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.choice([2, 4, 7]))) for _ in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 60, 200]))).encode() for _ in range(25)]
    texts += [texts[3], texts[3], texts[0] * 3, b"", None, b"?" * 100]
    asked = sorted([t[a:a + n] for t in texts if t for n in (30, 64, 2000) for a in range(0, min(len(t), 5 * n), n)], key=len)
    sizes = np.array([30 if len(a) < 30 else len(a) for a in asked], np.int64)
    order = np.argsort(sizes, kind="stable")
    hashes = np.concatenate([next(chunk_hashes(a, np.array([len(a)]), WordBits()))[2] for a in asked])
    ids, sizes, hashes = [f"q{i}" for i in order], sizes[order], hashes[order]
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "content": texts}, pa.schema([("doc_id", pa.int64()), ("content", pa.binary())]))

    def rows(**kw):
        return [r for b in search._answers(iter([docs, docs.slice(5, 9)]), ids, sizes, hashes, 10, scope, "string", 5000, **kw)
                for r in zip(*b.to_pydict().values())]
    monkeypatch.setattr(search, "MANY_QUERIES", 10 ** 9)
    want = rows()
    exact = rows(exact_only=True)
    assert sorted(exact) == sorted(r for r in want if r[8] == "exact") and len(exact) < len(want)
    for most, waiting in ((2, 1), (30, 3000), (30, 1 << 22)):
        monkeypatch.setattr(search, "MANY_QUERIES", most)
        monkeypatch.setattr(search, "WAITING_BYTES", waiting)
        asked_by_bands = []
        monkeypatch.setattr(search.ManyQueries, "hits", lambda self, *a, f=search.ManyQueries.hits: asked_by_bands.append(a) or f(self, *a))
        assert sorted(rows()) == sorted(want) and sorted(rows(exact_only=True)) == sorted(exact) and asked_by_bands
        monkeypatch.undo()
        monkeypatch.setattr(search, "MANY_QUERIES", 10 ** 9)


def test_hits_of_a_document_by_place(monkeypatch):
    """Pieces that overlap are sent one after another, whatever their lengths; no hit is lost when they are sorted in parts."""
    import pyarrow as pa

    from simdex.functions.chunk_votes import chunk_hashes
    from simdex.plans import search
    rng = random.Random(8)
    text = " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(400)).encode()
    asked = sorted((text[a:a + n] for n in range(100, 400, 17) for a in (0, n, 2 * n)), key=len)
    sizes = np.array([len(a) for a in asked])
    hashes = np.concatenate([next(chunk_hashes(a, np.array([len(a)]), WordBits()))[2] for a in asked])
    docs = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "content": [text, text[::-1]]})

    def rows():
        return [r for b in search._answers(iter([docs]), list(map(str, range(len(asked)))), sizes, hashes, 10, "file", "string")
                for r in zip(*b.to_pydict().values())]
    got = rows()
    for doc in (1, 2):
        places = [(r[4], r[0]) for r in got if r[2] == doc]
        assert places == sorted(places)
    assert len({r[0] for r in got}) > 10 and len(got) > 60
    monkeypatch.setattr(search, "SORTED_HITS", 20)
    assert sorted(rows()) == sorted(got)
