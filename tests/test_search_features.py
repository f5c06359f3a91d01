"""Nearest chunks at any distance, stored band tables, passages, links of near groups, plan choice."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from simdex.operators.hamming_join import band_layout, hamming_pairs, nested_is_cheaper
from simdex.operators.lookup import hash_pairs, lookup, lookup_exact, nearest
from simdex.plans.dedup import near_links
from simdex.plans.plagiarism import plagiarism_passages
from simdex.sources.band_store import band_pairs, read_bands, write_bands
from simdex.sources.index_store import IndexReadError, read_index, write_index

from .conftest import docs_df

CHUNKS = "doc_id bigint, chunk_idx int, offset bigint, size int, n_words int, hash bigint, chunk_size int"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def apart(a, b):
    return ((a ^ b) & ((1 << 64) - 1)).bit_count()


def near_hash(rng, h, bits):
    for b in rng.sample(range(64), bits):
        h ^= 1 << b
    return h


def chunk_rows(hashes):
    return [(i // 7, i % 7, i % 7 * 10, 10, 2, signed(h), 10) for i, h in enumerate(hashes)]


@pytest.fixture(scope="module")
def hashes():
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(60)]
    return base + [near_hash(rng, rng.choice(base), rng.randint(0, 25)) for _ in range(300)] + [base[0]] * 20 + [0, (1 << 64) - 1]


def test_nearest_any_distance(spark, hashes):
    rng = random.Random(3)
    chunks = spark.createDataFrame(chunk_rows(hashes), CHUNKS)
    asked = [("far", rng.getrandbits(64)), ("copy", hashes[0]), ("zero", 0), ("twin", hashes[0]), ("near", near_hash(rng, hashes[5], 12)),
             ("none", None)]
    queries = spark.createDataFrame([(q, None if h is None else signed(h)) for q, h in asked], "query_id string, qhash bigint")
    got = sorted((r.query_id, r["rank"], r.distance, r.doc_id, r.offset) for r in nearest(chunks, queries, 7).collect())
    want = []
    for q, h in asked:
        if h:
            best = sorted((apart(signed(h), r[5]), r[0], r[2]) for r in chunk_rows(hashes))[:7]
            want += [(q, i, *b) for i, b in enumerate(best, 1)]
    assert got == sorted(want)
    few = spark.createDataFrame(chunk_rows(hashes[:3]), CHUNKS)
    assert nearest(few, queries.where("query_id = 'far'"), 7).count() == 3
    assert nearest(few.limit(0), queries, 7).count() == 0 and nearest(few, queries.limit(0), 7).count() == 0


@pytest.mark.parametrize("k", [0, 2, 10])
def test_stored_bands(spark, hashes, tmp_dir, k):
    chunks = spark.createDataFrame(chunk_rows(hashes), CHUNKS)
    path = f"{tmp_dir}/i.idx"
    write_index(chunks.where("doc_id < 30"), path, bands=True)
    write_bands(chunks.where("doc_id >= 30"), path, "more")
    queries = spark.createDataFrame([(str(i), signed(h)) for i, h in enumerate(hashes[:40])], "query_id string, qhash bigint")
    got = sorted(map(tuple, band_pairs(read_bands(spark, path), queries, k).collect()))
    assert got == sorted(map(tuple, hash_pairs(chunks, queries, k, strategy="banded").collect())) and got
    again = lookup(chunks, queries, k, bands=read_bands(spark, path)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, lookup(chunks, queries, k).collect()))


def test_stored_bands_read_named_partitions_only(spark, hashes, tmp_dir):
    path = f"{tmp_dir}/i.idx"
    write_index(spark.createDataFrame(chunk_rows(hashes), CHUNKS), path, bands=True)
    query = spark.createDataFrame([(signed(hashes[3]),)], "qhash bigint")
    found = band_pairs(read_bands(spark, path), query, 0)
    plan = found._jdf.queryExecution().toString()
    filters = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert any("band" in f and "prefix" in f and f"= {(hashes[3] & 0xFFFF) >> 12})" in f for f in filters), filters
    with pytest.raises(IndexReadError):
        read_bands(spark, f"{tmp_dir}/none")
    with pytest.raises(ValueError):
        band_pairs(read_bands(spark, path), query, 40)


def test_failed_write_keeps_the_index(spark, hashes, tmp_dir):
    path = f"{tmp_dir}/i.idx"
    chunks = spark.createDataFrame(chunk_rows(hashes), CHUNKS)
    write_index(chunks, path)
    broken = chunks.withColumn("size", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_index(broken, path)
    assert read_index(spark, path).count() == len(hashes)
    write_index(read_index(spark, path).where("doc_id < 2"), path)   # an index may be rewritten from itself
    assert read_index(spark, path).count() == 14


def test_corpus_scope_asks_only_for_the_rest(spark, hashes):
    chunks = spark.createDataFrame(chunk_rows(hashes), CHUNKS)
    queries = spark.createDataFrame([("a", signed(hashes[0])), ("b", signed(near_hash(random.Random(1), hashes[1], 2)))],
                                    "query_id string, qhash bigint")
    got = lookup(chunks, queries, 10, scope="corpus").collect()
    assert {r.match_type for r in got if r.query_id == "a"} == {"exact"}
    assert {r.match_type for r in got if r.query_id == "b"} == {"fuzzy"}
    only = queries.where("query_id = 'a'")
    key = lambda rows: sorted(map(tuple, rows))
    assert key(lookup(chunks, only, 10, scope="corpus").collect()) == key(lookup_exact(chunks, only).collect())


def test_passages(spark):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))
    ref = text(100)                               # 599 bytes
    filler = text(30)
    copied = ref[120:480]
    docs = {1: filler[:77] + copied + filler, 2: text(60), 3: ref, 4: copied[:120] + "x" * 500 + copied[240:]}
    got = plagiarism_passages(docs_df(spark, {7: ref}), docs_df(spark, docs), chunk_size=60, stride=1, k=0).collect()
    by_doc = {d: sorted((r.doc_from, r.doc_to, r.ref_from, r.ref_to, r.chunks) for r in got if r.doc_id == d) for d in docs}
    assert by_doc[1] == [(77, 77 + 360, 120, 480, 6)] and by_doc[2] == []
    assert by_doc[3] == [(0, 599, 0, 599, 10)]
    assert by_doc[4] == [(0, 120, 120, 240, 2), (620, 740, 360, 480, 2)]
    assert all(r.ref_id == 7 and r.mean_distance == 0 for r in got)


def test_links_connect_what_pairs_connect(spark, hashes):
    h = sorted({signed(x) for x in hashes})
    df = spark.createDataFrame([(x,) for x in h], "hash bigint")
    links = [tuple(r) for r in near_links(df, 10).collect()]
    assert all(apart(a, b) <= 10 for a, b in links)

    def classes(edges):
        root = {x: x for x in h}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            root[find(a)] = find(b)
        out = {}
        for x in h:
            out.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, out.values()))
    assert classes(links) == classes((a, b) for a, b in itertools.combinations(h, 2) if apart(a, b) <= 10)


def test_links_of_a_large_group(spark):
    """4,000 hashes of one group: links grow with them, not with their pairs."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    h = {signed(near_hash(rng, centre, 4)) for _ in range(4_000)}
    links = near_links(spark.createDataFrame([(x,) for x in h], "hash bigint"), 10)
    found = [tuple(r) for r in links.collect()]
    assert len(h) > 3_900 and len(found) < 12 * len(h)
    root = {x: x for x in h}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for x, y in found:
        assert apart(x, y) <= 10
        root[find(x)] = find(y)
    assert len({find(x) for x in h}) == 1


def test_plan_choice(spark):
    assert nested_is_cheaper(10, 20_000, 20_000) and nested_is_cheaper(10, 40, 1_000_000)
    assert not nested_is_cheaper(10, 10**6, 10**6) and not nested_is_cheaper(0, 10**5, 10**5)
    rng = random.Random(6)
    h = [rng.getrandbits(64) for _ in range(300)]
    h += [near_hash(rng, x, rng.randint(0, 14)) for x in h]
    left = spark.createDataFrame([(signed(x), i) for i, x in enumerate(h)], "hash bigint, i int").dropDuplicates(["hash"])
    right = left.select(F.col("hash").alias("qhash"), F.col("i").alias("j"))
    rows = [sorted(map(tuple, hamming_pairs(left, right, 10, strategy=s, ordered=("i", "j")).collect()))
            for s in ("auto", "nested", "banded")]
    assert rows[0] == rows[1] == rows[2] and rows[0]
    assert sum((r + 1) for _, _, r in band_layout(10, 10**6, 10**6)) == 11
