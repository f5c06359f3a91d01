import random

import pytest

from simdex.operators.hamming_join import hamming_pairs
from simdex.operators.lookup import lookup, lookup_exact, lookup_fuzzy, unmatched_queries
from simdex.operators.results import chunk_content, match_count
from tests.conftest import docs_df

SCHEMA = "doc_id bigint, chunk_idx int, offset bigint, size int, hash bigint"


def index(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def queries(spark, hashes):
    return spark.createDataFrame([(f"q{i}", h) for i, h in enumerate(hashes)],
                                 "query_id string, qhash bigint")


def hits(df):
    return sorted((r.offset, r.size) for r in df.collect())


@pytest.mark.parametrize("strategy", ["nested", "banded"])
def test_exact_first(spark, strategy):
    idx = index(spark, [(1, 0, 10, 100, 100), (1, 1, 110, 200, 100), (1, 2, 210, 300, 110)])
    m = lookup(idx, queries(spark, [100]), 10, strategy=strategy)
    assert hits(m) == [(10, 100), (110, 200)]
    assert hits(lookup_exact(idx, queries(spark, [100]))) == [(10, 100), (110, 200)]


@pytest.mark.parametrize("strategy", ["nested", "banded"])
def test_fuzzy_when_no_exact(spark, strategy):
    idx = index(spark, [(1, 2, 210, 300, 110), (1, 3, 310, 400, 110)])
    m = lookup(idx, queries(spark, [112]), 10, strategy=strategy).collect()
    assert sorted((r.offset, r.distance, r.match_type) for r in m) == [
        (210, 4, "fuzzy"), (310, 4, "fuzzy")]


def test_distance_boundary(spark):
    idx = index(spark, [(1, 0, 0, 10, 0), (1, 1, 10, 10, (1 << 11) - 1)])
    q = queries(spark, [(1 << 10) - 1])  # distance 10 to hash 0, 1 to the other
    got = sorted(r.distance for r in lookup_fuzzy(idx, q, 10).collect())
    assert got == [1, 10]
    q11 = queries(spark, [(1 << 11) - 1 + (1 << 20)])
    assert sorted(r.distance for r in lookup_fuzzy(index(spark, [(1, 0, 0, 10, 0)]), q11, 10)
                  .collect()) == []


def test_empty_index_and_rejected(spark):
    empty = index(spark, [])
    q = queries(spark, [100, 0])
    m = lookup(empty, q, 10)
    assert m.count() == 0
    reasons = sorted((r.qhash, r.reason) for r in unmatched_queries(q, m).collect())
    assert reasons == [(0, "simhash value is required"), (100, "no matches found")]
    counts = {r.query_id: r.n_matches for r in match_count(q, m).collect()}
    assert counts == {"q0": 0, "q1": 0}


def test_far_hash_no_match(spark):
    idx = index(spark, [(1, 0, 0, 10, 0)])
    assert lookup(idx, queries(spark, [-1]), 10).count() == 0


def test_file_scope_vs_corpus_scope(spark):
    idx = index(spark, [(1, 0, 0, 10, 100), (2, 0, 0, 10, 101)])
    q = queries(spark, [100])
    by_file = sorted((r.doc_id, r.match_type) for r in lookup(idx, q, 10, scope="file").collect())
    assert by_file == [(1, "exact"), (2, "fuzzy")]
    corpus = sorted((r.doc_id, r.match_type) for r in lookup(idx, q, 10, scope="corpus").collect())
    assert corpus == [(1, "exact")]


def test_chunk_content(spark):
    docs = docs_df(spark, {7: "Hello, Go! This is a test file."})
    m = spark.createDataFrame([("q", 7, 0, 5), ("q", 7, 7, 3), ("q", 7, 30, 10), ("q", 7, 99, 5)],
                              "query_id string, doc_id bigint, offset bigint, size int")
    got = sorted((r.offset, r.text) for r in chunk_content(m, docs).collect())
    assert got == [(0, "Hello"), (7, "Go!"), (30, "."), (99, "")]


@pytest.mark.parametrize("k", [3, 10, 12])
def test_banded_equals_brute_force(spark, k):
    rnd = random.Random(k)
    base = [rnd.getrandbits(64) for _ in range(30)]
    left = []
    for b in base:
        for _ in range(5):
            v = b
            for bit in rnd.sample(range(64), rnd.randint(0, 14)):
                v ^= 1 << bit
            left.append(v)
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    left = sorted({signed(v) for v in left})
    right = sorted({signed(v) for v in base})
    expect = sorted((a, b) for a in left for b in right
                    if bin((a ^ b) & 0xFFFFFFFFFFFFFFFF).count("1") <= k)
    L = spark.createDataFrame([(v,) for v in left], "hash bigint")
    R = spark.createDataFrame([(v,) for v in right], "qhash bigint")
    for strategy in ("banded", "nested"):
        got = sorted((r.hash, r.qhash) for r in hamming_pairs(L, R, k, strategy=strategy).collect())
        assert got == expect, strategy


def test_banded_expands_smaller_left_side(spark):
    rnd = random.Random(3)
    right = sorted({rnd.getrandbits(63) for _ in range(40)})
    left = sorted({right[i % 40] ^ (1 << rnd.randrange(63)) for i in range(8)})
    expect = sorted((a, b) for a in left for b in right if bin(a ^ b).count("1") <= 10)
    L = spark.createDataFrame([(v,) for v in left], "hash bigint")
    R = spark.createDataFrame([(v,) for v in right], "qhash bigint")
    got = sorted((r.hash, r.qhash) for r in hamming_pairs(L, R, 10, strategy="banded").collect())
    assert got == expect


def test_banded_with_join_keys_equals_nested(spark):
    rnd = random.Random(11)
    rows, qrows = [], []
    for i in range(120):
        size = rnd.choice([64, 128, 256])
        base = rnd.getrandbits(63)
        rows.append((1, i, i * 10, size, base, size))
        if i % 3 == 0:
            flip = base
            for bit in rnd.sample(range(63), rnd.randint(0, 12)):
                flip ^= 1 << bit
            qrows.append((f"q{i}", flip, rnd.choice([64, 128, 256])))
    idx = spark.createDataFrame(rows, "doc_id bigint, chunk_idx int, offset bigint, size int, "
                                      "hash bigint, chunk_size int")
    q = spark.createDataFrame(qrows, "query_id string, qhash bigint, chunk_size int")
    results = {}
    for strategy in ("nested", "banded"):
        for scope in ("file", "corpus"):
            m = lookup(idx, q, 10, scope=scope, on=("chunk_size",), strategy=strategy)
            results[(strategy, scope)] = sorted(
                (r.query_id, r.chunk_idx, r.chunk_size, r.distance) for r in m.collect())
    assert results[("nested", "file")] == results[("banded", "file")]
    assert results[("nested", "corpus")] == results[("banded", "corpus")]
    assert results[("nested", "file")]
    for qid, _, cs, _ in results[("nested", "file")]:
        assert cs == next(r[2] for r in qrows if r[0] == qid)


def test_band_layouts_are_exact_and_get_finer():
    import random as rnd
    from simdex.operators.hamming_join import band_layout, band_masks, candidate_share, layout
    r = rnd.Random(5)
    for k in (0, 3, 10, 12):
        for m in range(1, k + 2):
            bands = layout(m, k)
            assert sum(w for _, w, _ in bands) == 64 and sum(x + 1 for _, _, x in bands) == k + 1
            for _ in range(30):
                d = sum(1 << b for b in r.sample(range(64), r.randint(0, k)))
                assert any(bin(d >> s & (1 << w) - 1).count("1") <= x for s, w, x in bands)
    assert len(band_masks(16, 2)) == 137 and len(set(band_masks(9, 3))) == 130
    shares = [candidate_share(band_layout(10, n, n)) for n in (10**3, 10**4, 10**5)]
    assert shares[0] > shares[1] > shares[2]


def test_banded_join_with_several_layouts(spark, monkeypatch):
    from simdex.operators import hamming_join as hj
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) - (1 << 63) for _ in range(40)]
    near = [b ^ sum(1 << i for i in rnd.sample(range(63), rnd.randint(0, 13))) for b in base]
    L = spark.createDataFrame([(h,) for h in set(base)], "hash bigint")
    R = spark.createDataFrame([(h,) for h in set(near)], "qhash bigint")
    for k, m in ((3, 1), (3, 4), (10, 3), (10, 11), (12, 4)):
        monkeypatch.setattr(hj, "band_layout", lambda k, a, b, m=m: hj.layout(m, k))
        got = sorted((r.hash, r.qhash, r.distance) for r in hamming_pairs(L, R, k, strategy="banded").collect())
        want = sorted((a, b, d) for a in set(base) for b in set(near)
                      if (d := bin((a ^ b) & (1 << 64) - 1).count("1")) <= k)
        assert got == want


def test_exact_first_scopes_differ(spark):
    idx = index(spark, [(1, 0, 0, 10, 7), (2, 0, 0, 10, 6)])
    q = queries(spark, [7])
    by_file = sorted((r.doc_id, r.match_type) for r in lookup(idx, q, 3, scope="file").collect())
    assert by_file == [(1, "exact"), (2, "fuzzy")]
    assert [(r.doc_id, r.match_type) for r in lookup(idx, q, 3, scope="corpus").collect()] == [(1, "exact")]


@pytest.mark.parametrize("k", [0, 3, 10, 20])
def test_near_pairs_in_a_cell(k):
    """Even hashes, hashes that agree in many bits, a repeated hash; a part at a time."""
    import numpy as np

    from simdex.operators import hamming_join as hj
    rng = np.random.default_rng(k)
    b = rng.integers(-2 ** 63, 2 ** 63 - 1, 3_000)
    b[:900] &= 0xFFF
    a = b[rng.integers(0, 3_000, 800)].copy()
    for _ in range(8):
        a ^= np.where(rng.random(800) < .6, np.int64(1) << rng.integers(0, 63, 800), 0)
    apart = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :])
    want = sorted((i, j, int(apart[i, j])) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(apart <= k))))
    assert want
    for bands in ([], hj.layout(1, k) if k < 3 else hj.layout(3, k) if k < 12 else hj.layout(5, k), hj.layout(8, k)):
        hj_bands, hj.cell_bands = hj.cell_bands, lambda *_, bands=bands: bands
        most, hj.PAIRS_AT_A_TIME = hj.PAIRS_AT_A_TIME, 5_000
        try:
            for x, y, flip in ((a, b, False), (b, a, True)):
                got = sorted((j, i, d) if flip else (i, j, d) for p in hj.near_pairs(x, y, k) for i, j, d in zip(*map(np.ndarray.tolist, p)))
                assert got == want
        finally:
            hj.cell_bands, hj.PAIRS_AT_A_TIME = hj_bands, most


def test_cells_shuffle_a_row_a_hash_and_block(spark, monkeypatch):
    """Two blocks on one side, three on the other: all pairs once, and no row a probe is shuffled."""
    from simdex.operators import hamming_join as hj
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) - (1 << 63) for _ in range(500)]
    near = [b ^ sum(1 << i for i in rnd.sample(range(63), rnd.randint(0, 13))) for b in base][:350]
    monkeypatch.setattr(hj, "CELL_ROWS", 200)
    L = spark.createDataFrame([(h, str(h)) for h in set(base)] + [(None, "x")], "hash bigint, name string")
    R = spark.createDataFrame([(h, h % 7) for h in set(near)], "qhash bigint, seven bigint")
    got = hamming_pairs(L, R, 10, strategy="banded")
    want = sorted((a, str(a), b, b % 7, d) for a in set(base) for b in set(near) if (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200
    dealt = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_count" not in dealt and "__bval" not in dealt


def test_cell_pairs_without_spark():
    """Cells that go on over batches, a cell of one side alone, text columns, a null in the order."""
    import pyarrow as pa

    from simdex.operators.hamming_join import cell_pairs
    rnd = random.Random(6)
    rows, want = [], []
    for cell in (0, 2, 3, 7):
        left = [(rnd.getrandbits(63), f"l{cell}-{i}", i if i % 9 else None) for i in range(60)]
        right = [] if cell == 3 else [(h ^ (1 << rnd.randrange(63)), rnd.randrange(60)) for h, _, _ in left[:40]]
        rows += [(cell, 0, h, name, i, None, None) for h, name, i in left] + [(cell, 1, None, None, None, q, j) for q, j in right]
        want += [(h, name, i, q, j, (h ^ q).bit_count()) for h, name, i in left for q, j in right
                 if (h ^ q).bit_count() <= 10 and i is not None and i < j]
    names = ["__cell", "__side", "hash", "name", "i", "qhash", "j"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 37]), kinds)], names)
               for a in range(0, len(rows), 37)]
    got = [tuple(r.values()) for b in cell_pairs(iter(batches), names[2:5], names[5:], "hash", "qhash", 10, ("i", "j"))
           for r in b.to_pylist()]
    assert sorted(got) == sorted(want) and len(want) > 20


@pytest.mark.parametrize("rows", [8192, 7])
def test_file_scope_of_many_queries(spark, rows, monkeypatch):
    """Cells of whole documents give what a loop over all pairs gives, and write no hits."""
    from simdex.operators import hamming_join, sizing
    monkeypatch.setattr(hamming_join, "DOCUMENT_ROWS", rows, raising=False)
    monkeypatch.setattr(hamming_join, "CELL_ROWS", 1 << 17 if rows > 100 else 50)
    monkeypatch.setattr(hamming_join, "HITS_AT_A_TIME", 1 << 16 if rows > 100 else 3, raising=False)
    written, stored = [], sizing.stored
    monkeypatch.setattr(sizing, "stored", lambda df, *a: written.append(stored(df, *a)) or written[-1])
    rng = random.Random(5)
    centres = [rng.getrandbits(64) - (1 << 63) for _ in range(6)] + [-1]

    def near(flips):
        h = rng.choice(centres) & (1 << 64) - 1
        for _ in range(rng.randint(0, flips)):
            h ^= 1 << rng.randrange(64)
        return h - (1 << 64) if h >> 63 else h
    chunks = [(rng.choice([None, *range(12)]), i, i * 10, 10, near(9)) for i in range(150)]
    asked = [(f"q{rng.randint(0, 60)}" if rng.random() < .95 else None, near(5)) for _ in range(100)] + [("q1", 0), ("q2", None)]
    asked += asked[:5]
    pairs = [(q, c, (h ^ c[4]).bit_count() if (h < 0) == (c[4] < 0) else ((h ^ c[4]) & (1 << 64) - 1).bit_count())
             for q, h in asked if h for c in chunks]
    exact = {(q, c[0]) for q, c, d in pairs if d == 0}
    want = [(q, *c, d, "fuzzy" if d else "exact") for q, c, d in pairs
            if d == 0 or d <= 10 and (q, c[0]) not in exact and q is not None and c[0] is not None]
    idx = spark.createDataFrame(chunks, SCHEMA)
    got = lookup(idx, spark.createDataFrame(asked, "query_id string, qhash bigint"), 10)
    assert got.columns == list(lookup(idx, queries(spark, [1]), 10).columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert len({w[-1] for w in want}) == 2 and len(want) > 500
    assert max(t.count() for t in written) <= max(len(chunks), len(asked))
