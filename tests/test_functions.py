import re

import pytest
from pyspark.sql import functions as F

from simdex.functions.hexcodec import format_hex_hash, hamming, parse_hex_hash
from simdex.functions.simhash import (MULTILINGUAL_WORD_PATTERN, majority_vote, shingles, with_simhash,
                                      word_features)
from simdex.functions.validate import default_index_path, validate_chunk_size


def to_u64_hex(v):
    return format(v & 0xFFFFFFFFFFFFFFFF, "x")


GOLDEN = {
    "": "ffffffffffffffff",
    "!!!": "ffffffffffffffff",
    "hello": "5d41402abc4b2a76",
    "hello world": "7d79703fbc7f2bf6",
    "Hello, wor": "df736b2afdeb7aff",
    "ld! This i": "96541c8b4bb490b3",
    "s a test f": "fc76dfde7f5d3e9",
    "ile.": "ba80c4229bd2b8e",
}


@pytest.mark.parametrize("method", ["arrow", "native"])
def test_simhash_golden(spark, method):
    df = spark.createDataFrame([(t,) for t in GOLDEN], "t string")
    out = with_simhash(df.withColumn("b", F.encode("t", "UTF-8")), "b", method=method).collect()
    got = {r.t: to_u64_hex(r.hash) for r in out}
    assert got == GOLDEN


def test_simhash_hello_bigint(spark):
    df = spark.createDataFrame([("hello",), ("hello world",)], "t string")
    got = {r.t: r.hash for r in with_simhash(df, "t").collect()}
    assert got == {"hello": 6719722671305337462, "hello world": 9041381145970682870}


def test_sample_texts_distance(spark):
    from tests.samples import ORIGINAL, EDITED
    df = spark.createDataFrame([("o", ORIGINAL), ("p", EDITED)], "k string, t string")
    df = df.withColumn("b", F.encode("t", "UTF-8"))
    h = {r.k: r.hash for r in with_simhash(df, "b").collect()}
    assert to_u64_hex(h["o"]) == "8f053c2ddfb9669e"
    assert to_u64_hex(h["p"]) == "8f042c6ddf98669e"
    assert bin((h["o"] ^ h["p"]) & 0xFFFFFFFFFFFFFFFF).count("1") == 5


def test_hamming_vectors(spark):
    pairs = [(0b0000, 0b0000, 0), (0b0000, 0b1111, 4), (0b1010, 0b0101, 4),
             (0b1100, 0b1010, 2), (0b1111, 0b0111, 1), (-1, 0, 64), (123, 456, 6)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a bigint, b bigint")
    got = [r.d for r in df.select(hamming("a", "b").alias("d")).collect()]
    assert got == [d for _, _, d in pairs]


def test_hex_parse_and_format(spark):
    vals = ["ffffffffffffffff", "00000000000000000000ff", "8u9ryi3rujoef", "", "1" * 17,
            "FC76DFDE7F5D3E9"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.v for r in df.select(parse_hex_hash("s").alias("v")).collect()]
    assert got == [-1, 255, None, None, None, 0xfc76dfde7f5d3e9]
    df2 = spark.createDataFrame([(-1,), (255,), (0xfc76dfde7f5d3e9,)], "h bigint")
    assert [r.x for r in df2.select(format_hex_hash("h").alias("x")).collect()] == \
        ["ffffffffffffffff", "ff", "fc76dfde7f5d3e9"]


def test_validate_chunk_size():
    assert validate_chunk_size(1024) == 1024
    for bad in (0, -512, 1.5, True):
        with pytest.raises(ValueError):
            validate_chunk_size(bad)


def test_default_index_path():
    assert default_index_path("/a/b/text.txt") == "text.txt.idx"
    with pytest.raises(ValueError):
        default_index_path("")


def test_words_and_shingles(spark):
    df = spark.createDataFrame([("The cat, the HAT_1 sat",), ("one two",), ("...",)], "t string")
    df = df.withColumn("w", word_features("t")).withColumn("s", shingles("w", 3))
    rows = df.collect()
    assert rows[0].w == ["the", "cat", "the", "hat_1", "sat"]
    assert rows[0].s == ["the cat the", "cat the hat_1", "the hat_1 sat"]
    assert rows[1].s == ["one two"]
    assert rows[2].s == []


def test_native_and_arrow_votes_agree_on_random_text(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("abcXYZ019_ .,!\n") + ["é", "ß", "中", "İ"])
    texts = st.lists(st.text(alphabet, max_size=60), min_size=1, max_size=25)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(texts)
    def check(batch):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
        df = df.withColumn("b", F.encode("t", "UTF-8"))
        a = {r.i: r.hash for r in with_simhash(df, "b", method="arrow").collect()}
        n = {r.i: r.hash for r in with_simhash(df, "b", method="native").collect()}
        assert a == n
        for i, t in enumerate(batch):
            if not re.search("[A-Za-z0-9_]", t):  # only ASCII letters are lower-cased
                assert a[i] == -1

    check()


def test_only_ascii_is_lower_cased(spark):
    df = spark.createDataFrame([("\u0130stanbul \u212aelvin ABC",)], "t string")
    assert df.select(word_features("t").alias("w")).first().w == ["stanbul", "elvin", "abc"]
    assert df.select(word_features("t", MULTILINGUAL_WORD_PATTERN).alias("w")).first().w[-1] == "abc"


def test_long_rows_vote_in_slices():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    rows = [rng.integers(-2**63, 2**63, n, dtype=np.int64).tolist() for n in (7, 0, 25, 3)]
    assert majority_vote(pa.array(rows), max_words=5).tolist() == majority_vote(pa.array(rows)).tolist()


def test_chunk_votes_equal_the_chunks_own_hashes(spark):
    from simdex.functions import chunk_votes
    from simdex.operators.index import build_index
    from tests.conftest import docs_df
    from tests.samples import ORIGINAL
    import numpy as np
    text = ORIGINAL + " a_long_word_" * 9 + "\u00e9\u00e9 X"
    lengths = np.array([1, 3, 17, 64, 500])
    old, chunk_votes.SLICE_BYTES = chunk_votes.SLICE_BYTES, 50
    try:
        got = {(int(lengths[n]), c): h for ns, cs, hs in chunk_votes.chunk_hashes(text.encode(), lengths, chunk_votes.WordBits())
               for n, c, h in zip(ns.tolist(), cs.tolist(), hs.tolist())}
    finally:
        chunk_votes.SLICE_BYTES = old
    docs = docs_df(spark, {1: text})
    want = {(n, r.chunk_idx): r.hash for n in lengths.tolist() for r in build_index(docs, n).collect()}
    assert got == want


def test_content_is_not_carried_per_chunk(spark):
    """Where the number of words is only filtered on, what the vote is made from still isn't kept at every chunk."""
    from simdex.operators.index import build_index
    from tests.conftest import docs_df
    text = "one two three four five six " * 20
    idx = build_index(docs_df(spark, {1: text, 2: "", 3: "?" * 90}), 64, stride=16)
    few = idx.where("n_words > 0").select("doc_id", "offset", "hash")
    plan = few._jdf.queryExecution().optimizedPlan()
    while "ArrowEvalPython" not in plan.nodeName():
        plan = plan.children().head()
    below = plan.children().head().output()
    names = {below.apply(i).name() for i in range(below.size())}
    assert not names & {"content", "__content", "chunk"}
    assert sorted(map(tuple, few.collect())) == sorted((r.doc_id, r.offset, r.hash) for r in idx.collect() if r.n_words)
