"""Weighted fingerprints against a plain loop."""

import hashlib
import math
import re
from collections import Counter

import pytest

from simdex.functions.simhash import DEFAULT_WORD_PATTERN
from simdex.plans import weighted
from simdex.plans.dedup import dedup_documents, document_fingerprints
from simdex.plans.weighted import weighted_fingerprints

from .conftest import docs_df

TEXTS = {1: "The harbour, the ferry and the evening tide", 2: "the HARBOUR and a ferry; the morning tide",
         3: "the", 4: "", 5: "?!", 6: "the the the kiosk", 7: "the harbour, the ferry and the evening tide",
         8: "the " + "bell rings twice " * 3000, 9: "é café the"}


def brute(texts):
    words = {i: Counter(re.findall("[a-z0-9_]+", (t or "").lower())) for i, t in texts.items()}
    df = Counter(w for c in words.values() for w in c)
    for i, c in words.items():
        total = [0] * 64
        for w, tf in c.items():
            h = int(hashlib.md5(w.encode()).hexdigest()[:16], 16)
            weight = math.floor(1000 * math.log(len(texts) / df[w])) * tf
            for b in range(64):
                total[b] += weight if h >> b & 1 else -weight
        u = sum(1 << b for b in range(64) if total[b] >= 0)
        yield i, sum(c.values()), u - (1 << 64) if u >> 63 else u


@pytest.mark.parametrize("hot_rows", [100_000, 2, 0])
def test_equals_a_plain_loop(spark, hot_rows):
    texts = {**TEXTS, 10: None}
    got = weighted_fingerprints(docs_df(spark, texts), hot_rows=hot_rows).collect()
    assert sorted(map(tuple, got)) == sorted(brute(texts))


def test_words_everywhere_weigh_nothing(spark):
    got = weighted_fingerprints(docs_df(spark, {1: "a b", 2: "b a a"})).collect()
    assert sorted(map(tuple, got)) == [(1, 2, -1), (2, 3, -1)]


def test_empty_table(spark):
    assert weighted_fingerprints(docs_df(spark, TEXTS).where("false")).count() == 0


def test_groups_by_weighted_words(spark):
    """Equal words in another order are one group."""
    docs = docs_df(spark, {1: "harbour ferry tide evening", 2: "evening tide ferry harbour", 3: "kiosk bell lamp stone quay"})
    assert document_fingerprints(docs, features="weighted").count() == 3
    got = {r.doc_id: r.group_id for r in dedup_documents(docs, 0, features="weighted").collect()}
    assert got == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("pattern", [DEFAULT_WORD_PATTERN, "[a-z0-9_é]+"])
def test_blocks(spark, monkeypatch, pattern):
    """Documents cut into blocks of few words get the fingerprints of the whole; rows of one id are one document."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(weighted, "BLOCK_TERMS", 3)
    docs = docs_df(spark, {**TEXTS, 10: None}).coalesce(1)
    whole = weighted_fingerprints(docs, word_pattern=pattern).collect()
    monkeypatch.setattr(weighted, "BLOCK_TERMS", 1 << 20)
    assert sorted(whole) == sorted(weighted_fingerprints(docs, word_pattern=pattern).collect())
    rows = docs.unionByName(docs_df(spark, {1: "kiosk and bell"})) \
        .unionByName(docs_df(spark, {99: "the kiosk"}).withColumn("doc_id", F.lit(None).cast("bigint")))
    texts = {**TEXTS, 1: TEXTS[1] + " kiosk and bell", 10: None, 99: "the kiosk", 100: ""}
    if pattern == DEFAULT_WORD_PATTERN:   # 12 rows
        want = {r[0]: r for r in brute(texts)}
        got = sorted(map(tuple, weighted_fingerprints(rows).collect()), key=str)
        assert got == sorted([*(r for i, r in want.items() if i < 99), want[1], (None, 0, -1)], key=str)


def test_no_row_a_word(spark):
    """Between its stages the plan has documents in blocks, not a row for each word of each document."""
    docs = docs_df(spark, {i: " ".join(f"w{j}" for j in range(50)) for i in range(40)}).coalesce(1)
    blocks = weighted.term_blocks(weighted.term_lists(docs)).collect()
    assert len(blocks) == 1 and len(blocks[0].words) == 50 and len(blocks[0].which) == 2000
