"""Small tables that hold every odd case: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "uid bigint, key string, node string, `row` int, size bigint, block int, score double")
WORDS = {"en": "the of and river stone house walked under bright morning quickly song".split(),
         "de": "der und nicht schön straße über haus vögel fünf grüße läuft wälder".split()}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(n))


def make_docs(seed=5, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        rows.append([i, sentence(rng, lang, rng.randint(20, 160)), lang, rng.choice(["a", "b", None])])
    base = rows[3][1]
    for i in range(n, n + 8):  # near copies and exact copies
        words = base.split()
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append([i, " ".join(words), rows[3][2], "a"])
    rows += [[n + 10, None, "en", "a"], [n + 11, "", None, "b"], [n + 12, " \n\t ", "en", "b"],
             [n + 13, "12 34 !!", None, "a"], [n + 14, "one two", "en", "a"], [n + 15, "two one", "en", "a"],
             [n + 16, sentence(rng, "en", 6000), "en", "long"], [n + 17, "é" * 3000, "de", "long"],
             [n + 18, "ab " * 700, "en", "a"], [None, sentence(rng, "de", 40), "de", None], [None, None, None, None]]
    rows += [list(rows[3]), list(rows[n + 8]), [5, "another text under a known id", "en", "a"]]
    return [(*r, None if r[1] is None else len(r[1]), 7, "k", "n", 1, 3, 0, 0.5) for r in rows]


@pytest.fixture(scope="session")
def odd_rows():
    return make_docs()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
