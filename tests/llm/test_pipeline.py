"""The stages of corpus_pipeline, each against brute force on its own input."""

import os
from collections import Counter

import numpy as np
import public_tokenizers

import corpus_pipeline
from tests.llm.test_operators import brute_join, brute_spans, shingle_set, word_count

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages(spark, odd_rows, tmp_path):
    rows = [r[:5] for r in odd_rows]
    mail = "write to anna.b@mail.com or +1 (444) 555-3382 " + " ".join(rows[0][1].split()[::-1])
    rows.append((500, mail, rows[0][2], "a", len(mail)))
    docs = spark.createDataFrame(rows, DOCUMENTS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append([tuple(r) for r in docs.collect()])
    named, single, clean, mixed, tokens = out
    # 1: what has letters and a clear language stays, as it was
    kept = Counter(r[:2] for r in named)
    assert all(any(map(str.isalpha, t)) for _, t in kept)
    assert all(kept[r[:2]] == Counter(x[:2] for x in rows)[r[:2]] for r in rows[:60])
    assert {r[0]: r[2] for r in named if r[0] in (0, 1, 2)} == {r[0]: r[2] for r in rows[:3]}
    # 2: one document of each group
    groups = Counter()
    for r, b in zip(named, brute_join(named)):
        groups[b[1], shingle_set(r[1]) if b[3] == 1 else None] += 1
    assert len(single) == len(groups) and len({shingle_set(r[1]) for r in single}) == len(single)
    # 3: no base span is left, other texts are as they were
    before = Counter(r[:2] for r in single)  # an id may name two texts
    assert not any(brute_spans(r[1]) for r in clean) and len(clean) == len(single)
    plain = Counter({k: n for k, n in before.items() if not brute_spans(k[1])})
    assert plain == Counter(r[:2] for r in clean if r[0] != 500) and len(clean) - 1 == sum(plain.values())
    got = next(r[1] for r in clean if r[0] == 500)
    assert got.startswith("write to [EMAIL] or [PHONE] ") and all(r[4] == len(r[1]) for r in clean)
    # 4: a source's words, and no document more than three times
    have, times = Counter(), Counter()
    for r in mixed:
        have[r[3]] += word_count(r[1])
        times[r[0], r[3]] += 1
    size = Counter()
    for r in clean:
        size[r[3]] += word_count(r[1])
    assert abs(sum(have.values()) - sum(size.values())) <= len(size) and max(times.values()) <= 3
    # 5: the ids of every text
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = Counter((r[0], np.array(tok.encode(r[1], add_special_tokens=False).ids, "<u4").tobytes()) for r in mixed)
    assert Counter((r[0], bytes(r[4])) for r in tokens) == want
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(tokens)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    assert os.listdir(tmp_path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
