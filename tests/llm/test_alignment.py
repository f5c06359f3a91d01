"""Alignment of two tokenizers against the libraries and a plain loop."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from simdex.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(texts, libraries):
    from tokenizers.pre_tokenizers import ByteLevel
    tok, sp = libraries
    symbols = sorted(ByteLevel.alphabet(), key=ord)
    plain = [b for b in range(256) if chr(b) in symbols]
    byte_of = {chr(b): b for b in plain}
    byte_of |= dict(zip([c for c in symbols if ord(c) > 255], [b for b in range(256) if b not in plain]))
    strings = {i: t for t, i in tok.get_vocab().items()}
    rows, pairs = [], Counter()
    for t in texts:
        ids = [[], []]
        if t:
            ids = [tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)]
        raw = [[bytes(byte_of[c] for c in strings[i]) for i in ids[0]],
               [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
                for i in ids[1]]]
        want = (" " + t).encode() if t else b""
        if b"".join(raw[0]) != want or b"".join(raw[1]) != want:
            ids = raw = [[], []]
        spans = []
        for r in raw:
            at, out = 0, []
            for x in r:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((ids[0][i], ids[1][k]))
                k += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [tuple(",".join(str(i) for i, (s, e) in zip(ids[x], spans[x]) if lo <= s and e <= hi) for x in (0, 1))
                  for lo, hi in zip([0] + cuts, cuts)]
        text = ";".join("|".join(g) for g in groups)
        pairs.update(links)
        rows.append((ids, links, len(groups), hashlib.sha256(text.encode()).hexdigest() if ids[0] else ""))
    top = Counter()
    for (x, y), n in pairs.items():
        top[y] = max(top[y], n)
    return [(len(ids[0]), len(ids[1]), groups, len(links), sum(pairs[p] == top[p[1]] for p in links),
             sum(pairs[p] for p in links), sha) for ids, links, groups, sha in rows]


def odd_texts():
    rng = random.Random(8)
    out = ["  a  b\n\n c  x don't we'll  ", "x<|endoftext|> y </s> <s> <unk> <0x41>", "\n \t z", "日本語 テキスト 🙂 x", "a▁b", " x y　z",
           "é ﬁ Ω", "\0 nul \x7f", " ", "  ", "<|endoftext|>", "ab" * 400, "1234567890" * 20, "日本" * 300, "🙂" * 50, None, "", "x"]
    for _ in range(25):
        out.append("".join(rng.choice(["a", "the ", " ", "\n", "é", "日", "🙂", "ing", "12", ".", " of", "Straße", "́"]) for _ in range(rng.randint(1, 60))))
    return out + out[:4]


@pytest.mark.parametrize("chunk", [2_000_000, 50])
def test_align(spark, odd_docs, odd_rows, no_docs, libraries, chunk, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", chunk)
    texts = [r[1] for r in odd_rows] + odd_texts()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id int, text string, n bigint, pairs int")
    got = sorted(map(tuple, alignment.align(df.repartition(3), A, B).collect()))
    assert [g[1:] for g in got] == brute(texts, libraries)
    assert alignment.align(no_docs, A, B).count() == 0
    assert alignment.align(odd_docs, A, B).count() == len(odd_rows)


def test_shared_cuts():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        b = sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n})
        known = np.array([x == n or (x in b and rng.random() < 0.2) for x in a])
        assert alignment.shared_cuts(np.array(a), np.array(b), known).tolist() == [x in b for x in a]


def test_whole_unicode(libraries):
    """The encoder used in tasks agrees with the library on every code point beside letters, digits and blanks."""
    tok = alignment.tokenizer("bytes", A)
    marks = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}b" for c in marks[i:i + 500]) for i in range(0, len(marks), 500)]
    got = tok.encode(texts)
    assert [g.tolist() for g in got] == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_long_text(spark):
    """A text of a megabyte without a space is aligned whole."""
    import time
    texts = ["ab" * 500_000, "日本語" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    t = time.time()
    got = sorted(alignment.align(df, A, B).collect())
    assert time.time() - t < 60
    for r in got:
        assert r.n_links == r.n_a + r.n_b - r.n_groups and r.n_groups > 0
