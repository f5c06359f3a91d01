"""Operator 13 against zlib and plain loops, on tables with every odd case."""

import hashlib
import math
import re
import zlib
from collections import Counter

from simdex.llm import importance


def runs(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(rows, target):
    s, t = Counter(), Counter()
    for r in rows:
        s.update(runs(r[1])[1])
    for x in target:
        t.update(runs(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in s}
    out = []
    for r in rows:
        n, f = runs(r[1])
        h = int(hashlib.sha256(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    may = sorted((o for o in out if o[4] >= 20), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    ranked = [(*o[:4], i) for i, o in enumerate(may, 1) if i <= 5 * len(may) // 100]
    return ranked, [tuple(o[:4]) for o in out]


def test_resample(spark, odd_docs, odd_rows, no_docs, monkeypatch):
    target = ["The river walked under the stone", None, "", "grüße über ÄÖ under_score don't 12"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    ranked, every = brute(odd_rows, target)
    for words in (1 << 19, 7):
        monkeypatch.setattr(importance, "SLICE_WORDS", words)
        got = [tuple(r) for r in importance.resample(odd_docs, bench).collect()]
        assert sorted((g[:4] for g in got), key=str) == sorted(every, key=str)
        assert sorted((g for g in got if g[4] is not None), key=lambda g: g[4]) == ranked and ranked
    assert importance.resample(no_docs, bench).count() == 0
