r"""Quality rules (operator 8).

Method: a short-circuit cascade.  Every rule is timed and counted on a bounded
sample of the rows; rules then run in the order of rejections per second, and a
document leaves the cascade at the first rule it fails.  The verdict is "no rule
fails", so the order changes the cost and never the result.

The base counts are made for every document; the cascade sees the documents that
pass the base test.  Words are runs of ``[^\x20\x09-\x0D]``.

Defined results: a null or empty text has no words, so it fails the base test;
rows repeat as they come; other columns are not looked at; an empty table gives
no rows (and the rules keep the order they are written in).
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sample_texts, small_batches

SAMPLE_ROWS = 1000        # rows on which the rules are timed, at most
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(slots=True)
class Doc:
    text: str
    words: list[bytes]
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the text has twice or more, the first ones included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def measure(text: str | None) -> Doc:
    text = text or ""
    raw = text.encode()
    words = raw.split()  # of bytes: at x20 and x09 to x0D only
    n_lines, dup, seen = 0, 0, set()
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return Doc(text, words, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
               n_lines, dup, repeated_words(words))


def base_failed(d: Doc) -> bool:
    return len(d.words) < MIN_WORDS or 100 * d.n_repeat_words > 50 * len(d.words)


def _top_word(d: Doc) -> bool:
    return max(Counter(d.words).values()) > 0.3 * len(d.words)


def _letters(d: Doc) -> bool:
    return sum(any(b >= 128 or 65 <= b <= 90 or 97 <= b <= 122 for b in w) for w in d.words) < 0.6 * len(d.words)


#: Each says whether a document with at least one word fails.
RULES: dict[str, Callable[[Doc], bool]] = {
    "symbols": lambda d: d.n_symbols > 0.3 * len(d.words),
    "dup_lines": lambda d: d.n_dup_lines > 0.5 * d.n_lines,
    "word_length": lambda d: not 2 * len(d.words) <= d.word_chars <= 20 * len(d.words),
    "distinct_words": lambda d: len(set(d.words)) < 0.1 * len(d.words) and len(set(d.words)) < 200,
    "top_word": _top_word,
    "letters": _letters,
}


def plan(docs: DataFrame, rules: dict[str, Callable[[Doc], bool]] = RULES, *, text: str = "text",
         sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], dict[str, tuple[float, float]]]:
    """The rules by rejections per second on a sample, and each one's (seconds a row, share
    rejected)."""
    sample = [d for d in map(measure, sample_texts(docs, text, sample_rows)) if not base_failed(d)]
    found = {}
    for name, rule in rules.items():
        start = time.perf_counter()
        failed = sum(map(rule, sample))
        cost = (time.perf_counter() - start) / max(1, len(sample))
        found[name] = (cost, failed / max(1, len(sample)))
    return sorted(rules, key=lambda r: -found[r][1] / max(found[r][0], 1e-9)), found


def quality(docs: DataFrame, rules: dict[str, Callable[[Doc], bool]] = RULES, *, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    failed_rule)`` of every row; ``failed_rule`` is null unless a rule of the cascade rejects."""
    order, _ = plan(docs, rules, text=text)
    named = list(rules)
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = [(name, rules[name]) for name in order]
        for batch in batches:
            rows = []
            for t in batch.column(1):
                d = measure(t.as_py())
                base = base_failed(d)
                failed = None if base else next((name for name, rule in cascade if rule(d)), None)
                if failed:  # named by the written order, so reruns agree
                    failed = next(name for name in named if rules[name](d))
                rows.append((len(d.words), d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words,
                             base, not base and failed is None, failed))
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "base_failed", "kept", "failed_rule"])
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, "
                             "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
                             "failed_rule string"))
