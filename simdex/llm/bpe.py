"""BPE encoding and decoding (operator 10).

Method: the frequent pre-tokens of the corpus are compiled into a minimal
acyclic automaton that shares prefixes and suffixes; the number of accepted
words that sort before a word is its index, and the index leads to the word's
token ids (the transducer's output).  Tasks map the compiled lexicon into
memory from a file.  A pre-token the lexicon doesn't hold is merged exactly, all
of a batch's unseen pre-tokens side by side; those of over ``LONG`` bytes one by one with a
heap of their pairs, in n log n steps (a megabyte without a space takes seconds).

Texts are cut before every space that a non-space follows.  The tokenizer's
pattern always starts a pre-token there and never looks past it, so the pieces
are encoded on their own and a task remembers their ids (the memory is emptied
at ``CACHE_PIECES``).

Defined results: a null text is empty and has no tokens (the digest of nothing);
rows repeat as they come; pairs of one rank merge leftmost first; an empty table gives no rows
(and an empty lexicon); a long text is encoded whole; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import stored
from .common import concat_ranges, small_batches

#: Fixed value: the pattern that byte-level BPE of this vocabulary splits by.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEXICON_PIECES = 32_768   # the most frequent pieces whose pre-tokens the lexicon holds
LEXICON_LEAST = 2         # times the corpus has such a piece, at least
CACHE_PIECES = 400_000    # pieces a task remembers at a time
COUNT_PIECES = 400_000    # pieces a task counts before it hands the counts on
LONG = 2_000              # bytes of a pre-token that is merged on its own
CHUNK_CHARS = 2_000_000   # characters a task encodes side by side
NEVER = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary's strings."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """What the tasks need of a tokenizer file: ids of bytes, merges by pair, bytes by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        content = [b""] * size
        for token, i in vocab.items():
            content[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            content[i] = token.encode()
        self.byte_id = np.array([vocab[c] for c in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        lens = np.array([len(c) for c in content], np.int64)
        self.starts, self.lens = np.cumsum(lens) - lens, lens
        self.bytes = np.frombuffer(b"".join(content), np.uint8)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of ids (NEVER if they don't merge) and the id they make."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NEVER), self.made[at]

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.made.tolist())))

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return self.bytes[concat_ranges(self.starts[ids], self.lens[ids])].tobytes()


def merge_long(word: bytes, vocab: Vocabulary) -> np.ndarray:
    """Token ids of one word: a heap gives the pair of lowest rank, leftmost first; places are linked,
    so a merge touches its neighbours only."""
    first = vocab.byte_id[np.frombuffer(word, np.uint8)]
    rank, _ = vocab.pair_rank(first[:-1], first[1:])
    ids, n = first.tolist(), len(first)
    at = np.nonzero(rank != NEVER)[0]
    heap = list(zip(rank[at].tolist(), at.tolist(), (first[at] << 32 | first[at + 1]).tolist()))
    heapq.heapify(heap)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    pairs = vocab.pairs

    def offer(i: int, j: int):
        key = ids[i] << 32 | ids[j]
        if key in pairs:
            heapq.heappush(heap, (pairs[key][0], i, key))
    while heap:
        _, i, key = heapq.heappop(heap)
        j = right[i]
        if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != key:
            continue                                  # one of the two has merged since
        ids[i], ids[j], right[i] = pairs[key][1], -1, right[j]
        if right[i] < n:
            left[right[i]] = i
            offer(i, right[i])
        if left[i] >= 0:
            offer(left[i], i)
    return np.array([x for x in ids if x >= 0], np.int64)


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Token ids of each word."""
    short = [w for w in words if len(w) <= LONG]
    merged = iter(merge_short(short, vocab))
    return [next(merged) if len(w) <= LONG else merge_long(w, vocab) for w in words]


def merge_short(words: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Again and again, every word still open merges its pair of lowest rank, leftmost first."""
    out: list[np.ndarray] = [None] * len(words)
    lens = np.array([len(w) for w in words], np.int64)
    ids = vocab.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lens)
    inside = np.append(word[1:] == word[:-1], False) if len(word) else np.zeros(0, bool)
    rank, made = np.full(len(ids), NEVER), np.zeros(len(ids), np.int64)
    at = np.nonzero(inside)[0]
    rank[at], made[at] = vocab.pair_rank(ids[at], ids[at + 1])
    while len(ids):
        first = np.nonzero(np.append(True, word[1:] != word[:-1]))[0]
        size = np.diff(np.append(first, len(ids)))
        best = np.minimum.reduceat(rank, first)
        done = best == NEVER
        if done.any():
            for a, n in zip(first[done].tolist(), size[done].tolist()):
                out[word[a]] = ids[a:a + n].copy()
            keep = np.repeat(~done, size)
            ids, word, rank, made = ids[keep], word[keep], rank[keep], made[keep]
            first, size, best = np.cumsum(size[~done]) - size[~done], size[~done], best[~done]
            if not len(ids):
                break
        hits = np.nonzero(rank == np.repeat(best, size))[0]
        hits = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]
        ids[hits] = made[hits]
        keep = np.ones(len(ids), bool)
        keep[hits + 1] = False
        ids, word, rank, made = ids[keep], word[keep], rank[keep], made[keep]
        hits -= np.arange(len(hits))
        for left in (hits - 1, hits):      # only pairs beside a merged one have changed
            left = left[left >= 0]
            pair = np.append(word[1:] == word[:-1], False)[left]
            rank[left[~pair]] = NEVER
            left = left[pair]
            rank[left], made[left] = vocab.pair_rank(ids[left], ids[left + 1])
    return [np.zeros(0, np.int64) if x is None else x for x in out]


# -- the lexicon -------------------------------------------------------------


def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The minimal acyclic automaton of ``words`` with their ids, as bytes that can be mapped.

    Words go in sorted; when the next one leaves a branch, the branch's states are
    replaced by equal ones known before (shared suffixes).  Each transition holds how
    many words its state accepts before it, so the sum over a walk is the word's index.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    known: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []

    def close(open_: list) -> int:
        final, edges = open_
        key = (final, tuple(edges))
        if key not in known:
            known[key] = len(states)
            states.append((final, edges))
        return known[key]

    path: list[list] = [[False, []]]
    last = b""
    for i in order:
        w = words[i]
        same = next((j for j, (a, b) in enumerate(zip(w, last)) if a != b), min(len(w), len(last)))
        while len(path) > same + 1:
            child = close(path.pop())
            path[-1][1].append((last[len(path) - 1], child))
        path += [[False, []] for _ in range(len(w) - same)]
        path[-1][0] = True
        last = w
    while len(path) > 1:
        child = close(path.pop())
        path[-1][1].append((last[len(path) - 1], child))
    root = close(path[0])
    count = [0] * len(states)
    keys, targets, skips = [], [], []
    for s, (final, edges) in enumerate(states):  # children come before their parents
        n = int(final)
        for b, t in edges:
            keys.append(s << 8 | b)
            targets.append(t)
            skips.append(n)
            n += count[t]
        count[s] = n
    lens = np.array([len(ids[i]) for i in order], np.int64)
    parts = [np.array([len(states), root, len(keys), len(order)], np.int64),
             np.array([f for f, _ in states], np.int64), np.array(keys, np.int64),
             np.array(targets, np.int64), np.array(skips, np.int64), np.append(0, np.cumsum(lens)),
             np.concatenate([np.zeros(0, np.int64), *(ids[i] for i in order)])]
    return b"".join(p.astype("<i8").tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from a file."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:  # the map outlives the name
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        a = np.frombuffer(self.map, "<i8")
        n_states, self.root, n_edges, n_words = a[:4].tolist()
        cuts = np.cumsum([4, n_states, n_edges, n_edges, n_edges, n_words + 1])
        self.final, self.keys, self.targets, self.skips, self.offs, self.ids = np.split(a, cuts)[1:]

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, -1 if the lexicon doesn't hold it; all words walk side by side."""
        out = np.full(len(words), -1)
        lens = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lens) - lens
        text = np.frombuffer(b"".join(words), np.uint8)
        alive = np.nonzero(lens)[0] if len(self.keys) else np.zeros(0, np.int64)
        state, index = np.full(len(words), self.root), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            key = state[alive] << 8 | text[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            index[alive] += self.skips[at]
            step += 1
            ended = lens[alive] == step
            done = alive[ended]
            done = done[self.final[state[done]] == 1]
            out[done] = index[done]
            alive = alive[~ended]
        return out

    def outputs(self, index: int) -> np.ndarray:
        return self.ids[self.offs[index]:self.offs[index + 1]]


# -- encoding ----------------------------------------------------------------


def pieces_of(text: str) -> list[str]:
    """``text`` cut before every space that a non-space follows."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out if out[0] else out[1:]


class Encoder:
    def __init__(self, vocab: Vocabulary, blob: bytes):
        self.vocab, self.lexicon = vocab, Lexicon(blob)
        self.pattern = regex.compile(PATTERN)
        self.cache: dict[str, bytes] = {}
        names = sorted(vocab.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces and remember them."""
        tokens = {p: self.pattern.findall(p) for p in pieces}
        distinct = list({t for ts in tokens.values() for t in ts})
        raw = [t.encode() for t in distinct]
        index = self.lexicon.lookup(raw)
        unseen = np.nonzero(index < 0)[0].tolist()
        merged = dict(zip(unseen, merge_words([raw[i] for i in unseen], self.vocab)))
        ids = {t: (merged[i] if i in merged else self.lexicon.outputs(int(index[i])))
               .astype("<u4").tobytes() for i, t in enumerate(distinct)}
        for p, ts in tokens.items():
            self.cache[p] = b"".join([ids[t] for t in ts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; what the texts
        have that isn't known yet is learnt in one go."""
        runs = [self.special.split(t) if self.special and any(s in t for s in self.vocab.special)
                else [t] for t in texts]                  # odd places hold special tokens
        pieces = [[pieces_of(r) if r and k % 2 == 0 else [] for k, r in enumerate(rs)] for rs in runs]
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        self.learn({p for ps in pieces for x in ps for p in x if p not in self.cache})
        get = self.cache.__getitem__
        return [b"".join([np.array([self.vocab.special[r]], "<u4").tobytes() if k % 2
                          else b"".join(map(get, x)) for k, (r, x) in enumerate(zip(rs, ps))])
                for rs, ps in zip(runs, pieces)]


def in_chunks(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters together; a longer text is a run of its own."""
    run, n = [], 0
    for t in texts:
        if run and n + len(t) > size:
            yield run
            run, n = [], 0
        run.append(t)
        n += len(t)
    if run:
        yield run


def count_pieces(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(piece, n)`` over every whole text; tasks add up their own counts first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], ["piece", "n"])
            seen.clear()
            return out
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(pieces_of(t))
                if len(seen) > COUNT_PIECES:
                    yield flush()
        yield flush()
    return (small_batches(docs).select(F.col(text).cast("string").alias("text"))
            .mapInArrow(count, "piece string, n bigint")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def frequent_pieces(docs: DataFrame, text: str, size: int) -> list[str]:
    """The ``size`` most frequent pieces of the corpus that it has ``LEXICON_LEAST`` times or more.

    A histogram of the counts' logarithms (a few hundred rows) tells from which count on there
    are about ``size`` pieces, so no more than these are ever sorted or sent to the driver."""
    counts = stored(count_pieces(docs, text).where(F.col("n") >= LEXICON_LEAST), "pieces")
    level = F.floor(F.log2("n") * 16).cast("int")
    least, found = 0, 0
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        least, found = row["level"], found + row["count"]
        if found >= size:
            break
    top = counts.where(level >= least).orderBy(F.desc("n"), "piece").limit(size).collect()
    return [r["piece"] for r in top]


def build_lexicon(docs: DataFrame, vocab: Vocabulary, *, text: str = "text",
                  size: int = LEXICON_PIECES) -> bytes:
    """The lexicon of the pre-tokens of the most frequent pieces, counted over all texts."""
    pattern = regex.compile(PATTERN)
    words = sorted({t.encode() for p in frequent_pieces(docs, text, size) for t in pattern.findall(p)})
    return compile_lexicon(words, merge_words(words, vocab))


def encode(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids])`` of every row; ``ids`` holds
    the little-endian 32-bit token ids."""
    spark = docs.sparkSession
    vocab = Vocabulary(path)
    blob = build_lexicon(docs, vocab, text=text)
    shared = spark.sparkContext.broadcast((vocab, blob))  # one vocabulary and a bounded lexicon
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    schema = (f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
              + ", ids binary" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, blob = shared.value
        enc = Encoder(vocab, blob)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            n, h, d, raw = [], [], [], []
            for texts in in_chunks([t or "" for t in batch.column(1).to_pylist()]):
                for ids in enc.encode(texts):
                    n.append(len(ids) // 4)
                    h.append(sha(ids))
                    d.append(sha(vocab.decode(np.frombuffer(ids, "<u4"))))
                    if with_ids:
                        raw.append(ids)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(h, pa.string()), pa.array(d, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, schema))


def decode(encoded: DataFrame, path: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` from little-endian 32-bit ids; bytes that aren't UTF-8 become U+FFFD."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(path))
    kind = encoded.select(doc_id).schema[0].dataType.simpleString()

    def run(batches):
        vocab = shared.value
        for batch in batches:
            texts = [vocab.decode(np.frombuffer(b.as_py() or b"", "<u4"))
                     .decode("utf-8", "replace") for b in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return (small_batches(encoded).select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))
            .mapInArrow(run, f"doc_id {kind}, text string"))
