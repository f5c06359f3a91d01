r"""Token counts (operator 9).

The number of tokens of every text under a unigram model: each pre-token is cut into the
pieces whose scores add up to the most (ties to fewer tokens).

Method: dynamic programming shared on a trie.  The distinct pre-tokens of a batch go into a
trie; the best score of a prefix is computed once for all words that share it, and a word's
node stores its token count.  The trie is built level by level (a level is the distinct
prefixes of one length), so all nodes of a level are scored side by side.

Pieces come from a public tokenizer file (a parameter); its ids are in order of frequency, so
a piece's score is ``-log(1 + place)`` (Zipf).  A byte no piece covers costs ``BYTE_SCORE`` and
one token, as byte fallback does.

A pre-token is a run of ``[^\x20\x09-\x0D]`` with one space sign (``MARK``) before it.  Defined
results: a null text or one without a word has 0 tokens; rows repeat as they come;
other columns are not looked at; an empty table gives no rows.  Pre-tokens longer than
``LONGEST`` bytes stay out of the trie and are scored whole, one by one, from left to right: of
the places before, only those that a piece can reach back to are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import concat_ranges, is_space, small_batches, utf8

MARK = "▁"
BYTE_SCORE = -20.0
LONGEST = 256             # bytes of a word that is put into the trie, at most
STRETCH = 65_536          # bytes of a longer word whose pieces are looked up side by side
CHUNK_BYTES = 3_000_000   # text whose distinct words share a trie

_BASE = np.uint64(0x5851F42D4C957F2D)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Pieces:
    """Pieces with their scores, found by their bytes through a table of hashes."""

    def __init__(self, pieces: list[tuple[bytes, float]]):
        best: dict[bytes, float] = {}
        for p, s in pieces:
            if p and (p not in best or s > best[p]):
                best[p] = s
        self.longest = max(map(len, best), default=0)
        names = list(best)
        keys = np.array([self._key(p) for p in names], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array([best[p] for p in names])[order]
        if len(np.unique(self.keys)) < len(self.keys):
            raise ValueError("two pieces have one hash")
        self.lengths = sorted({len(p) for p in names})
        bits = np.zeros(1 << 22, bool)  # a quick test before the search
        bits[(self.keys & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.bits = bits

    @staticmethod
    def _key(p: bytes) -> int:
        h = 0
        for b in p:
            h = (h * int(_BASE) + b + 1) & (1 << 64) - 1
        return int(_mix(np.array([h], np.uint64))[0])

    def score(self, raw: np.ndarray) -> np.ndarray:
        """Score of the pieces of these rolling hashes; minus infinity where there is none."""
        key = _mix(raw)
        out = np.full(len(key), -np.inf)
        maybe = np.nonzero(self.bits[(key & np.uint64((1 << 22) - 1)).astype(np.int64)])[0]
        if len(maybe) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == key[maybe]
            out[maybe[hit]] = self.scores[at[hit]]
        return out


def sentence_pieces(path: str) -> list[tuple[bytes, float]]:
    """The pieces of a sentencepiece model, scored by their place; byte and control pieces are left
    out (bytes have their own score)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            out.append((model.id_to_piece(i).encode(), -float(np.log(1 + i))))
    return out


def word_tokens(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Token count of each word (bytes of ``data``), through a trie of all of them.

    Level d holds a node for every distinct prefix of d bytes.  ``path[d]`` is each word's node on
    level d; a node's score is the best over the pieces that end at it, each from the node that
    many levels up."""
    n = len(starts)
    tokens = np.zeros(n, np.int64)
    if not n:
        return tokens
    order = np.argsort(-sizes, kind="stable")  # the words that reach a level come first
    starts, sizes = starts[order], sizes[order]
    deep = int(sizes[0])
    reach = np.searchsorted(-sizes, -np.arange(deep + 1), "right")
    mult = np.multiply.accumulate(np.append(np.uint64(1), np.full(pieces.longest, _BASE)))
    node = np.zeros(n, np.int64)                      # each word's node on the level before
    up: list[np.ndarray] = [np.zeros(1, np.int64)]    # parent of each node, by level
    run: list[np.ndarray] = [np.zeros(1, np.uint64)]  # rolling hash of the whole prefix
    score: list[np.ndarray] = [np.zeros(1)]
    count: list[np.ndarray] = [np.zeros(1, np.int64)]
    for d in range(1, deep + 1):
        k = int(reach[d])
        byte = data[starts[:k] + d - 1].astype(np.int64)
        key, child = np.unique(node[:k] << 8 | byte, return_inverse=True)
        parent, byte = key >> 8, (key & 255).astype(np.uint64)
        node = child
        up.append(parent)
        run.append(run[d - 1][parent] * _BASE + byte + np.uint64(1))
        best = score[d - 1][parent] + BYTE_SCORE
        num = count[d - 1][parent] + 1
        over = parent
        for back in range(1, min(d, pieces.longest) + 1):
            if back > 1:
                over = up[d - back + 1][over]
            s = pieces.score(run[d] - run[d - back][over] * mult[back]) + score[d - back][over]
            c = count[d - back][over] + 1
            better = (s > best) | ((s == best) & (c < num))
            best, num = np.where(better, s, best), np.where(better, c, num)
        score.append(best)
        count.append(num)
        ended = np.nonzero(sizes[:k] == d)[0]
        tokens[order[ended]] = num[node[ended]]
        if d >= pieces.longest:  # no piece reaches further up
            run[d - pieces.longest] = score[d - pieces.longest] = count[d - pieces.longest] = None
    return tokens


def long_word_tokens(word: np.ndarray, pieces: Pieces) -> int:
    """Token count of one word (its bytes) of any length.

    ``best`` and ``num`` are the score and count of the places from a stretch's start on; those
    that its pieces reach behind its end are carried into the next."""
    far, lengths = max(1, pieces.longest), set(pieces.lengths)
    best, num = [0.0] + [-np.inf] * far, [0] * (far + 1)
    for a in range(0, len(word), STRETCH):
        n = min(STRETCH, len(word) - a)
        raw = np.zeros(n, np.uint64)
        found = [(np.arange(n), np.ones(n, np.int64), np.full(n, BYTE_SCORE))]
        for size in range(1, far + 1):
            k = min(n, len(word) - a - size + 1)  # starts that have so many bytes
            if k < 1:
                break
            raw = raw[:k] * _BASE + word[a + size - 1:a + size - 1 + k].astype(np.uint64) + np.uint64(1)
            if size in lengths:
                s = pieces.score(raw)
                at = np.nonzero(s > -np.inf)[0]
                found.append((at, np.full(len(at), size), s[at]))
        at, size, gain = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(at, kind="stable")
        best += [-np.inf] * n
        num += [0] * n
        for i, j, s in zip(at[order].tolist(), (at + size)[order].tolist(), gain[order].tolist()):
            s, c = best[i] + s, num[i] + 1
            if s > best[j] or s == best[j] and c < num[j]:
                best[j], num[j] = s, c
        best, num = best[n:], num[n:]
    return num[0]


def count_batch(data: np.ndarray, offs: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and words of each row."""
    space = is_space(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    if not len(data):
        return np.zeros(len(offs) - 1, np.int64), np.zeros(len(offs) - 1, np.int64)
    starts = np.nonzero(~space & (np.append(True, space[:-1]) | cut[:-1]))[0]
    ends = np.nonzero(~space & (np.append(space[1:], True) | cut[1:]))[0] + 1
    words = np.diff(np.searchsorted(starts, offs))
    # every word with its mark before it
    mark = np.frombuffer(MARK.encode(), np.uint8)
    size = ends - starts + len(mark)
    text = np.empty(int(size.sum()), np.uint8)
    begin = np.cumsum(size) - size
    for i, b in enumerate(mark):
        text[begin + i] = b
    text[concat_ranges(begin + len(mark), ends - starts)] = data[concat_ranges(starts, ends - starts)]
    # distinct ones: equal bytes have equal keyed sums
    place = concat_ranges(np.zeros(len(size), np.int64), size)
    part = _mix((text.astype(np.uint64) + np.uint64(1)) * _BASE + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = np.add.reduceat(part, begin) if len(begin) else part
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    begin, size = begin[first], size[first]
    n = np.zeros(len(first), np.int64)
    short = size <= LONGEST
    n[short] = word_tokens(text, begin[short], size[short], pieces)
    for i in np.nonzero(~short)[0]:
        n[i] = long_word_tokens(text[begin[i]:begin[i] + size[i]], pieces)
    total = np.append(0, np.cumsum(n[which]))
    upto = np.cumsum(words)
    return total[upto] - total[upto - words], words


def token_counts(docs: DataFrame, pieces: list[tuple[bytes, float]], *, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(pieces))  # one vocabulary
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            data, offs = utf8(batch.column(1))
            row = 0
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(offs, offs[row] + CHUNK_BYTES, "right")) - 1)
                n, words = count_batch(data[offs[row]:offs[end]], offs[row:end + 1] - offs[row], pieces)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(words.astype(np.int64)), pa.array(n)],
                    ["doc_id", "n_words", "n_tokens"])
                row = end
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_words bigint, n_tokens bigint"))
