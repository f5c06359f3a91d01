"""Cross-tokenizer alignment (operator 11).

Two tokenizers cut the same bytes; where tokens of both end, the text is cut into groups, and
within a group every token of one overlaps some of the other.  A *link* is a pair of overlapping
token occurrences; a pair of ids is as strong as its links are many in the whole corpus.

Method: divide and conquer at shared cuts.  An interval between two shared cuts looks for a common
end near its middle: it takes ends of tokenizer A in rings of doubling width around the middle
and finds them among B's ends by bisection.  A hit cuts the interval in two, which are treated
alike; an interval without any common end inside is a leaf, a group.  All intervals of one depth go
side by side, over all texts of a batch, which lie end to end (a text's end is a shared cut).

The links follow from the ends: two neighbouring ends of either tokenizer bound a stretch, and
each stretch belongs to one pair.  Spark sums the links of id pairs; the tables of counts
(pairs) and of the strongest count of each B id (at most a vocabulary) are then looked up by
blocks, so a frequent pair moves once a block.

Defined results: a null or empty text has no tokens and zeros, as has one whose tokens don't give
back its bytes (a normalizer changed them); special tokens' strings are plain text; ties for
the strongest count all count; rows repeat as they come; a long text is a batch of its own, whole;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import drop_stored, stored
from .blocks import BlockIds, look_up, numbered
from .bpe import PATTERN, byte_symbols, in_chunks
from .common import concat_ranges, small_batches

CHUNK_CHARS = 2_000_000   # characters of texts aligned side by side
SPACE = "▁"          # fixed value: how pieces write a space


# -- the tokenizers ----------------------------------------------------------


class Tokens:
    """What alignment needs of a tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, content: list[bytes]):
        self.lens = np.array([len(c) for c in content], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(content), np.uint8)
        digits = [str(i).encode() + b" " for i in range(len(content))]
        self.digit_lens = np.array([len(d) for d in digits], np.int64)
        self.digit_starts = np.cumsum(self.digit_lens) - self.digit_lens
        self.digits = np.frombuffer(b"".join(digits), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[concat_ranges(self.starts[ids], self.lens[ids])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        raise NotImplementedError


class ByteTokens(Tokens):
    """Byte-level BPE from a tokenizer file (its tokens' strings stand for bytes)."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        vocab, special = spec["model"]["vocab"], {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"{path}: ids don't follow the order of merges")
        content = [b""] * (max(vocab.values()) + 1)
        for token, i in ranks.items():
            content[i] = token
        # ids in the order of merges are ranks; without special tokens their strings are plain text
        self.model = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        super().__init__(content)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.model.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts]


class PieceTokens(Tokens):
    """Pieces of a sentence model, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        content = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            content.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i)
                           else piece.replace(SPACE, " ").encode())
        super().__init__(content)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


@lru_cache(4)
def tokenizer(kind: str, path: str) -> Tokens:
    return {"bytes": ByteTokens, "pieces": PieceTokens}[kind](path)


# -- alignment ---------------------------------------------------------------


def shared_cuts(a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Which of the sorted ends ``a`` are ends of ``b``, too; ``cuts`` marks those known to be.

    The ends between two cuts are an interval.  One round halves every open interval: its ends are
    looked up in ``b`` by bisection in rings around the middle, twice as wide each time, until one
    is common or none is left."""
    shared = cuts.copy()
    last = np.nonzero(shared)[0]
    lo, hi = np.append(0, last[:-1] + 1), last       # inner ends of an interval: lo .. hi - 1
    while True:
        open_ = hi > lo
        lo, hi = lo[open_], hi[open_]
        if not len(lo):
            return shared
        found = np.full(len(lo), -1)
        left = right = (lo + hi) // 2                # looked at so far: left .. right - 1
        todo, width = np.arange(len(lo)), 1
        while len(todo):
            new_left = np.maximum(lo[todo], left - width + 1)
            new_right = np.minimum(hi[todo], right + width)
            for start, n in ((right, new_right - right), (new_left, left - new_left)):
                probe = concat_ranges(start, n)
                if not len(probe):
                    continue
                at = np.minimum(np.searchsorted(b, a[probe]), len(b) - 1)
                hit = b[at] == a[probe]
                owner = np.repeat(todo, n)[hit]
                found[owner] = probe[hit]
            more = (found[todo] < 0) & ((new_left > lo[todo]) | (new_right < hi[todo]))
            todo, left, right = todo[more], new_left[more], new_right[more]
            width *= 2
        cut = found >= 0                             # the others are leaves
        lo, hi, found = lo[cut], hi[cut], found[cut]
        shared[found] = True
        lo, hi = np.concatenate([lo, found + 1]), np.concatenate([found, hi])


def _before(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the distinct sorted ``ends`` lie before each place; the last of both is the same."""
    if not len(ends):
        return np.zeros(0, np.int64)
    mark = np.zeros(ends[-1] + 1, np.int64)
    mark[ends] = 1
    np.cumsum(mark, out=mark)
    return mark[at - 1]


class Aligned:
    """The alignment of a run of texts, row by row."""

    def __init__(self, texts: list[str], a: Tokens, b: Tokens):
        ids = [a.encode(texts), b.encode(texts)]
        self.n = len(texts)
        sure = np.ones(self.n, bool)
        for k, t in enumerate((a, b)):
            sizes = np.array([len(x) for x in ids[k]], np.int64)
            flat = np.concatenate([np.zeros(0, np.int64), *ids[k]])
            ends = np.append(0, np.cumsum(t.lens[flat]))
            cuts = ends[np.append(0, np.cumsum(sizes))]
            raw = t.join(flat).tobytes()
            sure &= [x != "" and raw[i:j] == b" " + x.encode() for x, i, j in zip(texts, cuts[:-1].tolist(), cuts[1:].tolist())]
        empty = np.zeros(0, np.int64)
        flat, rows, ends, heads = [], [], [], []
        for k, t in enumerate((a, b)):
            kept = [x if ok else empty for x, ok in zip(ids[k], sure.tolist())]
            sizes = np.array([len(x) for x in kept], np.int64)
            flat.append(np.concatenate([empty, *kept]))
            rows.append(np.repeat(np.arange(self.n), sizes))
            ends.append(np.cumsum(t.lens[flat[k]]))
            heads.append(sizes)
        self.a, self.b = flat
        self.n_a, self.n_b = heads
        self.end_a, self.end_b = ends
        self.row_a, self.row_b = rows
        close = np.zeros(len(self.a), bool)
        close[np.cumsum(self.n_a)[self.n_a > 0] - 1] = True    # a text's end
        self.cut = shared_cuts(self.end_a, self.end_b, close) if len(self.a) else close
        self.group_a = np.cumsum(self.cut) - self.cut          # number of a token's group
        self.group_b = _before(self.end_a[self.cut], self.end_b)
        self.n_groups = np.bincount(self.row_a[self.cut], minlength=self.n)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, a, b)`` of each link: ids that share a stretch between two neighbouring ends."""
        if not len(self.a):
            return self.row_a, self.a, self.b
        either = np.zeros(self.end_a[-1] + 1, bool)
        either[self.end_a] = either[self.end_b] = True
        ends = np.nonzero(either)[0]
        at = _before(self.end_a, ends)
        return self.row_a[at], self.a[at], self.b[_before(self.end_b, ends)]

    def written(self, a: Tokens, b: Tokens) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each row, hashed; rows without tokens give an empty string."""
        n_a, n_b, n = len(self.a), len(self.b), len(self.a) + len(self.b)
        if not n:
            return [""] * self.n
        # tokens in the order they are written: A's of a group, then B's
        sizes = [np.cumsum(np.bincount(g)) for g in (self.group_a, self.group_b)]
        b_before, a_through = np.append(0, sizes[1])[self.group_a], sizes[0][self.group_b]
        place_a, place_b = np.arange(n_a) + b_before, np.arange(n_b) + a_through
        start, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        pool = np.concatenate([a.digits, b.digits])
        start[place_a], size[place_a] = a.digit_starts[self.a], a.digit_lens[self.a]
        start[place_b], size[place_b] = b.digit_starts[self.b] + len(a.digits), b.digit_lens[self.b]
        after = np.full(n, ord(","), np.uint8)
        after[place_a[self.cut]] = ord("|")
        after[place_b[np.append(self.group_b[1:] != self.group_b[:-1], True)]] = ord(";")
        text = pool[concat_ranges(start, size)]
        stop = np.cumsum(size)
        text[stop - 1] = after
        upto = np.append(0, stop)[np.append(0, np.cumsum(self.n_a + self.n_b))]
        raw = text.tobytes()
        return [hashlib.sha256(raw[i:j - 1]).hexdigest() if j > i else "" for i, j in
                zip(upto[:-1].tolist(), upto[1:].tolist())]


BLOCK = ("block bigint, doc_id array<{0}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
         "groups_sha256 array<string>, pairs array<bigint>, n_pair array<bigint>, upto array<int>, which array<int>, times array<int>")


def _sums(values: np.ndarray, upto: np.ndarray) -> np.ndarray:
    run = np.append(0, np.cumsum(values))
    return run[upto[1:]] - run[upto[:-1]]


def align_blocks(docs: DataFrame, paths: tuple[str, str], doc_id: str, text: str) -> DataFrame:
    """A row a block of documents: what is known of each, its distinct id pairs with their number
    in the block, and per document which of them it has how often."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizer("bytes", paths[0]), tokenizer("pieces", paths[1])
        ids = BlockIds()
        for batch in batches:
            at = 0
            for texts in in_chunks([t or "" for t in batch.column(1).to_pylist()], CHUNK_CHARS):
                found = Aligned(texts, a, b)
                row, x, y = found.links()
                code, pairs = numbered(x << 32 | y)
                # rows come in order, so do their distinct pairs
                key, each = numbered(row * max(1, len(pairs)) + code)
                upto = np.searchsorted(each // max(1, len(pairs)), np.arange(len(texts) + 1))
                lists = [batch.column(0).slice(at, len(texts)), found.n_a, found.n_b, found.n_groups,
                         np.bincount(row, minlength=len(texts)), found.written(a, b), pairs,
                         np.bincount(code, minlength=len(pairs)), upto.astype(np.int32),
                         (each % max(1, len(pairs))).astype(np.int32), np.bincount(key, minlength=len(each)).astype(np.int32)]
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, pa.string()) if isinstance(v, list)
                          else pa.array(v) for v in lists]
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids()]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in arrays)],
                    ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "n_pair",
                     "upto", "which", "times"])
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, BLOCK.format(kind)))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(pair, n, best)``: the links of each id pair in the whole corpus, and whether no other pair
    of its B id has more (the strongest counts are at most a vocabulary of rows)."""
    counts = stored(blocks.select(F.explode(F.arrays_zip("pairs", "n_pair")).alias("p"))
                    .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.n_pair").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = stored(counts.groupBy(b.alias("b")).agg(F.max("n").alias("top")), "strongest")
    return counts.withColumn("b", b).join(F.broadcast(top), "b") \
        .select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    blocks = stored(align_blocks(docs, (byte_path, piece_path), doc_id, text), "aligned")
    counts = stored(pair_counts(blocks), "counts")
    looked = look_up(blocks.drop("n_pair"), "pairs", counts, "pair", ["n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {name: batch.column(name)[i].values for name in batch.schema.names if name != "block"}
                which, times, upto = (cell[c].to_numpy() for c in ("which", "times", "upto"))
                n_pairs = int(which.max()) + 1 if len(which) else 0
                n, best = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
                if n_pairs:
                    at = cell["found"].field("at").to_numpy()
                    n[at] = cell["found"].field("n").to_numpy()
                    best[at] = cell["found"].field("best").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [cell["doc_id"], cell["n_a"], cell["n_b"], cell["n_groups"], cell["n_links"],
                     pa.array(_sums(best[which] * times, upto)), pa.array(_sums(n[which] * times, upto)),
                     cell["groups_sha256"]],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return looked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "upto", "which", "times", "found").mapInArrow(
        run, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
             "count_sum bigint, groups_sha256 string")
