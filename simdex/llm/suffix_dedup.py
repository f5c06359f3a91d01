"""Suffix-array dedup (operator 1): remove what a 200-byte string repeats anywhere.

Every byte covered by a string of ``WINDOW`` bytes that starts at two places of the corpus
(the same document included, overlaps count) is removed, judged on the input.

Method: induced sorting of shards.  Each window has an anchor, the ``GRAM``-byte string of the
smallest hash in it (the first of equals), so equal windows have equal anchors; the windows of
one anchor lie next to each other and make one *context*.  Anchors that occur once are
dropped.  The contexts of the others go to shards by anchor; equal contexts become one with a
count before and after the shuffle.  A shard sorts its contexts' suffixes by induced sorting
(see suffix_sort), computes the permuted common prefixes, and a window whose prefix shared
with a neighbour is long enough is repeated, as is every window of a context that occurs
twice.  Shards never compare what lies in two anchors, and needn't.

Copies of a context cost a shard nothing, but an anchor may have very many different ones (a
passage of under 200 bytes in very many texts).  Those of an anchor of more than
``SHARD_CONTEXTS`` are cut again, by longer anchors (``GRAMS``: 128 bytes, then the window itself):
equal windows agree in these, too, so nothing is lost.  Equal parts become one with a count, their
shards go the same way, and what is found in a part is handed on to the contexts that hold it.

Work is linear in the input: one pass finds anchors, one join brings those that occur twice
back to their texts, and texts without any are done there.

Defined results: a null or empty text has 0 bytes and keeps 0 (the digest of nothing); rows
that repeat, or texts that do, are copies, so all their windows go; windows never cross
documents; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import drop_stored, join_small, n_rows, stored
from .common import concat_ranges, small_batches, utf8
from .suffix_sort import common_prefixes, suffix_array

WINDOW = 200
GRAM = 64
GRAMS = (128, WINDOW)     # bytes of the anchors by which large shards are cut further
SHARD_CONTEXTS = 4_096    # different contexts of an anchor that are sorted together (some 1 MB)
SLICE = 1 << 20           # bytes a task hashes side by side
SHARD = 1_500_000         # bytes whose suffixes are sorted together
PENDING = 40_000          # distinct contexts a task holds before it hands them on
SEPARATOR = 0xFF          # no byte of UTF-8

_MULT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BASE = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MULT[0])
    x = (x ^ (x >> np.uint64(28))) * np.uint64(_MULT[1])
    return x ^ (x >> np.uint64(32))


@lru_cache(2)
def _tables(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of bytes, powers of the base, and their inverses."""
    base = _BASE[which]
    n = SLICE + 4 * WINDOW
    values = np.random.default_rng(91 + which).integers(1, 1 << 63, 256, np.uint64)
    powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, np.uint64(base))))
    inverse = np.uint64(pow(base, -1, 1 << 64))
    return values, powers, np.multiply.accumulate(np.append(np.uint64(1), np.full(n, inverse)))


class Hashes:
    """64-bit hashes of any substrings of a slice of bytes, from running sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        values, powers, self.inverse = _tables(which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def grams(self, k: int) -> np.ndarray:
        return _mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:len(self.sums) - k])


def _slices(offs: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from, to, rows, window starts' bounds)`` of slices of at most SLICE bytes: whole rows
    together, or parts of a long row whose windows don't repeat.  Rows come with the start of
    their bytes in the slice."""
    row = 0
    while row < len(offs) - 1:
        end = int(np.searchsorted(offs, offs[row] + SLICE, "right")) - 1
        if end > row:
            yield int(offs[row]), int(offs[end]), np.arange(row, end), offs[row:end + 1] - offs[row]
            row = end
            continue
        a, b = int(offs[row]), int(offs[row + 1])
        for at in range(a, b, SLICE - WINDOW + 1):
            to = min(b, at + SLICE)
            yield at, to, np.array([row]), np.array([0, to - at])
            if to == b:
                break
        row += 1


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` neighbouring hashes is (the first of equals; a slice's places
    fit 21 bits)."""
    low = np.uint64((1 << 21) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    return (least & low).astype(np.int64)


def anchors(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``(key, row, first, last)`` per slice: each anchor with its row and, in the row's bytes, the
    first and last start of its windows."""
    width = WINDOW - GRAM + 1
    for a, b, rows, cuts in _slices(offs):
        lens = np.diff(cuts) - WINDOW + 1
        long = np.nonzero(lens > 0)[0]
        if not len(long):
            continue
        grams = Hashes(data[a:b]).grams(GRAM)
        least = _least(grams, width)
        starts = concat_ranges(cuts[long], lens[long])
        owner = np.repeat(long, lens[long])
        anchor = least[starts]
        new = np.nonzero(np.append(True, anchor[1:] != anchor[:-1]))[0]
        stop = np.append(new[1:], len(starts)) - 1
        row = rows[owner[new]]
        base = offs[row] - a
        yield grams[anchor[new]].view(np.int64), row, starts[new] - base, starts[stop] - base


def _context_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the bytes of each context of one text (contexts sorted by first)."""
    out = np.empty((2, len(first)), np.int64)
    at = 0
    while at < len(first):
        lo = int(first[at])
        upto = max(at + 1, int(np.searchsorted(last + WINDOW, lo + SLICE, "right")))
        part = data[lo:int(last[upto - 1]) + WINDOW]
        for w in (0, 1):
            out[w, at:upto] = Hashes(part, w).of(first[at:upto] - lo, last[at:upto] + WINDOW - lo).view(np.int64)
        at = upto
    return out[0], out[1]


# -- Spark steps -------------------------------------------------------------


def find_anchors(texts: DataFrame) -> DataFrame:
    """``texts(uid, text)`` -> ``(key, uid, first, last)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column(0).to_numpy()
            for key, row, first, last in anchors(*utf8(batch.column(1))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(uid[row]), pa.array(first.astype(np.int32)),
                     pa.array(last.astype(np.int32))], ["key", "uid", "first", "last"])
    return small_batches(texts).select("uid", "text").mapInArrow(run, "key bigint, uid bigint, first int, last int")


WORK = ("n_bytes bigint, sha string, text string, first array<int>, last array<int>, key array<bigint>, "
        "h1 array<bigint>, h2 array<bigint>")


def gather(docs: DataFrame, kind: str) -> DataFrame:
    """``docs(uid, doc_id, text, found)`` with the anchors of each text that occur twice -> what is
    still to do: digests of texts that have none, else the text with its contexts' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(2))
            out = []
            for i in range(batch.num_rows):
                raw = data[offs[i]:offs[i + 1]]
                got = batch.column(3)[i].as_py()
                if not got:
                    out.append((len(raw), hashlib.sha256(raw.tobytes()).hexdigest(), None, *[None] * 5))
                    continue
                rows = sorted((g["first"], g["last"], g["key"]) for g in got)
                first, last = (np.array(c, np.int64) for c in zip(*((r[0], r[1]) for r in rows)))
                h1, h2 = _context_hashes(raw, first, last)
                out.append((len(raw), None, raw.tobytes().decode(), first.tolist(), last.tolist(),
                            [r[2] for r in rows], h1.tolist(), h2.tolist()))
            cols = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["uid", "doc_id", "n_bytes", "sha", "text", "first", "last", "key", "h1", "h2"])
    return small_batches(docs).select("uid", "doc_id", "text", "found") \
        .mapInArrow(run, f"uid bigint, doc_id {kind}, {WORK}")


def contexts(work: DataFrame) -> DataFrame:
    """``(key, h1, h2, n, bytes)``: the distinct contexts a task has seen, with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], list] = {}

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([k[0] for k in seen], pa.int64()),
                 pa.array([k[1] for k in seen], pa.int64()), pa.array([v[2] for v in seen.values()], pa.int64()),
                 pa.array([v[1] for v in seen.values()], pa.binary())], ["key", "h1", "h2", "n", "bytes"])
            seen.clear()
            return out
        for batch in batches:
            for row in range(batch.num_rows):
                text, *lists = (batch.column(c)[row].as_py() for c in range(6))
                raw = text.encode()
                for a, b, key, h1, h2 in zip(*lists):
                    got = seen.get((h1, h2))
                    if got is None:
                        seen[h1, h2] = [key, raw[a:b + WINDOW], 1]
                    else:
                        got[2] += 1
                if len(seen) > PENDING:
                    yield flush()
        if seen:
            yield flush()
    return (work.where("text is not null").select("text", "first", "last", "key", "h1", "h2")
            .mapInArrow(run, "key bigint, h1 bigint, h2 bigint, n bigint, bytes binary"))


def _spans_of(starts: np.ndarray) -> list[int]:
    """from, to, from, to, ... of the bytes that windows at the sorted ``starts`` cover."""
    if not len(starts):
        return []
    cut = np.nonzero(np.diff(starts) > WINDOW)[0]
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + WINDOW],
                    axis=1).reshape(-1).tolist()


def repeated_starts(parts: list[bytes]) -> list[np.ndarray]:
    """Per part: the starts of its windows that start elsewhere in the parts, too."""
    text = np.frombuffer(b"".join(p + bytes([SEPARATOR]) for p in parts) + b"\0", np.uint8)
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(size + 1) - (size + 1)
    symbols = text.astype(np.int64) + 1
    symbols[-1] = 0
    room = np.zeros(len(text), np.int64)
    at = concat_ranges(begin, size)
    room[at] = np.repeat(begin + size, size) - at
    phi, length = common_prefixes(text, suffix_array(symbols), room)
    hit = length >= WINDOW
    hit[phi[hit]] = True
    where = np.nonzero(hit)[0]
    cuts = np.searchsorted(where, np.append(begin, len(text)))
    return [where[cuts[i]:cuts[i + 1]] - begin[i] for i in range(len(parts))]


def shard_spans(rows: DataFrame) -> DataFrame:
    """``rows(key, h1, h2, n, bytes)``, a key's rows together -> ``(h1, h2, spans)``."""
    def solve(block: list[tuple]) -> pa.RecordBatch:
        found = repeated_starts([b[2] for b in block]) if block else []
        out = [(h1, h2, _spans_of(s)) for (h1, h2, _), s in zip(block, found) if len(s)]
        return _span_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, whole = [], 0, []
        group: dict[tuple[int, int], list] = {}
        last = None

        def close():
            nonlocal size
            for (h1, h2), (n, raw) in group.items():
                if n > 1:
                    whole.append((h1, h2, [0, len(raw)]))
            if len(group) > 1:  # alone, a context has nothing to share a window with
                block.extend((h1, h2, raw) for (h1, h2), (_, raw) in group.items())
                size += sum(len(raw) for _, raw in group.values())
            group.clear()
        for batch in batches:
            for key, h1, h2, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if key != last:
                    close()
                    last = key
                    if size > SHARD:
                        yield solve(block)
                        block, size = [], 0
                    if len(whole) > PENDING:
                        yield _span_batch(whole)
                        whole = []
                got = group.get((h1, h2))
                if got is None:
                    group[h1, h2] = [n, raw]
                else:
                    got[0] += n
        close()
        yield solve(block)
        yield _span_batch(whole)
    return rows.select("key", "h1", "h2", "n", "bytes").mapInArrow(run, "h1 bigint, h2 bigint, spans array<int>")


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["h1", "h2", "spans"])


def parts_of(raw: bytes, gram: int) -> tuple[np.ndarray, ...]:
    """``(key, first, end, h1, h2)`` of a context's parts: runs of windows of one anchor of ``gram`` bytes."""
    data = np.frombuffer(raw, np.uint8)
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    anchor = _least(grams, WINDOW - gram + 1)
    first = np.nonzero(np.append(True, anchor[1:] != anchor[:-1]))[0]
    end = np.append(first[1:], len(anchor)) - 1 + WINDOW
    return (grams[anchor[first]].view(np.int64), first, end, hashes.of(first, end).view(np.int64),
            Hashes(data, 1).of(first, end).view(np.int64))


def cut_contexts(rows: DataFrame, gram: int) -> DataFrame:
    """``rows(h1, h2, n, bytes)`` -> their parts ``(h1, h2, at, n, key, s1, s2, bytes)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h1, h2, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                key, first, end, s1, s2 = parts_of(raw, gram)
                k = len(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, h1)), pa.array(np.full(k, h2)), pa.array(first.astype(np.int32)), pa.array(np.full(k, n)),
                     pa.array(key), pa.array(s1), pa.array(s2),
                     pa.array([raw[a:b] for a, b in zip(first.tolist(), end.tolist())], pa.binary())],
                    ["h1", "h2", "at", "n", "key", "s1", "s2", "bytes"])
    return rows.select("h1", "h2", "n", "bytes").mapInArrow(
        run, "h1 bigint, h2 bigint, at int, n bigint, key bigint, s1 bigint, s2 bigint, bytes binary")


def large_keys(ids: DataFrame) -> DataFrame:
    """The keys of ``ids(key, h1, h2)`` with more different contexts than are sorted together."""
    return stored(ids.select("key", "h1", "h2").distinct().groupBy("key").count()
                  .where(F.col("count") > SHARD_CONTEXTS).select("key", F.lit(True).alias("large")), "large")


def sort_shards(rows: DataFrame) -> DataFrame:
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shard_spans(rows.repartition(n_parts, "key").sortWithinPartitions("key")).where("size(spans) > 0")


def repeated_spans(rows: DataFrame, ids: DataFrame, grams: tuple[int, ...] = GRAMS) -> DataFrame:
    """``rows(key, h1, h2, n, bytes)`` -> ``(h1, h2, spans)``; contexts of large keys are cut by the next
    of ``grams``, and their parts go the same way."""
    large = large_keys(ids)
    if not grams or not n_rows(large):   # (parts of one window are alone in their key)
        return sort_shards(rows)
    flagged = join_small(rows, large, "key", "left")
    parts = stored(cut_contexts(flagged.where("large"), grams[0]), "parts")
    merged = parts.groupBy("key", "s1", "s2").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes")) \
        .select("key", F.col("s1").alias("h1"), F.col("s2").alias("h2"), "n", "bytes")
    merged = stored(merged, "merged")
    found = repeated_spans(merged, merged, grams[1:]).select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "spans")
    handed = parts.select("h1", "h2", "at", "s1", "s2").distinct().join(found, ["s1", "s2"]) \
        .select("h1", "h2", F.transform("spans", lambda x: x + F.col("at")).alias("spans"))
    return sort_shards(flagged.where("large IS NULL").drop("large")).unionByName(handed)


def finish(rows: DataFrame, kind: str) -> DataFrame:
    """``rows(doc_id, n_bytes, sha, text, found)`` -> the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, n, sha, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                if sha is not None:
                    out.append((n, 0, 0, sha))
                    continue
                raw = text.encode()
                spans = sorted((f["first"] + a, f["first"] + b) for f in found or []
                               for a, b in zip(f["spans"][::2], f["spans"][1::2]))
                kept, end, removed, n_spans = hashlib.sha256(), 0, 0, 0
                for a, b in spans:
                    if not n_spans or a > end:
                        kept.update(raw[end:a])
                        n_spans += 1
                        removed += b - a
                        end = b
                    elif b > end:
                        removed += b - end
                        end = b
                kept.update(raw[end:])
                out.append((n, removed, n_spans, kept.hexdigest()))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return small_batches(rows).select("doc_id", "n_bytes", "sha", "text", "found").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def suffix_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    d = d.withColumn("uid", F.xxhash64("doc_id", "text"))  # rows of one uid are copies of each other
    found = stored(find_anchors(d), "anchors")
    # stored, so that the join back is of two plain shuffles and a hot key's rows can be split
    twice = stored(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "twice")
    # rows of one uid have the same anchors: a set, so that copies of a text don't lengthen it
    per_doc = found.join(twice, "key").groupBy("uid") \
        .agg(F.collect_set(F.struct("first", "last", "key")).alias("found"))
    work = stored(gather(d.join(per_doc, "uid", "left"), kind), "work")
    drop_stored(found)
    repeats = work.where("text is not null")
    ids = repeats.select(F.explode(F.arrays_zip("key", "h1", "h2")).alias("c")).select("c.key", "c.h1", "c.h2")
    spans = stored(repeated_spans(contexts(work), ids), "spans")
    each = repeats.select("uid", F.explode(F.arrays_zip("first", "h1", "h2")).alias("c")) \
        .select("uid", "c.first", "c.h1", "c.h2").distinct()
    per_uid = each.join(spans, ["h1", "h2"]).groupBy("uid") \
        .agg(F.collect_list(F.struct("first", "spans")).alias("found"))
    return finish(work.join(per_uid, "uid", "left"), kind)
