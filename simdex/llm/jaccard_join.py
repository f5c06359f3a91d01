r"""N-gram Jaccard join (operator 4).

All pairs of texts whose sets of five-word shingles have a Jaccard similarity of
at least 0.8, as groups: one row per document with its class (the connected group
of linked texts) and its number of links.  Texts of equal shingle sets are one
text with several copies; copies are never expanded into pairs.

Method: Bayesian candidate pruning.  Every set gets MinHash values.  Texts that agree in
all values of some band of ``BAND`` are put into one coarse group (a pair at the
threshold misses all ``BANDS`` bands with a chance of 6e-7).  Inside a coarse group pairs
are compared on their MinHash values in steps; after each step a pair is dropped when the
posterior probability that its similarity reaches the threshold (even prior, Beta
posterior) is below ``TOLERANCE``; what is left is verified exactly on the shingle sets.

A coarse group is cut into blocks of ``BLOCK`` texts, and each pair of blocks is a
cell, so a group of any size spreads over tasks.  A cell sends on one row per
linked text: how many links it has there, and one text that it hangs together
with, so the links of a group are counted in full but never written out.  Bands
are chained from each text to the smallest text of the band (rows, not pairs), and
no band is collected.  Bands that are not of near copies can chain texts into a
coarse group that are not alike; that costs comparisons but changes no result.

Words are runs of ``[^\x20\x09-\x0D]``; a text of one to four words has one shingle, all of
them.  Defined results: a null text or one without a word has no shingle, links to
nothing and is a class of its own row's id; rows that repeat are copies; the class id
is the smallest doc_id of the group (null only if the group has none); other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import stored
from ..plans.graph import star_components
from .common import concat_ranges, is_space, small_batches, utf8

SHINGLE = 5
THRESHOLD = 0.8
BAND, BANDS = 5, 36
HASHES = BAND * BANDS
STEP = 36                 # MinHash values compared between two prunings
TOLERANCE = 1e-7
BLOCK = 512               # texts of a block
CHUNK_BYTES = 1_000_000   # text a task shingles side by side

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K2
    x = (x ^ (x >> np.uint64(29))) * _K1
    return x ^ (x >> np.uint64(32))


@lru_cache(1)
def _seeds() -> np.ndarray:
    return np.random.default_rng(20_240_229).integers(1, 1 << 63, (HASHES, 2), np.uint64) | np.uint64(1)


# -- shingles and sketches ---------------------------------------------------


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, sorted, end to end; and how many."""
    space = is_space(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    word = ~space
    starts = np.nonzero(word & (np.append(True, space[:-1]) | cut[:-1]))[0] if len(data) else np.zeros(0, np.int64)
    ends = np.nonzero(word & (np.append(space[1:], True) | cut[1:]))[0] + 1 if len(data) else starts
    # hash of a word: a keyed sum over its bytes and their places, then mixed
    place = concat_ranges(np.zeros(len(starts), np.int64), ends - starts)
    at = concat_ranges(starts, ends - starts)
    part = _mix((data[at].astype(np.uint64) + np.uint64(1)) * _K1 + place.astype(np.uint64) * _K2)
    h = _mix(np.add.reduceat(part, np.cumsum(ends - starts) - (ends - starts))) if len(starts) else part
    n = np.diff(np.searchsorted(starts, offs))
    total = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    first = np.cumsum(n) - n
    long = n >= SHINGLE
    out = np.zeros(int(total.sum()), np.uint64)
    row = np.repeat(np.arange(len(n)), total)
    w = concat_ranges(first, total)
    inside = long[row]
    if inside.any():
        s = np.zeros(int(inside.sum()), np.uint64)
        for j in range(SHINGLE):
            s = _mix(s + h[w[inside] + j] + np.uint64(j))
        out[inside] = s
    for i in np.nonzero((n > 0) & ~long)[0]:
        s = np.zeros(1, np.uint64)
        for j in range(n[i]):
            s = _mix(s + h[first[i] + j:first[i] + j + 1] + np.uint64(64 + j))
        out[np.searchsorted(row, i)] = s[0]
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[keep], np.bincount(row[keep], minlength=len(n))


def sketch(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values (texts, HASHES) of the texts that have shingles; others keep zeros."""
    out = np.zeros((len(counts), HASHES), np.uint64)
    full = np.nonzero(counts)[0]
    if len(full):
        first = (np.cumsum(counts) - counts)[full]
        for i, (a, b) in enumerate(_seeds()):
            out[full, i] = np.minimum.reduceat((sets ^ a) * b, first)
    return _mix(out)


def _digest(sets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for the set."""
    full = np.nonzero(counts)[0]
    out = np.zeros((2, len(counts)), np.uint64)
    if len(full):
        first = (np.cumsum(counts) - counts)[full]
        for i, k in enumerate((_K1, _K2)):
            out[i, full] = _mix(np.add.reduceat(_mix(sets * k + np.uint64(i)), first))
    return out[0].view(np.int64), out[1].view(np.int64)


def _runs(offs: np.ndarray) -> Iterator[tuple[int, int]]:
    row = 0
    while row < len(offs) - 1:
        end = max(row + 1, int(np.searchsorted(offs, offs[row] + CHUNK_BYTES, "right")) - 1)
        yield row, end
        row = end


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; rows that agree in it and the id are interchangeable."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, row, node, check, n, sig)`` of every row: ``row`` is a hash of all its columns,
    ``node`` and ``check`` stand for its shingle set, ``sig`` holds 64-bit band keys (BANDS of
    them) and then a byte per MinHash value."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = utf8(batch.column(2))
            for a, b in _runs(offs):
                sets, counts = shingles(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                values = sketch(sets, counts)
                node, check = _digest(sets, counts)
                keys = np.zeros((b - a, BANDS), np.uint64)
                for j in range(BANDS):
                    for i in range(BAND):
                        keys[:, j] = _mix(keys[:, j] + values[:, j * BAND + i] + np.uint64(j))
                sig = np.concatenate([keys.view(np.uint8), (values & np.uint64(255)).astype(np.uint8)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(node),
                     pa.array(check), pa.array(counts.astype(np.int32)),
                     pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["doc_id", "row", "node", "check", "n", "sig"])
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), row_hash(docs).alias("row"),
                                       F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, row bigint, node bigint, check bigint, n int, sig binary"))


# -- coarse groups -----------------------------------------------------------


def band_rows(texts: DataFrame) -> DataFrame:
    """``(key, node)`` for every band of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                keys = np.ascontiguousarray(sig[:, :8 * BANDS]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1)), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))],
                    ["key", "node"])
    return texts.select("node", "sig").mapInArrow(run, "key bigint, node bigint")


def coarse_groups(texts: DataFrame) -> DataFrame:
    """``(node, grp, size)`` of the texts that share a band with another one."""
    rows = band_rows(texts)
    least = rows.groupBy("key").agg(F.min("node").alias("rep"), F.max("node").alias("last")).where("rep < last")
    edges = rows.join(least, "key").where("node <> rep").select("node", "rep").distinct()
    found, _ = star_components(edges, src="node", dst="rep")
    found = stored(found, "coarse")
    # stored, so that the join back is of two plain shuffles and a large group's rows can be split
    sizes = stored(found.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    return found.join(sizes, "component").select("node", F.col("component").alias("grp"), "size")


# -- cells -------------------------------------------------------------------


@lru_cache(64)
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest matches among ``n`` MinHash values at which the similarity may still reach the
    threshold: P(J >= t | m of n) = P(Binomial(n + 1, t) <= m) with an even prior."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n + 1


def candidates(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, tolerance: float
               ) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two blocks of MinHash bytes that no step drops (``same``: i < j only)."""
    got = np.zeros((len(a), len(b)), np.int16)
    for h in range(STEP):
        got += a[:, h][:, None] == b[:, h][None, :]
    alive = got >= least_matches(STEP, threshold, tolerance)
    i, j = np.nonzero(np.triu(alive, 1) if same else alive)
    m = got[i, j].astype(np.int64)
    for at in range(STEP, HASHES, STEP):
        if not len(i):
            break
        upto = min(at + STEP, HASHES)
        m += (a[i, at:upto] == b[j, at:upto]).sum(axis=1)
        keep = m >= least_matches(upto, threshold, tolerance)
        i, j, m = i[keep], j[keep], m[keep]
    return i, j


def overlaps(sets: np.ndarray, counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersection of the sets i and j of each pair."""
    if len(i) <= 64:
        cuts = np.split(sets, np.cumsum(counts)[:-1])
        return np.array([len(np.intersect1d(cuts[x], cuts[y], True)) for x, y in zip(i, j)], np.int64)
    used = np.unique(np.concatenate([i, j]))
    place = np.zeros(len(counts), np.int64)
    place[used] = np.arange(len(used))
    _, col = np.unique(sets, return_inverse=True)
    row = np.repeat(np.arange(len(counts)), counts)
    mine = np.isin(row, used)
    row, col = place[row[mine]], col[mine]
    seen = np.bincount(col)
    shared = np.nonzero(seen > 1)[0]  # a shingle of one text only adds to no intersection
    rank = np.full(len(seen), -1)
    rank[shared] = np.arange(len(shared))
    out = np.zeros((len(used), len(used)), np.float32)
    for at in range(0, len(shared), 2048):
        here = (rank[col] >= at) & (rank[col] < at + 2048)
        x = np.zeros((len(used), min(2048, len(shared) - at)), np.float32)
        x[row[here], rank[col[here]] - at] = 1
        out += x @ x.T
    return out[place[i], place[j]].astype(np.int64)


def linked(sigs: np.ndarray, sets: np.ndarray, counts: np.ndarray, split: int, threshold: float
           ) -> tuple[np.ndarray, np.ndarray]:
    """Links of a cell.  ``split`` is where its second block begins (0: one block with itself)."""
    same = split == 0
    a, b = (sigs, sigs) if same else (sigs[:split], sigs[split:])
    i, j = candidates(a, b, same, threshold, TOLERANCE)
    j = j + split
    both = overlaps(sets, counts, i, j) if len(i) else np.zeros(0, np.int64)
    # an exact check: intersection / union >= threshold
    ok = both >= threshold * (counts[i] + counts[j] - both) - 1e-9
    return i[ok], j[ok]


def hang_together(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each row hangs together with through the links."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def cell_links(cells: DataFrame, threshold: float) -> DataFrame:
    """``cells(cell, block, node, sig, text)``, a cell's rows together -> ``(node, root, links)``."""
    def one(rows: list[tuple]) -> pa.RecordBatch | None:
        rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: (r[0], r[1]))  # (block, node, ...)
        blocks = np.array([r[0] for r in rows])
        split = int(np.searchsorted(blocks, blocks[0], "right")) % len(rows)
        nodes = np.array([r[1] for r in rows], np.int64)
        sigs = np.frombuffer(b"".join(r[2][8 * BANDS:] for r in rows), np.uint8).reshape(len(rows), HASHES)
        sets, counts = shingles(*utf8(pa.array([r[3] for r in rows], pa.large_string())))
        i, j = linked(sigs, sets, counts, split, threshold)
        if not len(i):
            return None
        links = np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
        at = np.nonzero(links)[0]
        root = hang_together(len(rows), i, j)
        return pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(nodes[root[at]]), pa.array(links[at])],
                                          ["node", "root", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for c, *row in zip(*(col.to_pylist() for col in batch.columns)):
                if c != cell:
                    if len(rows) > 1 and (out := one(rows)) is not None:
                        yield out
                    cell, rows = c, []
                rows.append(tuple(row))
        if len(rows) > 1 and (out := one(rows)) is not None:
            yield out
    return cells.select("cell", "block", "node", "sig", "text") \
        .mapInArrow(run, "node bigint, root bigint, links bigint")


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, class_id, n_links, class_size, copies, row, class)``: one row a document;
    ``n_links`` counts the other texts that are similar, ``class_size`` documents, ``copies`` those
    of equal sets.  ``row`` (see row_hash) and ``class`` (null: no word) name the row and its class
    even where ids repeat."""
    spark = docs.sparkSession
    rows = stored(sketches(docs, doc_id, text), "sketches")
    texts = stored(rows.where("n > 0").groupBy("node", "check").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("row", "doc_id")).alias("rep"), F.first("sig").alias("sig"),
        F.count("*").alias("copies")), "texts")
    # what the documents look like as texts: no doc_id, no digest
    groups = coarse_groups(texts)
    # a text is fetched by one row that holds it: ids may repeat or be null
    member = texts.join(groups, "node").select("node", "sig", "grp", "size", F.col("rep.doc_id").alias("_id"),
                                               F.col("rep.row").alias("_row"))
    source = docs.select(F.col(doc_id).alias("_id2"), row_hash(docs).alias("_row2"),
                         F.col(text).cast("string").alias("text"))
    blocks = F.ceil(F.col("size") / BLOCK)
    placed = (member.join(source, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_row") == F.col("_row2")))
              .withColumn("block", F.pmod(F.xxhash64("node"), blocks)))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    cells = placed.withColumn("other", other).withColumn(
        "cell", F.xxhash64("grp", F.least("block", "other"), F.greatest("block", "other")))
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = stored(cell_links(small_batches(cells).repartition(n_parts, "cell")
                              .sortWithinPartitions("cell"), threshold), "links")
    classes, _ = star_components(found.where("node <> root"), src="node", dst="root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_text = stored(texts.select("node", "check", "doc_id", "copies")
                      .join(classes, "node", "left").join(links, "node", "left")
                      .select("node", "check", F.coalesce("component", "node").alias("class"), "doc_id", "copies",
                              F.coalesce("links", F.lit(0)).alias("n_links")), "classes")
    per_class = per_text.groupBy("class").agg(F.min("doc_id").alias("class_id"),
                                              F.sum("copies").alias("class_size"))
    known = per_text.join(per_class, "class").select("node", "check", "class_id", "n_links", "class_size", "copies",
                                                     "class")
    with_words = rows.where("n > 0").select("doc_id", "row", "node", "check").join(known, ["node", "check"]) \
        .select("doc_id", "class_id", "n_links", "class_size", "copies", "row", "class")
    one = F.lit(1).cast("bigint")
    wordless = rows.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"),
                                          F.lit(0).cast("bigint").alias("n_links"),
                                          one.alias("class_size"), one.alias("copies"), "row",
                                          F.lit(None).cast("bigint").alias("class"))
    return with_words.unionByName(wordless)


def drop_near_copies(docs: DataFrame, joined: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """One row of each class of ``docs`` (of the smallest doc_id); rows without a word all stay, but
    of rows that agree in every column one is left."""
    first = joined.where(F.col("class").isNotNull()).groupBy("class") \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("f"))
    keep = first.select(F.col("f.doc_id").alias("_keep"), F.col("f.row").alias("_row2")) \
        .unionByName(joined.where(F.col("class").isNull())
                     .select(F.col("doc_id").alias("_keep"), F.col("row").alias("_row2"))).distinct()
    rows = docs.withColumn("_row", row_hash(docs))
    same = F.col(doc_id).eqNullSafe(F.col("_keep")) & (F.col("_row") == F.col("_row2"))
    return rows.join(keep, same, "left_semi").dropDuplicates([doc_id, "_row"]).drop("_row")
