"""Hamming-distance theta join on 64-bit hashes (M3 core, U1, U3).

Exact plans:

* ``nested``: broadcast the side of fewer hashes, whose bytes are checked, and test
  ``bit_count(a ^ b) <= k`` per pair in generated code.
* ``cells``: both sides are cut into blocks of about ``CELL_ROWS`` hashes, and a task holds one block of each
  (a cell).  There it runs multi-index hashing (Norouzi, Punjani, Fleet 2012; Manku et al.
  2007): the 64 bits are cut into m bands with radii r_i such that
  ``sum(r_i + 1) = k + 1``; if ``d(a, b) <= k`` some band i differs in at most r_i
  bits.  The block of more hashes is sorted by the band's value, the hashes of the other ask for every value
  within r_i, and what they find is checked on all 64 bits.  Probes and candidates
  stay in a task's arrays, ``PAIRS_AT_A_TIME`` of them at once: what is shuffled is a row a hash and block of the
  other side, whatever k is and however alike the hashes are.
* ``document_hits``: the same cells, dealt by documents, for lookups that decide by document and query.
* ``banded``: the same bands as a shuffled equi-join on ``(band, value)``, for joins with further keys.

A pair is kept only from the first band that admits it, so no ``distinct`` is needed.

The nested plan and the bands of the others are priced in bit counts: a pair of the nested plan is one, a row that
is shuffled and sorted ``ROW_COST``, a probe in a cell ``PROBE_COST``, a candidate ``CANDIDATE_COST``.  The nested plan
is taken while the pairs are the cheaper ones and no more than ``NESTED_MAX_PAIRS``.

Inputs should be stored tables of distinct hashes (callers aggregate first), so
repeated content never multiplies the candidates and sizes are counted once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hexcodec import hamming
from .sizing import is_small, materialize, n_rows

NESTED_MAX_ROWS = 64
#: Pairs that are still compared one by one.
NESTED_MAX_PAIRS = 2e10
#: Pairs that are compared in a second or so, whatever the other plans cost.
NESTED_ALWAYS = 4e8
#: A shuffled and sorted row, and a candidate of a sorted join, in bit counts of generated code.
ROW_COST, CANDIDATE_COST = 100, 10
#: No layout expands a hash into more rows than this.
MAX_PROBES = 20_000
#: Hashes of a block, and what a probe and a sorted hash of a cell cost.
CELL_ROWS, PROBE_COST, SORT_COST = 1 << 17, 20, 100
#: Probes, or candidates, that a cell has in its arrays at once.
PAIRS_AT_A_TIME = 1 << 19
#: Chunks of a cell of whole documents, at least, while there are few cells; rows of hits that are sent on together.
DOCUMENT_ROWS, HITS_AT_A_TIME = 8192, 1 << 16

try:  # ship the code with the tasks
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


def layout(m: int, k: int) -> list[tuple[int, int, int]]:
    """``m`` bands as (first bit, width, radius)."""
    out, start = [], 0
    for j in range(m):
        width = 64 // m + (j < 64 % m)
        radius = (k + 1) // m + (j < (k + 1) % m) - 1
        out.append((start, width, radius))
        start += width
    return out


def probes(bands: list[tuple[int, int, int]]) -> int:
    return sum(comb(w, i) for _, w, r in bands for i in range(r + 1))


def candidate_share(bands: list[tuple[int, int, int]]) -> float:
    """Share of all pairs of even random hashes that become candidates."""
    return min(1.0, sum(sum(comb(w, i) for i in range(r + 1)) / 2 ** w for _, w, r in bands))


def band_layout(k: int, n_small: int, n_large: int) -> list[tuple[int, int, int]]:
    """The cheapest layout for expanded, plain and (for even bits) candidate rows."""
    fit = [m for m in range(1, min(k + 1, 64) + 1) if probes(layout(m, k)) <= MAX_PROBES]
    return layout(min(fit or [min(k + 1, 64)], key=lambda m: banded_cost(layout(m, k), n_small, n_large)), k)


def banded_cost(bands: list[tuple[int, int, int]], n_small: int, n_large: int) -> float:
    rows = n_small * probes(bands) + n_large * len(bands)
    return ROW_COST * rows + CANDIDATE_COST * n_small * n_large * candidate_share(bands)


def cell_cost(bands: list[tuple[int, int, int]], n_small: int, n_large: int) -> float:
    """What the bands cost in a cell; without bands each pair is compared."""
    if not bands:
        return n_small * n_large
    return (PROBE_COST * n_small * probes(bands) + SORT_COST * n_large * len(bands)
            + CANDIDATE_COST * n_small * n_large * candidate_share(bands))


def cell_bands(k: int, n_small: int, n_large: int) -> list[tuple[int, int, int]]:
    """The cheapest layout for one cell."""
    fit = [layout(m, k) for m in range(1, min(k + 1, 8) + 1) if k < 64 and probes(layout(m, k)) <= MAX_PROBES]
    return min([[], *fit], key=lambda bands: cell_cost(bands, n_small, n_large))


def nested_is_cheaper(k: int, n_left: int, n_right: int) -> bool:
    """Whether comparing all pairs costs less than dealing both sides to cells and searching there."""
    pairs, small, large = n_left * n_right, min(n_left, n_right), max(n_left, n_right)
    if pairs > NESTED_MAX_PAIRS:
        return False
    cells = n_blocks(n_left) * n_blocks(n_right)
    bands = cell_bands(k, min(small, CELL_ROWS), min(large, CELL_ROWS))
    dealt = ROW_COST * (n_left * n_blocks(n_right) + n_right * n_blocks(n_left))
    return pairs <= NESTED_ALWAYS or pairs <= dealt + cells * cell_cost(bands, min(small, CELL_ROWS), min(large, CELL_ROWS))


def n_blocks(rows: int) -> int:
    return max(1, -(-rows // CELL_ROWS))


def band_masks(width: int, radius: int) -> list[int]:
    """All XOR masks of ``width`` bits with at most ``radius`` bits set."""
    masks = [0]
    last = [(0, 0)]  # mask, next free bit
    for _ in range(radius):
        last = [(m | 1 << b, b + 1) for m, free in last for b in range(free, width)]
        masks += [m for m, _ in last]
    return masks


def _band(h, start: int, width: int):
    part = F.shiftrightunsigned(h, start)
    return part if width == 64 else part.bitwiseAND(F.lit((1 << width) - 1))


def hamming_pairs(left: DataFrame, right: DataFrame, k: int, *, left_hash: str = "hash",
                  right_hash: str = "qhash", strategy: str = "auto",
                  nested_max_rows: int = NESTED_MAX_ROWS,
                  keys: tuple[tuple[str, str], ...] = (),
                  ordered: tuple[str, str] | None = None) -> DataFrame:
    """All ``(left row, right row, distance)`` with ``bit_count(l ^ r) <= k``.

    ``keys`` are extra ``(left column, right column)`` equalities (e.g. the chunk
    size); they become hash-join keys in both plans.  ``ordered`` keeps pairs whose
    left column is smaller than the right one (a self-join's half), before the
    check of the 64 bits.  Column names of the two sides must not overlap.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    if strategy not in ("auto", "nested", "banded"):
        raise ValueError(f"unknown strategy {strategy!r}")
    dist = hamming(left_hash, right_hash)
    extra = [F.col(lk) == F.col(rk) for lk, rk in keys]
    if ordered:
        extra.append(F.col(ordered[0]) < F.col(ordered[1]))
    if strategy != "banded":
        right = materialize(right)
        cond = dist <= k
        for e in extra:
            cond = e & cond
        if n_rows(right) <= nested_max_rows or keys and is_small(right) and few_per_key(
                right, [r for _, r in keys], nested_max_rows):
            return left.join(F.broadcast(right), cond, "inner").withColumn("distance", dist)
        left = materialize(left)
        n_left, n_right = n_rows(left), n_rows(right)
        if n_left <= nested_max_rows:
            return F.broadcast(left).join(right, cond, "inner").withColumn("distance", dist)
        if not keys and (strategy == "nested" or nested_is_cheaper(k, n_left, n_right)):
            if n_right <= n_left and is_small(right):
                return _dealt(left).join(F.broadcast(right), cond, "inner").withColumn("distance", dist)
            if n_left < n_right and is_small(left):
                return F.broadcast(left).join(_dealt(right), cond, "inner").withColumn("distance", dist)
    if keys:
        return _banded(materialize(left), materialize(right), k, left_hash, right_hash, extra, keys)
    return _cells(materialize(left), materialize(right), k, left_hash, right_hash, ordered)


def _dealt(table: DataFrame) -> DataFrame:
    """The streamed side over all cores: a table of hashes may be a single file."""
    return table.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def few_per_key(table: DataFrame, keys: list[str], most: int = NESTED_MAX_ROWS) -> bool:
    """Whether no key of a stored table has more than ``most`` rows."""
    per_key = table.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (per_key or 0) <= most


def _band_rows(df: DataFrame, hash_col: str, bands, expand: bool) -> DataFrame:
    """One row per band (and per mask of the band if ``expand``): ``__band, __bval``."""
    h = F.col(hash_col)
    values = []
    for j, (start, width, radius) in enumerate(bands):
        v = _band(h, start, width)
        signed = [m - (1 << 64) if m >> 63 else m for m in band_masks(width, radius)] if expand else [0]
        masks = F.array(*map(F.lit, signed))
        values.append(F.struct(F.lit(j).alias("j"), v.alias("v"), masks.cast("array<bigint>").alias("masks")))
    rows = df.select("*", F.explode(F.array(*values)).alias("__b"))
    if not expand:
        return rows.select(*df.columns, F.col("__b.j").alias("__band"), F.col("__b.v").alias("__bval"))
    return (rows.select(*df.columns, F.col("__b.j").alias("__band"), F.col("__b.v").alias("__v"),
                        F.explode("__b.masks").alias("__m"))
            .select(*df.columns, "__band", F.col("__v").bitwiseXOR(F.col("__m")).alias("__bval")))


def _banded(left, right, k, left_hash, right_hash, extra, keys):
    n_left, n_right = n_rows(left), n_rows(right)
    bands = band_layout(k, min(n_left, n_right), max(n_left, n_right))
    lrows = _band_rows(left, left_hash, bands, n_left < n_right).withColumnRenamed("__band", "__lband") \
        .withColumnRenamed("__bval", "__lval")
    rrows = _band_rows(right, right_hash, bands, n_left >= n_right)
    cond = (F.col("__lband") == F.col("__band")) & (F.col("__lval") == F.col("__bval"))
    for e in extra:
        cond = cond & e
    joined = lrows.join(rrows, cond, "inner")
    dist = hamming(left_hash, right_hash)
    # keep a pair only from the first band whose distance is within its radius
    first = dist <= k
    for j, (start, width, radius) in enumerate(bands[:-1]):
        apart = F.bit_count(_band(F.col(left_hash), start, width)
                            .bitwiseXOR(_band(F.col(right_hash), start, width)))
        first = first & ((F.col("__band") <= j) | (apart > radius))
    return joined.where(first).select(*left.columns, *right.columns, dist.alias("distance"))


# -- cells ---------------------------------------------------------------------


def near_pairs(a: np.ndarray, b: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(places in a, places in b, distances)`` of all pairs of 64-bit hashes within ``k``, a part at a time."""
    if len(a) > len(b):
        for i, j, d in near_pairs(b, a, k):
            yield j, i, d
        return
    if not len(a):
        return
    yield from BandTables(b, k, cell_bands(k, len(a), len(b))).near(a)


class BandTables:
    """Hashes sorted by each band's value, to be asked for those within ``k`` of others."""

    def __init__(self, hashes: np.ndarray, k: int, bands: list[tuple[int, int, int]]):
        self.hashes, self.k, self.bands, self.tables = hashes.view(np.uint64), k, bands, {}

    def table(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
        """Of the n-th band: order, values and hashes in that order, where each value begins, masks within the radius."""
        if n not in self.tables:
            start, width, radius = self.bands[n]
            other = _bits(self.hashes, start, width)
            order = np.argsort(other, kind="stable")
            other = other[order]
            first = np.searchsorted(other, np.arange((1 << width) + 1, dtype=np.uint64)) if width <= 20 else None
            self.tables[n] = order, other, self.hashes[order], first, np.array(band_masks(width, radius), np.uint64)
        return self.tables[n]

    def near(self, a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(places in a, places in the hashes, distances)``, a part at a time."""
        a, k, bands = a.view(np.uint64), self.k, self.bands
        if not bands:
            step = max(1, PAIRS_AT_A_TIME // max(1, len(self.hashes)))
            for at in range(0, len(a), step):
                apart = np.bitwise_count(a[at:at + step, None] ^ self.hashes[None, :])
                i, j = np.nonzero(apart <= k)
                yield i + at, j, apart[i, j]
        for n, (start, width, _) in enumerate(bands):
            order, other, sorted_b, first, masks = self.table(n)
            mine = _bits(a, start, width)
            step = max(1, PAIRS_AT_A_TIME // len(masks))
            for at in range(0, len(a), step):
                values = (mine[at:at + step, None] ^ masks[None, :]).reshape(-1)
                if first is not None:
                    lo, hi = first[values], first[values + np.uint64(1)]
                else:
                    lo, hi = np.searchsorted(other, values, "left"), np.searchsorted(other, values, "right")
                asked = np.nonzero(hi > lo)[0]
                lo, count = lo[asked], (hi - lo)[asked] if len(asked) == len(hi) else hi[asked] - lo[asked]
                row, upto, done = asked // len(masks) + at, np.cumsum(count), 0
                while done < len(asked):
                    before = int(upto[done - 1]) if done else 0
                    end = max(done + 1, int(np.searchsorted(upto, before + PAIRS_AT_A_TIME, "right")))
                    c = count[done:end]
                    i = np.repeat(row[done:end], c)
                    place = np.arange(len(i)) + np.repeat(lo[done:end] - (upto[done:end] - c - before), c)
                    x = a[i] ^ sorted_b[place]
                    apart = np.bitwise_count(x)
                    ok = apart <= k
                    for s, w, r in bands[:n]:  # a pair of an earlier band has come already
                        ok &= np.bitwise_count(_bits(x, s, w)) > r
                    hit = np.nonzero(ok)[0]
                    if len(hit):
                        yield i[hit], order[place[hit]], apart[hit]
                    done = end


def _bits(h: np.ndarray, start: int, width: int) -> np.ndarray:
    return (h >> np.uint64(start)) & np.uint64((1 << width) - 1)


def _cells(left: DataFrame, right: DataFrame, k: int, left_hash: str, right_hash: str,
           ordered: tuple[str, str] | None) -> DataFrame:
    """All pairs within k: every block of the left side meets every block of the right one in a cell."""
    a, b = n_blocks(n_rows(left)), n_blocks(n_rows(right))

    def block(h: str, n: int):
        return F.pmod(F.xxhash64(h), F.lit(n))

    lrows = left.where(F.col(left_hash).isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("__other"), F.lit(0).alias("__side"), *left.columns) \
        .withColumn("__cell", block(left_hash, a) * b + F.col("__other")).drop("__other")
    rrows = right.where(F.col(right_hash).isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(a - 1))).alias("__other"), F.lit(1).alias("__side"), *right.columns) \
        .withColumn("__cell", F.col("__other") * b + block(right_hash, b)).drop("__other")
    both = lrows.unionByName(rrows, allowMissingColumns=True).select("__cell", "__side", *left.columns, *right.columns)
    both = both.repartition(a * b, "__cell").sortWithinPartitions("__cell", "__side")
    lcols, rcols = left.columns, right.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cell_pairs(batches, lcols, rcols, left_hash, right_hash, k, ordered)
    schema = ", ".join(f"`{c}` {t}" for c, t in [*left.dtypes, *right.dtypes])
    return both.mapInArrow(run, f"{schema}, distance int")


def cell_pairs(batches: Iterator[pa.RecordBatch], lcols: list[str], rcols: list[str], left_hash: str, right_hash: str, k: int,
               ordered: tuple[str, str] | None = None) -> Iterator[pa.RecordBatch]:
    """The pairs of each cell of ``batches(__cell, __side, left columns, right columns)``, sorted by cell and side."""
    def solve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        n = int((rows.column("__side").to_numpy() == 0).sum())
        l, r = rows.slice(0, n).select(lcols), rows.slice(n).select(rcols)
        for i, j, d in near_pairs(l.column(left_hash).to_numpy(), r.column(right_hash).to_numpy(), k):
            for at in range(0, len(i), PAIRS_AT_A_TIME):
                x, y, z = (pa.array(v[at:at + PAIRS_AT_A_TIME]) for v in (i, j, d))
                if ordered:
                    kept = pc.less(l.column(ordered[0]).take(x), r.column(ordered[1]).take(y)).combine_chunks()
                    x, y, z = (v.filter(kept, null_selection_behavior="drop") for v in (x, y, z))
                cols = [*(l.column(c).take(x) for c in lcols), *(r.column(c).take(y) for c in rcols)]
                yield pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in cols), z.cast(pa.int32())],
                                                 [*lcols, *rcols, "distance"])

    for held in _cells_of(batches):
        yield from solve(held)


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each cell; the first column is its number."""
    held, cell = [], None
    for batch in batches:
        number = batch.column(0).to_numpy()
        cuts = [0, *(np.nonzero(np.diff(number))[0] + 1).tolist(), len(number)]
        for x, y in zip(cuts, cuts[1:]):
            if x == y:
                continue
            if held and cell != number[x]:
                yield held
                held = []
            cell = number[x]
            held.append(batch.slice(x, y - x))
    if held:
        yield held


# -- cells of whole documents ----------------------------------------------------


def document_hits(chunks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``chunks(doc_id, hash, ...)``, ``queries(query_id, qhash)`` -> their rows with the ``distance``, at most ``k``; a query
    that has exact hits in a document has no others there.

    A cell holds all chunks of its documents and all rows of its queries, so that rule is settled in it, and hits go out
    as they are found: none is written or shuffled.  What moves is a chunk once a block of queries, and a query
    once a block of documents."""
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks, queries = chunks.where("hash is not null"), queries.where("qhash is not null")
    n = n_rows(chunks)
    a = max(n_blocks(n), min(4 * parts, -(-n // DOCUMENT_ROWS)))     # small cells while there are few
    b = n_blocks(n_rows(queries))

    def dealt(side: DataFrame, number: int, mine, others: int, cell) -> DataFrame:
        return side.select(F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("__other"), F.lit(number).alias("__side"),
                           *side.columns).withColumn("__cell", cell(mine, F.col("__other"))).drop("__other")
    crows = dealt(chunks, 0, F.pmod(F.xxhash64("doc_id"), F.lit(a)), b, lambda mine, other: mine * b + other)
    qrows = dealt(queries, 1, F.pmod(F.xxhash64("query_id"), F.lit(b)), a, lambda mine, other: other * b + mine)
    both = crows.unionByName(qrows, allowMissingColumns=True).select("__cell", "__side", *chunks.columns, *queries.columns)
    both = both.repartition(a * b, "__cell").sortWithinPartitions("__cell", "__side")
    ccols, qcols = chunks.columns, queries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return cell_hits(batches, ccols, qcols, k)
    schema = ", ".join(f"`{c}` {t}" for c, t in [*chunks.dtypes, *queries.dtypes])
    return both.mapInArrow(run, f"{schema}, distance int")


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each distinct value, -1 for nulls."""
    codes = column.combine_chunks().dictionary_encode()
    return pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, the places of all values in their order, and where each distinct one's begin (and the last end)."""
    order = np.argsort(values, kind="stable")
    distinct, first = np.unique(values[order], return_index=True)
    return distinct, order, np.append(first, len(values))


def _all_places(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``which``: its number, repeated, and the places from ``first`` of it to that of the next."""
    count = first[which + 1] - first[which]
    row = np.repeat(np.arange(len(which)), count)
    return row, np.arange(len(row)) + np.repeat(first[which] - (np.cumsum(count) - count), count)


def _expanded(cfirst: np.ndarray, i: np.ndarray, qfirst: np.ndarray, j: np.ndarray
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of chunks and of queries for all pairs of a hash ``i`` and a hash ``j``, and the number of the pair,
    ``HITS_AT_A_TIME`` or so at once."""
    c, q = cfirst[i + 1] - cfirst[i], qfirst[j + 1] - qfirst[j]
    upto = np.cumsum(c * q)
    for at in range(0, int(upto[-1]) if len(upto) else 0, HITS_AT_A_TIME):
        hit = np.arange(at, min(at + HITS_AT_A_TIME, int(upto[-1])))
        pair = np.searchsorted(upto, hit, "right")
        nth = hit - (upto[pair] - c[pair] * q[pair])
        yield cfirst[i[pair]] + nth // q[pair], qfirst[j[pair]] + nth % q[pair], pair


def cell_hits(batches: Iterator[pa.RecordBatch], ccols: list[str], qcols: list[str], k: int) -> Iterator[pa.RecordBatch]:
    """The hits of each cell of ``batches(__cell, __side, columns of chunks, columns of queries)``, sorted by cell and side."""
    def solve(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        n = int((rows.column("__side").to_numpy() == 0).sum())
        c, q = rows.slice(0, n).select(ccols), rows.slice(n).select(qcols)
        if not len(c) or not len(q):
            return
        hashes, corder, cfirst = _places(c.column("hash").to_numpy())
        asked, qorder, qfirst = _places(q.column("qhash").to_numpy())
        doc, query = _numbers(c.column("doc_id")), _numbers(q.column("query_id"))
        # what an exact hit settles: all of a query id's rows, which nearly always are of one hash, whose number then serves
        of = np.empty(len(q), np.int64)
        of[qorder] = np.repeat(np.arange(len(asked)), np.diff(qfirst))
        ids, where, idfirst = _places(query)
        lowest, highest = np.minimum.reduceat(of[where], idfirst[:-1]), np.maximum.reduceat(of[where], idfirst[:-1])
        several = np.searchsorted(ids, query)
        group = np.where(lowest[several] == highest[several], of, len(asked) + several)
        n_docs = int(doc.max(initial=-1)) + 2
        key, number = np.unique(np.stack([of, group]), axis=1)
        at = np.searchsorted(hashes, asked[key])
        found = np.nonzero((at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == asked[key]))[0]
        row, place = _all_places(cfirst, at[found])
        exact = np.append(np.unique(number[found][row] * n_docs + doc[corder[place]] + 1), np.iinfo(np.int64).max)

        out, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            x, y, z = (pa.array(np.concatenate(v)) for v in zip(*out))
            out, size = [], 0
            cols = [*(c.column(name).take(x) for name in ccols), *(q.column(name).take(y) for name in qcols)]
            return pa.RecordBatch.from_arrays([*(v.combine_chunks() for v in cols), z.cast(pa.int32())],
                                              [*ccols, *qcols, "distance"])
        for i, j, d in near_pairs(hashes, asked, k):
            d = d.astype(np.int32)
            for x, y, pair in _expanded(cfirst, i, qfirst, j):
                x, y = corder[x], qorder[y]
                other = np.nonzero(d[pair])[0]
                code = group[y[other]] * n_docs + doc[x[other]] + 1
                # a fuzzy hit without an id goes, as in a join on ids
                keep = np.ones(len(x), bool)
                keep[other] = (exact[np.searchsorted(exact, code)] != code) & (doc[x[other]] >= 0) & (query[y[other]] >= 0)
                if keep.any():
                    out.append((x[keep], y[keep], d[pair][keep]))
                    size += len(out[-1][0])
                if size >= HITS_AT_A_TIME:
                    yield flush()
        if out:
            yield flush()

    for held in _cells_of(batches):
        yield from solve(held)
