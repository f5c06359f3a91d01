"""Lookup of query hashes in an index.

Queries are ``(query_id, qhash)``.  Matches are
``query_id, doc_id, chunk_idx, offset, size, hash, distance, match_type``.

``on`` names extra columns that chunks and queries must share (e.g.
``chunk_size`` when one index holds several sizes).

The exact-first rule (fuzzy hits only when there is no exact hit) is decided on
*distinct* hashes: the decision depends only on the query hash and on the set of
index hashes, so repeated content never enlarges the theta join.  Chunks are
joined back by an equi-join on ``hash`` afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.validate import DEFAULT_MAX_DISTANCE, query_reject_reason
from ..sources.band_store import band_pairs
from .hamming_join import NESTED_MAX_ROWS, document_hits, few_per_key, hamming_pairs
from .sizing import is_small, join_small, materialize, n_rows

MATCH_COLUMNS = ("query_id", "doc_id", "chunk_idx", "offset", "size", "hash",
                 "distance", "match_type")


def valid_queries(queries: DataFrame) -> DataFrame:
    """Drop queries whose hash is missing or 0."""
    return queries.where(query_reject_reason("qhash").isNull())


def _match_type():
    return F.when(F.col("distance") == 0, F.lit("exact")).otherwise(F.lit("fuzzy"))


def hash_pairs(chunks: DataFrame, queries: DataFrame, k: int = DEFAULT_MAX_DISTANCE, *,
               on: tuple[str, ...] = (), strategy: str = "auto") -> DataFrame:
    """Distinct ``(on..., qhash, hash, distance)`` with distance <= k.

    With a tiny query side (nested plan; with ``on`` keys: few query hashes per
    key, planned as a broadcast hash join on the keys plus the bit-count filter)
    the index hashes are streamed through as they are and only the small result
    is made distinct, so the index is neither shuffled nor written.  Otherwise both
    sides are reduced to distinct hashes first and materialised, so size checks
    and the banded join read written data.  The result is materialised: it is
    read by size checks and by up to two expansion joins.
    """
    right = materialize(valid_queries(queries)
                        .select(*[F.col(c).alias(f"__q_{c}") for c in on], "qhash").distinct())
    keys = tuple((c, f"__q_{c}") for c in on)
    left = chunks.select(*on, "hash")
    if strategy == "banded" or not _few(right, [q for _, q in keys]):
        left, strategy = materialize(left.distinct()), "banded" if keys else strategy
    pairs = hamming_pairs(left, right, k, strategy=strategy, keys=keys)
    return materialize(pairs.select(*on, "qhash", "hash", "distance").distinct())


def _few(right: DataFrame, keys: list[str]) -> bool:
    """Is the (stored) query side small enough for the nested plan?

    Without keys: at most NESTED_MAX_ROWS hashes.  With keys the nested plan is a
    broadcast hash join on the keys plus the bit-count filter, so what matters is
    the number of query hashes per key (and that the side fits a broadcast).
    """
    if not keys:
        return n_rows(right) <= NESTED_MAX_ROWS
    return is_small(right) and few_per_key(right, keys)


def _expand(pairs: DataFrame, chunks: DataFrame, queries: DataFrame,
            on: tuple[str, ...]) -> DataFrame:
    """(on..., qhash, hash, distance) -> one row per (query, chunk)."""
    with_chunks = join_small(chunks.select(*on, "doc_id", "chunk_idx", "offset", "size", "hash"),
                             pairs, [*on, "hash"])
    with_q = join_small(with_chunks, queries.select(*on, "query_id", "qhash"), [*on, "qhash"])
    return with_q.select(*on, *[c for c in MATCH_COLUMNS if c != "match_type"],
                         _match_type().alias("match_type"))


def lookup_exact(chunks: DataFrame, queries: DataFrame, *, on: tuple[str, ...] = ()) -> DataFrame:
    """M2: chunks whose hash equals the query hash (equi-join)."""
    q = valid_queries(queries).select(*on, "query_id", F.col("qhash").alias("hash"))
    joined = join_small(chunks, q, [*on, "hash"])
    return joined.select(*on, "query_id", "doc_id", "chunk_idx", "offset", "size", "hash",
                         F.lit(0).alias("distance"), F.lit("exact").alias("match_type"))


def lookup_fuzzy(chunks: DataFrame, queries: DataFrame, k: int = DEFAULT_MAX_DISTANCE, *,
                 on: tuple[str, ...] = (), strategy: str = "auto") -> DataFrame:
    """M3: all chunks within distance k (distinct hashes compared once, then expanded)."""
    q = materialize(valid_queries(queries).select(*on, "query_id", "qhash"))
    return _expand(hash_pairs(chunks, q, k, on=on, strategy=strategy), chunks, q, on)


def lookup(chunks: DataFrame, queries: DataFrame, k: int = DEFAULT_MAX_DISTANCE, *,
           scope: str = "file", on: tuple[str, ...] = (), strategy: str = "auto",
           bands: DataFrame | None = None) -> DataFrame:
    """M4: exact hits if any, else hits within distance k; nothing if neither.

    ``scope='file'`` decides the fallback per (query, doc_id), as the reference does
    per index file; ``scope='corpus'`` decides it per query over all documents: queries
    with an exact hit never reach the theta join.  In the scope of a file more than ``NESTED_MAX_ROWS`` queries are asked in
    cells of whole documents (see ``document_hits``), which settle the rule themselves.  ``bands`` are the index's stored band tables (see
    sources/band_store), which then give the pairs.
    """
    if scope not in ("file", "corpus"):
        raise ValueError(f"unknown scope {scope!r}")
    q = materialize(valid_queries(queries).select(*on, "query_id", "qhash"))

    def near(some: DataFrame) -> DataFrame:
        if bands is not None:
            return materialize(band_pairs(bands, some, k))
        return hash_pairs(chunks, some, k, on=on, strategy=strategy)
    if scope == "corpus":
        hashes = q.select(*on, "qhash").distinct()
        found = materialize(join_small(chunks.select(*on, F.col("hash").alias("qhash")), hashes,
                                       [*on, "qhash"], "left_semi").distinct())
        exact = found.select(*on, "qhash", F.col("qhash").alias("hash"), F.lit(0).alias("distance"))
        rest = materialize(q.join(found, [*on, "qhash"], "left_anti"))
        kept = exact.unionByName(near(rest).select(*on, "qhash", "hash", "distance")) if n_rows(rest) else exact
        return _expand(materialize(kept), chunks, q, on)
    if bands is None and not on and strategy == "auto" and n_rows(q) > NESTED_MAX_ROWS:
        hits = document_hits(chunks.select("doc_id", "chunk_idx", "offset", "size", "hash"), q, k)
        return hits.select(*MATCH_COLUMNS[:-1], _match_type().alias("match_type"))
    pairs = near(q)
    # one expansion; a (query, file) with an exact hit keeps its exact hits only
    hits = materialize(_expand(pairs, chunks, q, on))
    best = hits.groupBy("query_id", "doc_id").agg(F.min("distance").alias("__best"))
    fuzzy_only = best.where(F.col("__best") > 0).select("query_id", "doc_id")
    exact = hits.where(F.col("distance") == 0)
    return exact.unionByName(hits.join(fuzzy_only, ["query_id", "doc_id"], "left_semi"))


def unmatched_queries(queries: DataFrame, matches: DataFrame) -> DataFrame:
    """M5: queries without any hit, plus rejected queries, each with a reason."""
    reason = query_reject_reason("qhash")
    rejected = queries.where(reason.isNotNull()).select("query_id", "qhash", reason.alias("reason"))
    hit = matches.select("query_id").distinct()
    missing = (valid_queries(queries).join(hit, "query_id", "left_anti")
               .select("query_id", "qhash", F.lit("no matches found").alias("reason")))
    return rejected.unionByName(missing)


def nearest(chunks: DataFrame, queries: DataFrame, n: int, *, k: int = DEFAULT_MAX_DISTANCE, step: int = 3,
            strategy: str = "auto") -> DataFrame:
    """The n chunks nearest to each valid query, however far: columns of matches and ``rank``.

    Distinct hashes are searched within a radius, which starts at ``k`` and is raised by ``step`` for the
    queries that haven't n chunks yet; a query with n chunks within its radius has its nearest among
    them, as nothing nearer lies outside.  A round's new hits of a query are few, since it had fewer than n
    before.  Ties go to the smaller (doc_id, offset); an index of fewer chunks gives them all.
    """
    q = materialize(valid_queries(queries).select("query_id", "qhash"))
    hashes = materialize(chunks.groupBy("hash").agg(F.count("*").alias("n")))
    left = hashes.select("hash")
    todo = materialize(q.select("qhash").distinct())
    radius, found = k, []
    while n_rows(todo) and n_rows(hashes):
        pairs = materialize(hamming_pairs(left, todo, radius, strategy=strategy).select("qhash", "hash", "distance"))
        have = join_small(hashes, pairs, "hash").groupBy("qhash").agg(F.sum("n").alias("n"))
        done = have.where(F.col("n") >= n).select("qhash") if radius < 64 else todo
        done = materialize(done)
        found.append(pairs.join(done, "qhash", "left_semi"))
        todo = materialize(todo.join(done, "qhash", "left_anti"))
        radius = min(64, radius + step)
    pairs = materialize(reduce(DataFrame.unionByName, found)) if found else None
    if pairs is None:
        return nearest_chunks(lookup_exact(chunks, q), n)
    return nearest_chunks(_expand(pairs, chunks, q, ()), n)


def nearest_chunks(matches: DataFrame, n: int) -> DataFrame:
    """The n nearest hits per query, ties broken by (doc_id, offset).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before the
    shuffle, so a query with very many hits sends at most n rows per map task.
    """
    w = Window.partitionBy("query_id").orderBy("distance", "doc_id", "offset")
    return (matches.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))
