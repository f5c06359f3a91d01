"""Plagiarism detection (U3): index reference texts, look up every chunk of every
submission, and score each (submission, reference) pair.

Both sides are chunked with one ``chunk_size``; submissions may use a smaller
``stride`` (overlapping chunks) so a copied passage is found whatever its
alignment.  Matching runs on distinct hashes with the exact-first rule per
submission hash over the whole reference collection; the hits are then joined
back to submission chunks and reference chunks and aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.validate import DEFAULT_MAX_DISTANCE
from ..operators.index import build_index
from ..operators.lookup import hash_pairs
from ..operators.sizing import join_small, materialize

DEFAULT_PLAGIARISM_CHUNK = 128


def plagiarism_matches(references: DataFrame, submissions: DataFrame, *,
                       chunk_size: int = DEFAULT_PLAGIARISM_CHUNK, stride: int | None = None,
                       k: int = DEFAULT_MAX_DISTANCE, features: str = "word",
                       method: str = "arrow", strategy: str = "auto") -> DataFrame:
    """``references(doc_id, content)`` and ``submissions(doc_id, content)`` ->
    ``(doc_id, ref_id, matched_chunks, n_chunks, share, mean_distance, min_distance)``."""
    ref, sub, kept = _chunk_matches(references, submissions, chunk_size, stride, k, features, method, strategy)
    ref_hashes = ref.select(F.col("doc_id").alias("ref_id"), "hash").distinct()
    sub_hashes = materialize(sub.groupBy("doc_id", "qhash")
                             .agg(F.count("*").cast("bigint").alias("n")))
    # submission hash -> reference document, with how many chunk pairs and how far
    hits = materialize(ref_hashes.join(kept, "hash").groupBy("qhash", "ref_id")
                       .agg(F.count("*").cast("bigint").alias("m"), F.sum("distance").alias("sum_d"),
                            F.min("distance").alias("min_d")))
    step = stride or chunk_size
    totals = submissions.select(
        "doc_id", F.ceil(F.octet_length("content") / F.lit(step)).cast("bigint").alias("n_chunks"))
    n = F.col("n")
    scored = (sub_hashes.join(hits, "qhash").groupBy("doc_id", "ref_id")
              .agg(F.sum("n").cast("bigint").alias("matched_chunks"),
                   F.round(F.sum(n * F.col("sum_d")) / F.sum(n * F.col("m")), 6).alias("mean_distance"),
                   F.min("min_d").alias("min_distance")))
    return (totals.join(scored, "doc_id")
            .select("doc_id", "ref_id", "matched_chunks", "n_chunks",
                    F.round(F.col("matched_chunks") / F.col("n_chunks"), 6).alias("share"),
                    "mean_distance", "min_distance"))


def _chunk_matches(references, submissions, chunk_size, stride, k, features, method, strategy):
    """The chunks of the references (stored, with words), those of the submissions that match one (their hash as
    ``qhash``), and ``kept(qhash, hash, distance)``: what a submission's hash matches, exact first over the whole
    reference collection."""
    # wordless chunks all share hash -1 and say nothing: they match nothing
    cols = ("doc_id", "offset", "size", "hash")
    ref = materialize(build_index(references, chunk_size, features=features, method=method)
                      .where(F.col("n_words") > 0).select(*cols))
    sub = materialize(build_index(submissions, chunk_size, stride=stride, features=features, method=method)
                      .where((F.col("n_words") > 0) & (F.col("hash") != 0)).select(*cols))
    queries = sub.select(F.col("hash").alias("qhash")).distinct().withColumn("query_id", F.col("qhash").cast("string"))
    pairs = hash_pairs(ref, queries, k, strategy=strategy)
    best = materialize(pairs.groupBy("qhash").agg(F.min("distance").alias("__best")))
    kept = join_small(pairs, best, "qhash") \
        .where((F.col("distance") == 0) | (F.col("__best") > 0)).select("qhash", "hash", "distance")
    # chunks that match nothing aren't moved
    matched = materialize(best.select("qhash"))
    sub = join_small(sub.withColumnRenamed("hash", "qhash"), matched, "qhash", "left_semi")
    return ref, sub, materialize(kept)


def plagiarism_passages(references: DataFrame, submissions: DataFrame, *,
                        chunk_size: int = DEFAULT_PLAGIARISM_CHUNK, stride: int | None = None,
                        k: int = DEFAULT_MAX_DISTANCE, max_gap: int | None = None, features: str = "word",
                        method: str = "arrow", strategy: str = "auto") -> DataFrame:
    """U3, the passages: ``(doc_id, ref_id, doc_from, doc_to, ref_from, ref_to, chunks, mean_distance)``.

    A chunk of a submission that matches one of a reference lies on a diagonal (its offset less the
    other's).  Matches of one diagonal are chained in the order of their offsets while the bytes between the
    end of one and the next are at most ``max_gap`` (a chunk by default); a chain is a passage, whose ends
    are those of its first and last chunk on either side.  Passages of one (submission, reference,
    diagonal) are cut by a window over just these rows.
    """
    gap = chunk_size if max_gap is None else max_gap
    ref, sub, kept = _chunk_matches(references, submissions, chunk_size, stride, k, features, method, strategy)
    to_ref = join_small(ref.select(F.col("doc_id").alias("ref_id"), F.col("offset").alias("ref_offset"),
                                   F.col("size").alias("ref_size"), "hash"), kept, "hash")
    hits = materialize(join_small(sub, materialize(to_ref), "qhash")
                       .withColumn("diagonal", F.col("offset") - F.col("ref_offset")))
    line = Window.partitionBy("doc_id", "ref_id", "diagonal").orderBy("offset")
    before = F.max(F.col("offset") + F.col("size")).over(line.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("offset") > before + gap), 1).otherwise(0)
    chained = hits.withColumn("new", new).withColumn("chain", F.sum("new").over(line))
    return (chained.groupBy("doc_id", "ref_id", "diagonal", "chain")
            .agg(F.min("offset").alias("doc_from"), F.max(F.col("offset") + F.col("size")).alias("doc_to"),
                 F.min("ref_offset").alias("ref_from"), F.max(F.col("ref_offset") + F.col("ref_size")).alias("ref_to"),
                 F.count("*").cast("bigint").alias("chunks"), F.round(F.avg("distance"), 6).alias("mean_distance"))
            .select("doc_id", "ref_id", "doc_from", "doc_to", "ref_from", "ref_to", "chunks", "mean_distance"))
