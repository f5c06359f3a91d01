"""Content distribution (U5): chunks, bytes, distinct and repeated content per group.

Two aggregations: per (group, hash) then per group (a document is counted at its first chunk).  Both use partial
(map-side) aggregation, so a hash shared by a large part of the corpus (e.g. the
wordless hash -1) is reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def content_distribution(chunks: DataFrame, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``(by..., n_docs, n_chunks, n_bytes, n_distinct_hashes, dup_chunks, dup_share,
    largest_bucket, wordless_chunks)``."""
    buckets = (chunks.groupBy(*by, "hash")
               .agg(F.count("*").alias("cnt"), F.sum("size").alias("bytes"),
                    F.sum(F.when(F.col("chunk_idx") == 0, 1).otherwise(0)).alias("docs"),
                    F.sum(F.when(F.col("n_words") == 0, 1).otherwise(0)).alias("wordless")))
    return (buckets.groupBy(*by)
            .agg(F.sum("docs").cast("bigint").alias("n_docs"),
                 F.sum("cnt").cast("bigint").alias("n_chunks"),
                 F.sum("bytes").cast("bigint").alias("n_bytes"),
                 F.count("*").cast("bigint").alias("n_distinct_hashes"),
                 F.sum(F.when(F.col("cnt") > 1, F.col("cnt")).otherwise(0))
                 .cast("bigint").alias("dup_chunks"),
                 F.max("cnt").cast("bigint").alias("largest_bucket"),
                 F.sum("wordless").cast("bigint").alias("wordless_chunks"))
            .select(*by, "n_docs", "n_chunks", "n_bytes", "n_distinct_hashes", "dup_chunks",
                    F.round(F.col("dup_chunks") / F.col("n_chunks"), 6).alias("dup_share"),
                    "largest_bucket", "wordless_chunks"))


def top_buckets(chunks: DataFrame, n: int = 5, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """The n largest hash buckets per group (ties by hash); a top-k report."""
    buckets = chunks.groupBy(*by, "hash").agg(F.count("*").cast("bigint").alias("n_chunks"))
    w = Window.partitionBy(*by).orderBy(F.col("n_chunks").desc(), F.col("hash"))
    return buckets.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def distance_histogram(pairs: DataFrame) -> DataFrame:
    """Number of hits per Hamming distance."""
    return pairs.groupBy("distance").agg(F.count("*").cast("bigint").alias("n"))
