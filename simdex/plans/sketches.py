"""Sketches of an index's content (U5 without a rescan): distinct hashes and frequent hashes.

``write_sketches`` stores, for a part of the index, one row a group: counts, a HyperLogLog sketch of its
distinct hashes and a frequent-items sketch of its largest buckets.  ``sketched_distribution`` merges the
rows of all parts, so the whole costs the sketches' size however large the index is, and an
addition to the index sketches its own rows only.

Bounds: distinct hashes have a standard error of 1.04 / sqrt(2 ** LG_K), 0.8 %; the count of a frequent
hash is at most ``ITEM_ERROR / MAX_ITEMS`` of its group's chunks off (exact while a group
has fewer distinct hashes than the sketch holds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 14
MAX_ITEMS = 10_000
ITEM_ERROR = 3.5
RELATIVE_ERROR = 1.04 / 2 ** (LG_K / 2)


def write_sketches(chunks: DataFrame, path: str, part: str, by: tuple[str, ...] = ("lang", "source")) -> None:
    """Store the sketches of the index rows ``chunks`` as ``<path>/part=<part>`` (replaced if it is there)."""
    (chunks.groupBy(*by).agg(
        F.count("*").alias("n_chunks"), F.sum("size").cast("bigint").alias("n_bytes"),
        F.hll_sketch_agg("hash", F.lit(LG_K)).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(hash, {MAX_ITEMS})").alias("top_sketch"))
     .write.mode("overwrite").parquet(f"{path}/part={part}"))


def sketched_distribution(spark: SparkSession, path: str, n: int = 5, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``(by..., n_chunks, n_bytes, n_distinct_hashes, top)`` over all parts; ``top`` is an array of
    (item, count), the largest first."""
    merged = spark.read.parquet(path).groupBy(*by).agg(
        F.sum("n_chunks").alias("n_chunks"), F.sum("n_bytes").alias("n_bytes"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct_hashes"),
        F.expr(f"approx_top_k_combine(top_sketch, {MAX_ITEMS})").alias("top_sketch"))
    return merged.select(*by, "n_chunks", "n_bytes", "n_distinct_hashes",
                         F.expr(f"approx_top_k_estimate(top_sketch, {n})").alias("top"))
