"""A bucketed index (S3): equal hashes lie together, so joins on the hash don't move the index.

The table is bucketed and sorted by ``(hash, salt)``.  ``salt`` is 0 but for hot hashes, those of
more than ``HOT_ROWS`` chunks (the wordless hash, boilerplate): their rows are spread
over ``rows / HOT_ROWS`` salts and so over as many buckets, and whoever joins by hash asks for each
salt of a hot hash.  The hot hashes are a small table beside the index (fewer than
rows / ``HOT_ROWS``), joined by size like any other.

Layout: ``<path>/chunks`` (the buckets), ``<path>/hot`` (hash, salts), ``<path>/about`` (number of
buckets, written last: an index without it is incomplete).  ``read_bucketed`` opens a
folder in any session; Spark's catalogue is used for the bucket layout only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import valid_queries
from ..operators.sizing import join_small
from .index_store import IndexReadError

HOT_ROWS = 100_000
COLUMNS = "doc_id bigint, chunk_size int, chunk_idx int, offset bigint, size int, n_words int, hash bigint, salt int"
_HOT = "_simdex_hot"


def write_bucketed(chunks: DataFrame, path: str, n_buckets: int, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Write the index rows ``chunks`` to ``path`` (which must not exist) and open them."""
    spark = chunks.sparkSession
    counts = chunks.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    counts.select("hash", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts")).write.parquet(f"{path}/hot")
    hot = spark.read.parquet(f"{path}/hot")
    salted = join_small(chunks, hot, "hash", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "chunk_idx"), F.col("salts")), F.lit(0)).cast("int"))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    name = _table_name(path)
    # the exchange has the buckets' own layout: one file a bucket
    (salted.select(*names).repartition(n_buckets, "hash", "salt").write.format("parquet")
     .bucketBy(n_buckets, "hash", "salt").sortBy("hash", "salt").option("path", f"{path}/chunks").saveAsTable(name))
    spark.createDataFrame([(n_buckets,)], "n_buckets int").coalesce(1).write.parquet(f"{path}/about")
    return read_bucketed(spark, path)


def _table_name(path: str) -> str:
    return "simdex_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The index at ``path`` as a bucketed table."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    fs = new(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(new(f"{path}/about", "_SUCCESS")):
        raise IndexReadError(f"{path}: not a complete bucketed index")
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        n = spark.read.parquet(f"{path}/about").first()["n_buckets"]
        where = f"{path}/chunks".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({COLUMNS}) USING parquet CLUSTERED BY (hash, salt) SORTED BY (hash, salt) "
                  f"INTO {n} BUCKETS LOCATION '{where}'")
    out = spark.table(name)
    setattr(out, _HOT, spark.read.parquet(f"{path}/hot"))
    return out


def with_salts(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with a ``hash``, once for each salt of it."""
    known = join_small(rows, hot, "hash", "left")
    upto = F.coalesce(F.col("salts"), F.lit(1)) - 1
    return known.select(*rows.columns, F.explode(F.sequence(F.lit(0), upto)).alias("salt"))


def lookup_bucketed(index: DataFrame, queries: DataFrame, *, max_bytes: int | None = None) -> DataFrame:
    """M2 over a bucketed index: the chunks whose hash equals a query's; the index isn't moved."""
    q = valid_queries(queries).select("query_id", F.col("qhash").alias("hash"))
    asked = with_salts(q, getattr(index, _HOT))
    return join_small(index, asked, ["hash", "salt"], max_bytes=max_bytes).select(
        "query_id", "doc_id", "chunk_idx", "offset", "size", "hash", F.lit(0).alias("distance"),
        F.lit("exact").alias("match_type"))
