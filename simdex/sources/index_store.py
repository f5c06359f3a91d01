"""Index sink and source (S3, S4) as Parquet.

An index is a folder of parts (``part=<name>``), each partitioned by ``chunk_size`` so
a reader of one size prunes the rest.  ``write_index`` replaces the whole index (as the
reference overwrites its file) with one part; ``write_part`` adds or overwrites a single
one.  A part counts once its write is complete (``_SUCCESS``).  ``read_index`` fails on
a missing path, on a path without a complete part and on corrupt data; an empty but
complete index reads as 0 rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.validate import default_index_path
from ..session import drop_path
from .band_store import write_bands

INDEX_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("path", T.StringType()),  # of the file, for indexes of raw files
    T.StructField("chunk_idx", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("n_words", T.IntegerType()),
    T.StructField("hash", T.LongType()),
    T.StructField("chunk_size", T.IntegerType()),
])
BASE_PART = "base"


class IndexReadError(RuntimeError):
    pass


def write_part(chunks: DataFrame, path: str, name: str) -> None:
    """Add the part ``name`` to the index at ``path``, or replace it."""
    if "path" not in chunks.columns:
        chunks = chunks.withColumn("path", F.lit(None).cast("string"))
    cols = [f.name for f in INDEX_SCHEMA.fields]
    chunks.select(*cols).write.mode("overwrite").partitionBy("chunk_size").parquet(f"{path}/part={name}")


def write_index(chunks: DataFrame, path: str | None = None, *, input_path: str | None = None,
                bands: bool = False) -> str:
    """S3.  ``path`` defaults to ``<basename of input_path>.idx`` (P5); ``bands`` stores the band
    tables of band_store, too.

    The new index is written beside the old one and takes its place when it is complete, so a job that
    fails leaves the old index as it was."""
    if path is None:
        path = default_index_path(input_path or "")
    spark = chunks.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:8]}"
    write_part(chunks, beside, BASE_PART)
    if bands:
        write_bands(read_index(spark, beside), beside, BASE_PART)
    drop_path(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path
    fs = new(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(new(beside), new(path)):
        raise OSError(f"{beside}: could not take the place of {path}")
    return path


def complete_parts(spark: SparkSession, path: str) -> list[str]:
    """The folders of the parts at ``path`` whose write is complete."""
    if not path:
        raise IndexReadError("no index path given")
    new = spark._jvm.org.apache.hadoop.fs.Path
    root = new(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise IndexReadError(f"{path}: no such index")
    found = [str(s.getPath()) for s in fs.listStatus(root)
             if s.getPath().getName().startswith("part=") and s.isDirectory()]
    parts = [p for p in found if fs.exists(new(new(p), "_SUCCESS"))]
    if not parts:
        raise IndexReadError(f"{path}: not a complete index")
    return parts


def read_index(spark: SparkSession, path: str, chunk_size: int | None = None) -> DataFrame:
    """Every complete part of an index."""
    parts = complete_parts(spark, path)
    df = spark.read.schema(INDEX_SCHEMA).option("basePath", path).parquet(*parts)
    if chunk_size is not None:
        df = df.where(df.chunk_size == chunk_size)
    return df
