"""Document sources (S1, S2): text tables and raw files as ``(doc_id, content BINARY)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session setting: number of partitions to spread a scan over (tables stored as one or a
# few Parquet row groups).  Unset, the scan's own splits are kept and no shuffle is added.
SCAN_PARTITIONS_CONF = "simdex.scan.partitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    if partitions is None:
        conf = spark.conf.get(SCAN_PARTITIONS_CONF, None)
        if conf:
            partitions = int(conf)
    return df.repartition(partitions) if partitions else df


def scan_documents(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   extra: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """A text table -> ``(doc_id, content BINARY, extra...)``; NULL texts are dropped."""
    out = (df.where(F.col(text_col).isNotNull())
           .select(F.col(id_col).cast("bigint").alias("doc_id"),
                   F.encode(F.col(text_col), "UTF-8").alias("content"),
                   *[F.col(c) for c in extra]))
    return _spread(out, partitions)


def load_documents(spark: SparkSession, sf_dir: str, table: str = "documents", *,
                   id_col: str = "doc_id", text_col: str = "text",
                   extra: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    return scan_documents(read_table(spark, sf_dir, table), id_col=id_col, text_col=text_col,
                          extra=extra, partitions=partitions)


def scan_files(spark: SparkSession, path: str, *, glob: str | None = None,
               recursive: bool = False, partitions: int | None = None) -> DataFrame:
    """Raw files -> ``(doc_id, path, content BINARY)``, one row per file.

    ``doc_id`` is the 64-bit xxhash of the path.  For whole-file work on files below 2 GB
    (Spark holds a file in one row); indexes of files of any size are made from
    ``ranged_files.read_file_chunks``, with the same names and ids.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    out = reader.load(path).select(F.xxhash64("path").alias("doc_id"), "path", "content")
    return _spread(out, partitions)
