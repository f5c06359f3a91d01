"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1024
BATCH_BYTES = "8m"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches that Python workers get, whatever the length of the texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, end to end, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type)
                              or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space in the sense of the contracts: x20, x09 to x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def concat_ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each range, end to end."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) - np.repeat(ends - lens, lens) + np.repeat(starts, lens)


def sample_texts(docs: DataFrame, text: str, n: int) -> list[str]:
    """At most ``n`` distinct whole texts, those of the smallest hashes (for fitting only).

    The hashes are chosen first, so only the chosen texts leave the executors."""
    t = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text")) \
        .withColumn("h", F.xxhash64("text"))
    cut = t.select("h").distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if cut is None:
        return []
    rows = t.where(F.col("h") <= cut).dropDuplicates(["h"]).orderBy("h").collect()
    return [r["text"] for r in rows]
