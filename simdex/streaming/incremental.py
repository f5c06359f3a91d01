"""Incremental indexing (X1) with Structured Streaming.

New document files arriving in a folder are chunked and fingerprinted by the
same row-local plan as the batch index.  Each micro-batch becomes a part of the index
of its own, named after the stream's checkpoint and the batch number and
overwritten as a whole, so a batch that is tried again repeats nothing, earlier parts
stay as they are, and ``read_index`` sees a part once it is complete.  No operator
keeps state, so the stream needs no watermark.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.validate import validate_chunk_size
from ..operators.index import build_index
from ..sources.band_store import write_bands
from ..sources.index_store import INDEX_SCHEMA, write_part


def document_stream(spark: SparkSession, folder: str, schema, *, glob: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (reader.parquet(folder)
            .where(F.col(text_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("doc_id"),
                    F.encode(F.col(text_col), "UTF-8").alias("content")))


def incremental_index(stream: DataFrame, chunk_size: int, index_path: str, checkpoint: str, *,
                      available_now: bool = True, method: str = "arrow", bands: bool = False) -> StreamingQuery:
    """Start the stream: documents -> chunk index rows (and with ``bands`` their band tables) added to the
    index at ``index_path``."""
    validate_chunk_size(chunk_size)
    name = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def add(batch: DataFrame, batch_id: int) -> None:
        part = f"{name}-{batch_id}"
        write_part(build_index(batch, chunk_size, method=method), index_path, part)
        if bands:
            rows = batch.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{index_path}/part={part}")
            write_bands(rows, index_path, part)
    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="10 seconds")
    return writer.start()
