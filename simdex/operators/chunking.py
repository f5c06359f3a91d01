"""Fixed-size byte chunking (C1-C3, X3) as a narrow Generate over BINARY content.

Chunk positions are derived from the offset (``offset / chunk_size``) instead of
a counter, so they are deterministic and need no window or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.validate import validate_chunk_size


def chunk_count(content, chunk_size: int) -> Column:
    """Number of chunks of a BINARY value without exploding it."""
    validate_chunk_size(chunk_size)
    c = F.col(content) if isinstance(content, str) else content
    return F.ceil(F.octet_length(c) / F.lit(chunk_size)).cast("int")


def chunk_fixed(df: DataFrame, chunk_size: int, *, content_col: str = "content",
                stride: int | None = None, keep: tuple[str, ...] = ("doc_id",),
                keep_content: bool = False) -> DataFrame:
    """C1 + C3: one row per chunk ``(keep..., chunk_size, chunk_idx, offset, size, chunk)``.

    ``stride`` (X3) defaults to ``chunk_size``; a smaller stride gives overlapping chunks.
    Empty content gives no chunks; the last chunk may be short; words and UTF-8
    characters may be cut.
    """
    validate_chunk_size(chunk_size)
    step = stride or chunk_size
    validate_chunk_size(step)
    n = F.octet_length(F.col(content_col))
    offsets = F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"),
                         F.lit(step).cast("bigint"))
    cols = [F.col(k) for k in keep]
    if keep_content:
        cols.append(F.col(content_col))
    out = (df.where(n > 0)
           .select(*cols, F.col(content_col).alias("__content"),
                   F.explode(offsets).alias("offset")))
    chunk = F.substring(F.col("__content"), (F.col("offset") + 1).cast("int"),
                        F.lit(chunk_size))
    return (out.select(*[F.col(k) for k in keep],
                       *([F.col(content_col)] if keep_content else []),
                       F.lit(chunk_size).alias("chunk_size"),
                       (F.col("offset") / F.lit(step)).cast("int").alias("chunk_idx"),
                       F.col("offset"),
                       F.octet_length(chunk).alias("size"),
                       chunk.alias("chunk")))
