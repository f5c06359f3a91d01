"""Index building (I1) and index views.

An index is a flat chunk table
``doc_id, chunk_size, chunk_idx, offset, size, n_words, hash``; the reference's
hash -> positions map is not stored, an equi-join on ``hash`` does its work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.simhash import DEFAULT_WORD_PATTERN, with_simhash
from .chunking import chunk_fixed

INDEX_COLUMNS = ("doc_id", "chunk_size", "chunk_idx", "offset", "size", "n_words", "hash")


def build_index(docs: DataFrame, chunk_size: int, *, stride: int | None = None,
                features: str = "word", shingle_n: int = 3,
                word_pattern: str = DEFAULT_WORD_PATTERN, token_hash: str = "md5",
                method: str = "arrow", keep: tuple[str, ...] = ("doc_id",),
                keep_chunk: bool = False) -> DataFrame:
    """Chunk -> words -> SimHash in one narrow stage (no shuffle)."""
    chunks = chunk_fixed(docs, chunk_size, stride=stride, keep=keep)
    out = with_simhash(chunks, "chunk", features=features, shingle_n=shingle_n,
                       word_pattern=word_pattern, token_hash=token_hash, method=method)
    cols = list(keep) + [c for c in INDEX_COLUMNS if c not in keep]
    if keep_chunk:
        cols.append("chunk")
    return out.select(*cols)


def index_chunks(chunks: DataFrame, *, features: str = "word", shingle_n: int = 3,
                 word_pattern: str = DEFAULT_WORD_PATTERN, token_hash: str = "md5",
                 method: str = "arrow", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """I1 for input that is already chunked (e.g. ``read_file_chunks``)."""
    out = with_simhash(chunks, "chunk", features=features, shingle_n=shingle_n,
                       word_pattern=word_pattern, token_hash=token_hash, method=method)
    keep = (*keep, "path") if "path" in chunks.columns and "path" not in keep else keep
    return out.select(*keep, *[c for c in INDEX_COLUMNS if c not in keep])


BUCKET_BLOCK = 4096


def hash_buckets(chunks: DataFrame, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Positions per (file, hash), as the reference's ``HashToChunks``, in blocks.

    A row holds the positions of one ``block`` of ``BUCKET_BLOCK`` chunk numbers, so no list grows
    with the file.  A corpus-wide view (``by=()``) has ``n_chunks`` only (no list).
    """
    count = F.count("*").cast("bigint").alias("n_chunks")
    if not by:
        return chunks.groupBy("hash").agg(count)
    block = F.floor(F.col("chunk_idx") / BUCKET_BLOCK).cast("int").alias("block")
    return chunks.groupBy(*by, "hash", block).agg(
        F.sort_array(F.collect_list("chunk_idx")).alias("chunk_idxs"), count)


def index_summary(chunks: DataFrame, by: tuple[str, ...] = ("doc_id", "chunk_size")) -> DataFrame:
    """Chunks, bytes and distinct hashes per index."""
    return chunks.groupBy(*by).agg(
        F.count("*").cast("bigint").alias("n_chunks"),
        F.sum("size").cast("bigint").alias("n_bytes"),
        F.countDistinct("hash").cast("bigint").alias("n_distinct_hashes"))
