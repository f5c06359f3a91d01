"""An index that knows where its texts are (R1 without moving texts) and whether they changed.

Documents are rows of Parquet tables; each is known by its file and row number
(``_metadata.file_path``, ``_metadata.row_index``).  Layout, a ``version`` for each addition:

* ``<path>/chunks/version=n``     index rows with ``path`` and ``row`` of their document
* ``<path>/documents/version=n``  ``doc_id, path, row, n_bytes, md5, withdrawn``; written last, a
  version without it doesn't count

The newest version that names a ``doc_id`` holds all there is of it: adding a document again
replaces it, ``withdraw`` takes it out.  ``located_content`` reads the texts of hits only: hits are
ranged over the tasks by file, row and offset (so neither a file nor a document that many queries hit
is one task's work), and a task reads the text column of the row groups it needs, row by row.  The text's
md5 is held against the index; a text that changed gives a ``reason`` and no bytes.

Defined results: null texts are no documents, empty ones have no chunks; rows that repeat a ``doc_id``
within a version all stay; a null ``doc_id`` is an id like any other.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import build_index
from ..operators.sizing import join_small, materialize
from .index_store import IndexReadError
from .ranged_files import open_file

BATCH_BYTES = 4 << 20
READ_ROWS = 256
STALE = "source has changed"
MISSING = "source is missing"
STORES = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")   # fixed values: schemes that pyarrow.fs opens
DOCUMENTS = "doc_id bigint, path string, row bigint, n_bytes bigint, md5 string, withdrawn boolean"
CHUNKS = "doc_id bigint, path string, row bigint, chunk_size int, chunk_idx int, offset bigint, size int, n_words int, hash bigint"

try:  # ship the code with the tasks
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


def located_documents(spark: SparkSession, table: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, path, row, content)`` of a Parquet table's non-null texts."""
    return spark.read.parquet(table).where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"), F.encode(F.col(text_col), "UTF-8").alias("content"))


def _versions(spark: SparkSession, path: str) -> list[int]:
    new = spark._jvm.org.apache.hadoop.fs.Path
    root = new(f"{path}/documents")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [str(s.getPath().getName()) for s in fs.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("version=") and fs.exists(new(f"{path}/documents/{n}/_SUCCESS")))


def add_documents(docs: DataFrame, chunk_size: int, path: str, *, method: str = "arrow") -> int:
    """Add ``located_documents`` to the index at ``path`` as its next version; documents it has already are replaced."""
    spark = docs.sparkSession
    version = max(_versions(spark, path), default=0) + 1
    build_index(docs, chunk_size, keep=("doc_id", "path", "row"), method=method) \
        .write.mode("overwrite").parquet(f"{path}/chunks/version={version}")
    docs.select("doc_id", "path", "row", F.octet_length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("md5"),
                F.lit(False).alias("withdrawn")).write.mode("overwrite").parquet(f"{path}/documents/version={version}")
    return version


def withdraw(ids: DataFrame, path: str) -> int:
    """Take the documents ``ids(doc_id)`` out of the index."""
    version = max(_versions(ids.sparkSession, path), default=0) + 1
    none = F.lit(None)
    ids.select(F.col("doc_id").cast("bigint").alias("doc_id"), none.cast("string").alias("path"), none.cast("bigint").alias("row"),
               none.cast("bigint").alias("n_bytes"), none.cast("string").alias("md5"), F.lit(True).alias("withdrawn")) \
        .write.mode("overwrite").parquet(f"{path}/documents/version={version}")
    return version


def _read(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        raise IndexReadError(f"{path}: no complete version")
    if kind == "chunks":   # withdrawals have none
        new = spark._jvm.org.apache.hadoop.fs.Path
        fs = new(path).getFileSystem(spark._jsc.hadoopConfiguration())
        versions = [v for v in versions if fs.exists(new(f"{path}/chunks/version={v}"))]
    folders = [f"{path}/{kind}/version={v}" for v in versions]
    if not folders:
        return spark.createDataFrame([], f"{schema}, version int")
    return spark.read.schema(f"{schema}, version int").option("basePath", f"{path}/{kind}").parquet(*folders)


def current_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, path, row, n_bytes, md5, version)`` of the documents the index holds now."""
    all_versions = _read(spark, path, "documents", DOCUMENTS)
    if len(_versions(spark, path)) > 1:
        newest = all_versions.groupBy("doc_id").agg(F.max("version").alias("version")).alias("n")
        docs = all_versions.alias("d")
        all_versions = docs.join(newest, F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")) &
                                 (F.col("d.version") == F.col("n.version")), "left_semi")
    return all_versions.where(~F.col("withdrawn")).drop("withdrawn")


def read_located(spark: SparkSession, path: str) -> DataFrame:
    """Index rows (with ``path`` and ``row``) of the documents the index holds now."""
    chunks = _read(spark, path, "chunks", CHUNKS)
    if len(_versions(spark, path)) > 1:
        now = current_documents(spark, path).select("path", "row", "version")
        chunks = chunks.join(now, ["path", "row", "version"], "left_semi")
    return chunks.drop("version")


def with_places(hits: DataFrame, index: DataFrame) -> DataFrame:
    """Hits of a lookup in ``index`` with the ``path`` and ``row`` of each."""
    keys = ["doc_id", "chunk_idx", "offset", "size", "hash"]
    # rows that repeat an id and a chunk give equal hits: one of them meets each of the rows
    once = materialize(hits.distinct())
    rows = index.select(*[F.col(c).alias(f"__{c}") for c in keys], "path", "row")
    same = [F.col(f"__{c}").eqNullSafe(F.col(c)) if c == "doc_id" else F.col(f"__{c}") == F.col(c) for c in keys]
    return join_small(rows, once, reduce(Column.__and__, same)).select(*hits.columns, "path", "row")


def _texts(path: str, rows: list[int], text_col: str) -> Iterator[tuple[int, bytes | None]]:
    """``(row, text)`` of the ascending ``rows`` of a Parquet file; None where there is no text any more."""
    import pyarrow.parquet as pq
    left = iter(rows)
    row = next(left, None)
    try:
        with open_file(path) as f:
            table = pq.ParquetFile(f)
            start = 0
            for g in range(table.num_row_groups):
                end = start + table.metadata.row_group(g).num_rows
                if row is not None and row < end:
                    at = start
                    for batch in table.iter_batches(READ_ROWS, row_groups=[g], columns=[text_col]):
                        while row is not None and row < at + len(batch):
                            value = batch.column(0)[row - at].as_py()
                            yield row, value.encode() if isinstance(value, str) else value
                            row = next(left, None)
                        at += len(batch)
                        if row is None or row >= end:
                            break
                start = end
    except FileNotFoundError:
        pass
    while row is not None:
        yield row, None
        row = next(left, None)


def opened_by_tasks(path: str) -> bool:
    """Whether Python tasks can open files of the path's store (others are reached by Spark's readers only)."""
    return path.split("://")[0].split(":/")[0] in STORES or path.startswith("/")


def joined_content(hits: DataFrame, documents: DataFrame, source: DataFrame) -> DataFrame:
    """``located_content`` for stores that only Spark's readers reach: ``source`` (``located_documents`` of the
    table) is joined by file and row; its text moves if the hits are too many for a broadcast."""
    hits = materialize(hits)
    digests = join_small(documents.select("path", "row", "md5"), hits, ["path", "row"])
    found = join_small(source.select("path", "row", F.col("content").alias("__src")), digests, ["path", "row"])
    same = F.md5("__src") == F.col("md5")
    content = F.substring("__src", (F.col("offset") + 1).cast("int"), F.col("size"))
    there = materialize(found.select(*hits.columns, F.when(same, content).alias("content"),
                                     F.when(~same, F.lit(STALE)).alias("reason")))
    gone = hits.join(there.select("path", "row").distinct(), ["path", "row"], "left_anti")
    return there.unionByName(gone.select(*hits.columns, F.lit(None).cast("binary").alias("content"), F.lit(MISSING).alias("reason")))


def located_content(hits: DataFrame, documents: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``hits`` (of ``with_places``) with ``content`` BINARY and ``reason``, read from their row groups.

    ``documents`` are the index's ``current_documents``.  ``reason`` is null where the text is as it was indexed;
    ``content`` is null otherwise.  The files' store must be one that ``opened_by_tasks``."""
    known = documents.select("path", "row", F.col("md5").alias("__md5"))
    cols = hits.columns
    # hits are the small side in general, the documents' table holds no text
    joined = join_small(known, hits, ["path", "row"]).select(*cols, "__md5")
    spread = joined.repartitionByRange("path", "row", "offset", *[c for c in ("query_id",) if c in cols]) \
        .sortWithinPartitions("path", "row")
    names = spread.columns
    at = [names.index(c) for c in ("path", "row", "offset", "size", "__md5")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = list(zip(*(b.column(i).to_pylist() for i in at)))
            done, content, reason, held = 0, [], [], 0
            i = 0
            while i < len(want):
                path, j = want[i][0], i
                while j < len(want) and want[j][0] == path:
                    j += 1
                for row, raw in _texts(path, list(dict.fromkeys(w[1] for w in want[i:j])), text_col):
                    seen = None if raw is None else hashlib.md5(raw).hexdigest()
                    while i < j and want[i][1] == row:
                        why = MISSING if raw is None else STALE if seen != want[i][4] else None
                        content.append(raw[want[i][2]:want[i][2] + want[i][3]] if why is None else None)
                        reason.append(why)
                        held += want[i][3]
                        i += 1
                        if held >= BATCH_BYTES:
                            yield _with(b.slice(done, i - done), content, reason)
                            done, content, reason, held = i, [], [], 0
            yield _with(b.slice(done), content, reason)
    schema = ", ".join(f"`{c}` {t}" for c, t in hits.dtypes)
    return spread.mapInArrow(fetch, f"{schema}, content binary, reason string")


def _with(rows: pa.RecordBatch, content: list, reason: list) -> pa.RecordBatch:
    names = [n for n in rows.schema.names if n != "__md5"]
    return pa.RecordBatch.from_arrays([*[rows.column(n) for n in names], pa.array(content, pa.binary()), pa.array(reason, pa.string())],
                                      names=[*names, "content", "reason"])
