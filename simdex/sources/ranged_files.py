"""Raw files in byte ranges (S1 of any size, R1 for files).

Files are listed by Spark's own file source (its names, hidden-file rules, globs and
recursion), without reading them.  A file becomes one row per range of
``range_bytes`` (a multiple of the stride), ranges are spread over the tasks, and each
task seeks to its ranges and emits the chunks that start in them as Arrow batches.
Content of hits is fetched the same way: open, seek, read.

Tasks open files through ``pyarrow.fs``, so local, HDFS and object-store paths work.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.validate import validate_chunk_size

DEFAULT_RANGE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
SCHEMA = "path string, chunk_size int, chunk_idx int, offset bigint, size int, chunk binary"

try:  # ship the code with the tasks (workers need not have the package)
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


@contextmanager
def open_file(path: str):
    """A random-access file for a path as Spark's file source names it."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs
    if path.startswith("file:"):
        with fs.LocalFileSystem().open_input_file(unquote(urlparse(path).path)) as f:
            yield f
    else:
        filesystem, p = fs.FileSystem.from_uri(path)
        with filesystem.open_input_file(p) as f:
            yield f


def list_files(spark: SparkSession, path: str, *, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """``(path, length)`` of the files, as Spark's file source lists them."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "length")


def read_file_chunks(spark: SparkSession, path: str, chunk_size: int, *,
                     stride: int | None = None, glob: str | None = None, recursive: bool = False,
                     range_bytes: int = DEFAULT_RANGE_BYTES) -> DataFrame:
    """``(doc_id, path, chunk_size, chunk_idx, offset, size, chunk)`` of every file under ``path``;
    ``doc_id`` is the 64-bit xxhash of the path."""
    step = validate_chunk_size(chunk_size if stride is None else stride)
    validate_chunk_size(chunk_size)
    span = max(step, range_bytes - range_bytes % step)
    files = list_files(spark, path, glob=glob, recursive=recursive).where("length > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(span).cast("bigint"))
    ranges = files.select("path", "length", F.explode(starts).alias("start")).repartition("path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for name, length, start in zip(*(c.to_pylist() for c in b.columns)):
                    end = min(length, start + span)
                    with open_file(name) as f:
                        for at in range(start, end, max(step, BATCH_BYTES // step * step)):
                            upto = min(end, at + max(step, BATCH_BYTES // step * step))
                            f.seek(at)
                            data = f.read(min(length, upto - 1 + chunk_size) - at)
                            offs = list(range(at, upto, step))
                            pieces = [data[o - at:o - at + chunk_size] for o in offs]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([name] * len(offs), pa.string()), pa.array([chunk_size] * len(offs), pa.int32()),
                                 pa.array([o // step for o in offs], pa.int32()), pa.array(offs, pa.int64()),
                                 pa.array([len(p) for p in pieces], pa.int32()), pa.array(pieces, pa.binary())],
                                ["path", "chunk_size", "chunk_idx", "offset", "size", "chunk"])
        yield from rows()
    df = ranges.mapInArrow(read, SCHEMA)
    return df.select(F.xxhash64("path").alias("doc_id"), *df.columns)


def file_content(matches: DataFrame) -> DataFrame:
    """R1 for files: ``matches`` (with ``path``, ``offset``, ``size``) plus their bytes as ``content``, read from
    the files by range."""
    cols = matches.columns
    at = [cols.index(c) for c in ("path", "offset", "size")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = list(zip(*(b.column(i).to_pylist() for i in at)))
            got: list[bytes] = [b""] * len(want)
            of: dict[str, list[int]] = {}
            for i, w in enumerate(want):
                of.setdefault(w[0], []).append(i)
            for name, rows in of.items():
                with open_file(name) as f:
                    for i in rows:
                        f.seek(want[i][1])
                        got[i] = f.read(want[i][2])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], names=[*cols, "content"])
    schema = ", ".join(f"`{c}` {t}" for c, t in matches.dtypes)
    return matches.mapInArrow(fetch, f"{schema}, content binary")
