"""Raw files as a Spark data source (S1): ``spark.read.format("file_chunks")``.

    register(spark)
    spark.read.format("file_chunks").option("chunk_size", 512).load("/data/raw")

A file is read in byte ranges, so a large file is read by many tasks and a task holds ``BATCH_BYTES`` at a
time.  A partition of the scan is one range, or neighbouring ranges (of small files, say) where there are more than
``MAX_PARTITIONS``: tasks don't grow with the number of files.  Columns are pruned by the schema given
to the reader (``.schema("path string, offset bigint")``, or ``read_chunks(columns=...)``):
without ``chunk`` no file is opened, positions and sizes follow from the lengths.

Options: ``chunk_size`` (needed), ``stride`` (default: the chunk size), ``recursive``
(default false), ``glob`` (of file names), ``range_bytes`` (of a partition).  With more than
``MAX_RANGES`` ranges these grow, so that what the driver plans stays bounded; the list of
files is the driver's, as for Spark's own file sources.

Defined results: empty files give no rows; files and folders whose names start with ``.`` or
``_`` are left out (as Spark does, but for ``name=value`` folders); a missing path is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.validate import validate_chunk_size
from .ranged_files import BATCH_BYTES, DEFAULT_RANGE_BYTES, SCHEMA, open_file

NAME = "file_chunks"
MAX_RANGES = 100_000
MAX_PARTITIONS = 1_000
TYPES = {"path": pa.string(), "chunk_size": pa.int32(), "chunk_idx": pa.int32(), "offset": pa.int64(),
         "size": pa.int32(), "chunk": pa.binary()}

try:  # ship the code with the tasks
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass


@dataclass
class FileRange(InputPartition):
    path: str
    length: int
    start: int
    end: int


@dataclass
class FileRanges(InputPartition):
    ranges: list[FileRange]


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def found_files(path: str, *, glob: str | None = None, recursive: bool = False) -> list[tuple[str, int]]:
    """``(name as Spark writes it, length)`` of the files at or under ``path``."""
    from pyarrow import fs
    if path.startswith("/") or path.startswith("file:"):
        files, root, prefix = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file:"
    else:
        files, root = fs.FileSystem.from_uri(path)
        at = path.find(root)
        prefix = path[:at] if at > 0 else path.split("://")[0] + "://"
    info = files.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(prefix + info.path, info.size)]
    base = info.path.rstrip("/")
    out = []
    for f in files.get_file_info(fs.FileSelector(root, recursive=recursive)):
        below = f.path[len(base):].strip("/").split("/")
        if f.type == fs.FileType.File and not any(map(_hidden, below)) and (not glob or fnmatchcase(below[-1], glob)):
            out.append((prefix + f.path, f.size))
    return sorted(out)


class FileChunkReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.names
        unknown = [c for c in self.columns if c not in TYPES]
        if unknown:
            raise ValueError(f"{NAME} has no columns {unknown}")
        if "chunk_size" not in options:
            raise ValueError(f"{NAME} needs the option chunk_size")
        self.size = validate_chunk_size(int(options["chunk_size"]))
        self.step = validate_chunk_size(int(options.get("stride", self.size)))
        self.path = options["path"]
        self.glob = options.get("glob")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.range_bytes = int(options.get("range_bytes", DEFAULT_RANGE_BYTES))

    def partitions(self) -> list[FileRange | FileRanges]:
        files = [f for f in found_files(self.path, glob=self.glob, recursive=self.recursive) if f[1]]
        total = sum(n for _, n in files)
        span = max(self.range_bytes, total // MAX_RANGES)
        span = max(self.step, span - span % self.step)
        ranges = [FileRange(name, n, a, min(n, a + span)) for name, n in files for a in range(0, n, span)]
        if len(ranges) <= MAX_PARTITIONS:
            return ranges
        out, room = [], 0
        for r in ranges:
            if room <= 0:
                out.append(FileRanges([]))
                room += -(-total // MAX_PARTITIONS)
            out[-1].ranges.append(r)
            room -= r.end - r.start
        return out

    def read(self, partition: FileRanges | FileRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:             # no file: one task without a range
            return
        for part in partition.ranges if isinstance(partition, FileRanges) else [partition]:
            if "chunk" in self.columns:
                with open_file(part.path) as f:
                    yield from self._batches(part, f)
            else:
                yield from self._batches(part, None)

    def _batches(self, part: FileRange, f) -> Iterator[pa.RecordBatch]:
        size, step, most = self.size, self.step, max(self.step, BATCH_BYTES // self.step * self.step)
        for at in range(part.start, part.end, most):
            upto = min(part.end, at + most)
            offsets = range(at, upto, step)
            columns = {"path": [part.path] * len(offsets), "chunk_size": [size] * len(offsets),
                       "chunk_idx": [o // step for o in offsets], "offset": list(offsets),
                       "size": [min(size, part.length - o) for o in offsets]}
            if f is not None:
                f.seek(at)
                data = f.read(min(part.length, offsets[-1] + size) - at)
                columns["chunk"] = [data[o - at:o - at + size] for o in offsets]
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], TYPES[c]) for c in self.columns], names=self.columns)


class FileChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FileChunkReader:
        return FileChunkReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileChunks)


def read_chunks(spark: SparkSession, path: str, chunk_size: int, *, columns: tuple[str, ...] | None = None,
                **options) -> DataFrame:
    """The chunks of the files at ``path`` with their ``doc_id`` (64-bit xxhash of the path, which is
    always read); ``columns`` names the others to read, all by default."""
    register(spark)
    kinds = dict(c.split() for c in SCHEMA.split(", "))
    wanted = [c for c in kinds if columns is None or c in columns or c == "path"]
    reader = spark.read.format(NAME).schema(", ".join(f"{c} {kinds[c]}" for c in wanted)).option("chunk_size", chunk_size)
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, value)
    df = reader.load(path)
    return df.select(F.xxhash64("path").alias("doc_id"), *df.columns)
