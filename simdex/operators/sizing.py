"""Size checks that guard every broadcast, and written intermediates.

An intermediate that is read more than once is written to Parquet under the
shared work folder and read back: computed once, columnar (pruning and filters
still reach it), with true size estimates, and safe against lost executors.  A
side is broadcast only if it is such a table and its rows times their width stay
under a limit in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, ensure_checkpoint_dir, work_path

BROADCAST_BYTES_CONF = "simdex.broadcast.maxBytes"
#: A broadcast is on the driver as collected, built and serialised at once, some ten times its estimate, and a
#: query's broadcasts are built side by side.
DEFAULT_BROADCAST_BYTES = 8 << 20
#: Bytes counted for a value of a type that has no fixed width.
VARIABLE_WIDTH = 256

_PATH = "_simdex_path"
_ROWS = "_simdex_rows"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared work folder and read back."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = work_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    setattr(out, _PATH, path)
    return out


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a table that ``stored`` wrote; nothing may read it afterwards."""
    path = getattr(df, _PATH, None)
    if path:
        drop_path(df.sparkSession, path)


def materialize(df: DataFrame) -> DataFrame:
    """``stored`` for intermediates of a query; already stored tables stay as they are."""
    return df if hasattr(df, _PATH) else stored(df)


def n_rows(table: DataFrame) -> int:
    """Rows of a stored table (a plain distributed count), remembered on it."""
    if not hasattr(table, _ROWS):
        setattr(table, _ROWS, table.count())
    return getattr(table, _ROWS)


def row_bytes(df: DataFrame) -> int:
    """An estimate of a row's size from its schema."""
    width = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    return 16 + sum(width.get(t, VARIABLE_WIDTH if t.startswith(("string", "binary", "array", "map", "struct"))
                              else 8) for _, t in df.dtypes)


def broadcast_limit(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(BROADCAST_BYTES_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def is_small(table: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether a stored table may be broadcast."""
    limit = broadcast_limit(table) if max_bytes is None else max_bytes
    return n_rows(table) * row_bytes(table) <= limit


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int | None = None) -> DataFrame:
    """Join, broadcasting ``small`` (stored first if it isn't) only when its size is proven.

    Otherwise a shuffle join is planned and AQE may still switch or split it at run
    time (skewed partitions are split by ``spark.sql.adaptive.skewJoin``).
    """
    small = materialize(small)
    side = F.broadcast(small) if is_small(small, max_bytes) else small
    return big.join(side, on, how)
