"""Counts looked up by blocks of rows (shared by operators 11 and 12).

A block is what a task works on at a time.  Asking a corpus-wide table for a block's distinct keys
moves each key once a block, however often its rows hold it; so the most frequent key is no more
than one row a block, and no key is a large share of any partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class BlockIds:
    """Numbers for a task's blocks: the same in a task that is run again on the same rows."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 32

    def __call__(self) -> int:
        self.next += 1
        return self.next


def numbered(values) -> tuple[np.ndarray, np.ndarray]:
    """Each value's number among the distinct ones, and these in order of their first place."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)


def look_up(blocks: DataFrame, keys: str, table: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``blocks``, without ``keys``, with ``found``: an array of (at, values...) for the keys that
    ``table`` has.

    ``blocks`` has a column ``block`` (unique) and the array ``keys`` of distinct values; both sides
    of the join are plain shuffles, so one that is too large can be split."""
    asked = blocks.select("block", F.posexplode(keys).alias("at", key))
    found = (asked.join(table.select(key, *values), key)
             .groupBy("block").agg(F.collect_list(F.struct("at", *values)).alias("found")))
    return blocks.drop(keys).join(found, "block", "left")
