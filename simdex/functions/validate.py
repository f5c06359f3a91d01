"""Driver-side parameter checks (P1, P5) and query validity."""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default chunk size, index file suffix, fuzzy threshold.
DEFAULT_CHUNK_SIZE = 4096
INDEX_SUFFIX = ".idx"
DEFAULT_MAX_DISTANCE = 10


def validate_chunk_size(size) -> int:
    """A chunk size must be a positive integer."""
    if isinstance(size, bool) or not isinstance(size, int) or size <= 0:
        raise ValueError(f"invalid chunk size: {size}. Provide a valid chunk size (e.g.1024)")
    return size


def default_index_path(input_path: str) -> str:
    """P5: no output given -> ``<basename of input>.idx``."""
    if not input_path:
        raise ValueError("error: input file is required")
    return os.path.basename(input_path.rstrip("/")) + INDEX_SUFFIX


def query_reject_reason(qhash) -> Column:
    """NULL when the query hash is usable, else the reason it is rejected.

    Hash 0 means "missing" as in the reference, even though 0 is a possible value.
    """
    q = F.col(qhash) if isinstance(qhash, str) else qhash
    return (F.when(q.isNull(), F.lit("invalid hash"))
            .when(q == 0, F.lit("simhash value is required")))
