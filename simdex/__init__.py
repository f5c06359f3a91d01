"""simdex: chunked SimHash fingerprints, Hamming lookups and near-duplicate jobs on Spark.

Subpackages: ``functions`` (column expressions), ``sources`` (readers and the
index store), ``operators`` (chunking, index, joins, lookups, results),
``plans`` (composed jobs) and ``streaming`` (incremental indexing).
"""

__version__ = "0.1.0"
