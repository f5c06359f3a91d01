"""Stored band tables of an index (M2, M3): fuzzy lookups that read the matching parts only.

Besides its chunk rows an index may hold its distinct hashes once per band: the 64 bits are cut
into ``BANDS`` bands, and a band's table is sorted by the band's value and partitioned by the value's
first ``PREFIX_BITS`` bits (``bands/part=<name>/band=<j>/prefix=<p>``).  Two hashes within distance k
differ by at most the band's radius in some band (radii add up to k + 1 - bands), so a query asks
for the values within that radius; the join is on (band, prefix, value), and the scan is of the
partitions that the queries' values name and no other.  Distance 0 takes one band, one value: a
single partition a query.

Parts are written like the index's own (a part counts when it is complete), so appends add parts.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hexcodec import hamming
from ..operators.hamming_join import MAX_PROBES, band_masks, layout
from ..operators.sizing import is_small, materialize

BANDS = 4
PREFIX_BITS = 4
BAND_SCHEMA = "hash bigint, value bigint, part string, band int, prefix int"


def _values(h, start: int, width: int):
    return F.shiftrightunsigned(h, start).bitwiseAND(F.lit((1 << width) - 1))


def write_bands(chunks: DataFrame, path: str, name: str = "base") -> None:
    """Add the band tables of ``chunks`` to the index at ``path`` as part ``name``, or replace that part."""
    bands = layout(BANDS, 0)
    rows = [F.struct(F.lit(j).alias("band"), _values(F.col("hash"), start, width).alias("value"),
                     F.shiftrightunsigned(_values(F.col("hash"), start, width), width - PREFIX_BITS).cast("int").alias("prefix"))
            for j, (start, width, _) in enumerate(bands)]
    table = chunks.select("hash").distinct().select("hash", F.explode(F.array(*rows)).alias("b")) \
        .select("hash", "b.value", "b.band", "b.prefix")
    (table.repartitionByRange("band", "prefix", "value").sortWithinPartitions("band", "prefix", "value")
     .write.mode("overwrite").partitionBy("band", "prefix").parquet(f"{path}/bands/part={name}"))


def read_bands(spark: SparkSession, path: str) -> DataFrame:
    """The band tables of every complete part: ``(hash, value, part, band, prefix)``."""
    from .index_store import complete_parts
    parts = complete_parts(spark, f"{path}/bands")
    return spark.read.schema(BAND_SCHEMA).option("basePath", f"{path}/bands").parquet(*parts)


def band_pairs(bands: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Distinct ``(qhash, hash, distance)`` within k, from stored band tables."""
    q = queries.select("qhash").distinct()
    if k == 0:
        cut = [(*layout(BANDS, 0)[0][:2], 0)]     # equal hashes agree in every band: one is enough
    else:
        radius = [(k + 1) // BANDS + (j < (k + 1) % BANDS) - 1 for j in range(BANDS)]
        cut = [(start, width, r) for (start, width, _), r in zip(layout(BANDS, 0), radius)]
    if sum(len(band_masks(width, r)) for _, width, r in cut) > MAX_PROBES:
        raise ValueError(f"distance {k} asks for too many values of {BANDS} bands; look up without band tables")

    def asked(j: int, start: int, width: int, r: int):
        value = _values(F.col("qhash"), start, width)
        masks = F.array(*map(F.lit, band_masks(width, r))).cast("array<bigint>")
        return F.transform(masks, lambda m: F.struct(
            F.lit(j).alias("band"), value.bitwiseXOR(m).alias("value"),
            F.shiftrightunsigned(value.bitwiseXOR(m), width - PREFIX_BITS).cast("int").alias("prefix")))
    lists = [asked(j, *c) for j, c in enumerate(cut) if c[2] >= 0]
    probes = materialize(q.select("qhash", F.explode(F.flatten(F.array(*lists))).alias("p"))
                         .select("qhash", "p.band", "p.value", "p.prefix"))
    # the partitions that the values name: at most BANDS << PREFIX_BITS of them, whatever the queries
    named: dict[int, list[int]] = {}
    for r in probes.select("band", "prefix").distinct().collect():
        named.setdefault(r["band"], []).append(r["prefix"])
    here = [(F.col("band") == j) & F.col("prefix").isin(sorted(p)) for j, p in sorted(named.items())]
    side = F.broadcast(probes) if is_small(probes) else probes
    joined = bands.where(reduce(or_, here, F.lit(False))).join(side, ["band", "prefix", "value"])
    dist = hamming("hash", "qhash")
    return joined.where(dist <= k).select("qhash", "hash", dist.alias("distance")).distinct()
