"""Connected components of an edge table (used by U2).

Alternating large-star and small-star steps: every node hangs its larger
neighbours (large-star), then its smaller ones (small-star), on the smallest node
it sees, until the edges are one star per component.  Chains halve with every
round, so the number of rounds grows with the logarithm of a component's size
and needs no cap.

Only nodes that occur in an edge take part; a node of no edge is its own
component and is joined once, at the end.  The edges of each round are written to
Parquet in the shared work folder (short plans, true size estimates, a lost
executor repeats the last round only) and the round before is removed.  A step is
a ``min`` per node (partial aggregation, so a hub is pre-aggregated per map task)
and a join back, which adaptive execution splits where a hub makes it skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import drop_stored, stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over ``edges(u, v)`` with u > v; the same form comes out."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.join(least, "u")
    if larger:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return out.distinct()


def _print(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def star_components(edges: DataFrame, *, src: str = "src", dst: str = "dst") -> tuple[DataFrame, int]:
    """``(node, component)`` of every node that has an edge to another one, and the rounds it took;
    the component is its smallest node."""
    a, b = F.col(src), F.col(dst)
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .distinct(), "edges")
    seen, rounds = _print(now), 0
    while True:
        after = stored(_star(_star(now, True), False), "edges")
        rounds += 1
        found = _print(after)
        drop_stored(now)
        now = after
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))), rounds)


def connected_components(nodes: DataFrame, edges: DataFrame, *, src: str = "src",
                         dst: str = "dst") -> DataFrame:
    """``nodes(node)`` + ``edges(src, dst)`` -> ``(node, component)``; component = min node."""
    found, _ = star_components(edges, src=src, dst=dst)
    return (nodes.select("node").distinct()
            .join(found, "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))
