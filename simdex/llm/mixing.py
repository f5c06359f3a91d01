r"""Mixing sources to target weights (operator 5).

Method: a low-discrepancy schedule.  Slot ``t`` of the mix takes the point
``frac((t + 0.5) / golden ratio)`` through the cumulative target shares to its
source; the slots of a source are ranked, and rank ``r`` is joined to block
``r mod n_blocks`` of that source, an equal share of ``BLOCK_WORDS`` words of its
documents in shuffled (md5) order.  A source whose blocks are used up starts
again.  The last slot of a source is cut at its target, surplus slots take
nothing, and a source the points served a few slots short gets them at the end,
so a source's words equal its target but for the fraction of a word.

Positions and ranks are running sums in two levels (range sums, then inside a
range), so no source, however large, is one task's.  Sums over *sources* use one
small table with a row for each source.

Sizes are the numbers of ``[^\x20\x09-\x0D]+``; sources weigh 1, 2, 3, repeating,
by code point with null last; a target stops at ``MAX_EPOCHS`` times its source's
size and the excess is shared again by weight.

Defined results: a null or empty text has size 0 and is never taken (the row is
there with taken 0); a null source is a source of its own; rows that repeat are
each placed; equal rows are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.sizing import stored
from .common import small_batches

BLOCK_WORDS = 256
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
CELLS = 1024              # cells of the unit interval by which points find their source
RANGE_DIGITS = 3          # hex digits of the shuffle key that make a range (4096)
SLOT_RANGE = 4096
INV_GOLDEN = 0.6180339887498949


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source, size)`` -> one row a source: ``(sno, source, source_size, target)``.

    Sorted by the level at which a source is full, ``level`` is what all from here on would
    get per weight if those before are full; it is the final one at the first not full."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    src = src.withColumn("sno", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("sno") % len(WEIGHTS) + 1))
    full = F.col("source_size") * MAX_EPOCHS
    src = src.withColumn("ratio", full / F.col("weight"))
    before = W.orderBy("ratio", "sno").rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    src = src.withColumn("level", (F.sum("source_size").over(everything)
                                   - F.coalesce(F.sum(full).over(before), F.lit(0)))
                         / (F.sum("weight").over(everything)
                            - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    # rounding can leave no source under its ratio; then all are full
    target = F.least(full.cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return src.withColumn("target", target).select("sno", "source", "source_size", "target")


def _quota(src: DataFrame) -> DataFrame:
    """Adds whole words to take, blocks a pass, and slots needed."""
    whole, size = F.floor("target"), F.col("source_size")
    blocks = F.ceil(size / BLOCK_WORDS)
    rest = whole - F.floor(whole / size) * size
    need = F.when(size > 0, F.floor(whole / size) * blocks + F.ceil(rest / BLOCK_WORDS)).otherwise(0)
    return src.select("*", whole.cast("bigint").alias("whole"), blocks.cast("bigint").alias("blocks"),
                      need.cast("bigint").alias("need"))


def schedule(src: DataFrame) -> DataFrame:
    """``(slot, sno, rank, block, take)``: the blocks in the order of the mix, each with how many
    of its first words are taken.  ``src`` as from source_targets."""
    spark = src.sparkSession
    src = _quota(src)
    n_slots = int(src.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0])
    share = F.col("need") / F.lit(max(1, n_slots))
    hi = F.sum(share).over(W.orderBy("sno"))
    cells = (src.where("need > 0").withColumn("hi", hi).withColumn("lo", F.col("hi") - share)
             .withColumn("cell", F.explode(F.sequence(
                 F.floor(F.col("lo") * CELLS), F.floor(F.col("hi") * CELLS)))))
    t = F.col("slot")
    points = spark.range(n_slots).select(F.col("id").alias("slot")) \
        .withColumn("u", F.pmod((t + 0.5) * INV_GOLDEN, F.lit(1.0))) \
        .withColumn("cell", F.floor(F.col("u") * CELLS))
    hit = (points.join(cells, "cell").where("u >= lo and u < hi")
           .select("slot", "sno", F.floor(t / SLOT_RANGE).alias("part")))
    counts = hit.groupBy("sno", "part").agg(F.count("*").alias("n"))
    base = counts.select("sno", "part", (F.sum("n").over(W.partitionBy("sno").orderBy("part"))
                                         - F.col("n")).alias("base"))
    rank = F.row_number().over(W.partitionBy("sno", "part").orderBy("slot")) - 1
    ranked = (hit.withColumn("inner", rank).join(base, ["sno", "part"])
              .select("slot", "sno", (F.col("base") + F.col("inner")).alias("rank")))
    have = counts.groupBy("sno").agg(F.sum("n").alias("have"))
    short = (src.join(have, "sno", "left").withColumn("have", F.coalesce("have", F.lit(0)))
             .where("have < need")
             .withColumn("rank", F.explode(F.sequence(F.col("have"), F.col("need") - 1)))
             .select((F.lit(n_slots) + F.col("rank")).alias("slot"), "sno", "rank"))
    slots = ranked.unionByName(short).join(src, "sno").where("rank < need")
    block = F.col("rank") % F.col("blocks")
    start = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + block * BLOCK_WORDS
    length = F.least(F.lit(BLOCK_WORDS), F.col("source_size") - block * BLOCK_WORDS)
    return slots.select("slot", "sno", "rank", block.alias("block"),
                        F.least(length, F.col("whole") - start).alias("take"))


def positions(docs: DataFrame, src: DataFrame) -> DataFrame:
    """``docs(doc_id, source, size)`` -> ``(doc_id, size, sno, at)``: the place of each document's
    first word in the shuffled words of its source."""
    d = docs.join(src.select("sno", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))) \
        .withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))) \
        .withColumn("part", F.substring("key", 1, RANGE_DIGITS)) \
        .select("doc_id", "size", "sno", "key", "part")
    sums = d.groupBy("sno", "part").agg(F.sum("size").alias("n"))
    base = sums.select("sno", "part", (F.sum("n").over(W.partitionBy("sno").orderBy("part"))
                                       - F.col("n")).alias("base"))
    inner = (F.sum("size").over(W.partitionBy("sno", "part").orderBy("key", "doc_id", "size")
                                .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size"))
    return (d.withColumn("inner", inner).join(base, ["sno", "part"])
            .select("doc_id", "size", "sno", (F.col("base") + F.col("inner")).alias("at")))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, size, source, source_size, target, taken)``, one row a document."""
    d = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                           n_words(F.col(text).cast("string")).alias("size")), "mix-sizes")
    src = stored(source_targets(d), "mix-sources")
    placed = stored(positions(d, src), "mix-positions")
    last = F.col("at") + F.col("size") - 1
    pieces = (placed.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / BLOCK_WORDS),
                                                        F.floor(last / BLOCK_WORDS))))
              .withColumn("lo", F.greatest(F.col("at") - F.col("block") * BLOCK_WORDS, F.lit(0)))
              .withColumn("hi", F.least(last + 1 - F.col("block") * BLOCK_WORDS, F.lit(BLOCK_WORDS))))
    slots = schedule(src).select("sno", "block", "take")
    part = F.greatest(F.least("hi", F.coalesce("take", F.lit(0))) - F.col("lo"), F.lit(0))
    taken = (pieces.join(slots, ["sno", "block"], "left")
             .groupBy("sno", "at", "doc_id", "size").agg(F.sum(part).alias("taken")))
    empty = placed.where("size <= 0").select("sno", "at", "doc_id", "size", F.lit(0).alias("taken"))
    return (taken.unionByName(empty).join(src, "sno")
            .select("doc_id", F.col("size").cast("bigint").alias("size"), "source",
                    F.col("source_size").cast("bigint").alias("source_size"), "target",
                    F.col("taken").cast("bigint").alias("taken")))


def _first_words(text: str, n: int) -> str:
    end = 0
    for k, m in enumerate(re.finditer(r"[^\x20\x09-\x0D]+", text)):
        if k == n:
            break
        end = m.end()
    return text[:end]


def apply_mix(docs: DataFrame, mixed: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
              n_chars: str = "n_chars") -> DataFrame:
    """The mix's rows, in the columns of ``docs``: a document once for each pass that takes all of
    it, and its first words where a pass ends inside it.  Rows of one doc_id and size are paired
    one to one; a text of no words is never taken."""
    cols = docs.columns
    nth = lambda *by: F.row_number().over(W.partitionBy("_id", "_size").orderBy(*by))
    left = docs.withColumn("_id", F.col(doc_id)).withColumn("_size", n_words(F.col(text).cast("string"))) \
        .where("_size > 0").withColumn("_n", nth(F.xxhash64(text)))
    right = mixed.where("taken > 0").select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"),
                                            F.col("taken").alias("_taken")).withColumn("_n", nth("_taken")) \
        .select(F.col("_id").alias("_id2"), F.col("_size").alias("_size2"), F.col("_n").alias("_n2"), "_taken")
    rows = left.join(right, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_size") == F.col("_size2"))
                     & (F.col("_n") == F.col("_n2")))
    passes = rows.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size"))))) \
        .withColumn("_words", F.least(F.col("_size"), F.col("_taken") - (F.col("_pass") - 1) * F.col("_size")))
    at, words_at, size_at = cols.index(text), len(cols), len(cols) + 1
    chars_at = cols.index(n_chars) if n_chars in cols else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = list(b.columns[:len(cols)])
            words, size = b.column(words_at).to_pylist(), b.column(size_at).to_pylist()
            if any(w < s for w, s in zip(words, size)):
                texts = [t if w >= s else _first_words(t, w)
                         for t, w, s in zip(out[at].to_pylist(), words, size)]
                out[at] = pa.array(texts, pa.string())
                if chars_at is not None:
                    out[chars_at] = pa.array([len(t) for t in texts], out[chars_at].type)
            yield pa.RecordBatch.from_arrays(out, names=cols)
    return small_batches(passes).select(*cols, "_words", "_size").mapInArrow(cut, docs.schema)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s0 AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sno FROM s0),
s2 AS (SELECT *, sno % 3 + 1 AS weight, (source_size * 3)::DOUBLE / (sno % 3 + 1)::DOUBLE AS ratio FROM s1),
s3 AS (SELECT *, ((SUM(source_size) OVER () - COALESCE(SUM(source_size * 3) OVER b, 0))::DOUBLE
                  / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER b, 0))::DOUBLE) AS level
       FROM s2 WINDOW b AS (ORDER BY ratio, sno ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT source, source_size, LEAST((source_size * 3)::DOUBLE,
             COALESCE(MAX(CASE WHEN level <= ratio THEN level END) OVER (), 'inf'::DOUBLE) * weight) AS target FROM s3),
p AS (SELECT d.doc_id, d.size, s.source_size, s.target, FLOOR(s.target)::BIGINT AS whole,
             SUM(d.size) OVER (PARTITION BY d.source ORDER BY md5(COALESCE(CAST(d.doc_id AS VARCHAR), '')),
                               d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS pos
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN size = 0 THEN 0 ELSE (whole // source_size) * size
             + LEAST(GREATEST(whole - (whole // source_size) * source_size - pos, 0), size) END)::BIGINT AS taken
FROM p
"""
