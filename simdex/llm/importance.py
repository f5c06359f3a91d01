"""Target-distribution importance resampling (operator 13).

Documents are drawn by how much likelier their words are under a target corpus than under the
documents themselves.  Features are the runs of 1 to 3 words of a text; a feature's bucket is the
CRC-32 of its bytes modulo ``BUCKETS``.  A bucket's gain is the floored, scaled log ratio of its
smoothed frequencies; a document's weight is the sum over its features; Gumbel noise from the id's
SHA-256 makes the largest scores a draw without replacement.

Method: length-bucketed CRC matrices.  A batch's words become numbers (dictionary of the words,
then of the pairs, then of the triples), so each distinct feature is hashed once.  Distinct features
of one byte length are rows of a two-dimensional uint8 array, whose columns update all their CRCs
side by side; the buckets are scattered back over the occurrences.

Spark does the rest: counts per task are summed by bucket (``BUCKETS`` rows, whatever the input),
the gains are the only thing sent to tasks, and ranks come from one range partitioning by score,
in which a task numbers its own range; no task sees more than its share.

Defined results: a null or wordless text has no features, weight 0, and isn't drawn; a null
doc_id hashes as ``42:`` and ties after all ids; rows that repeat are rows of their own, ranked
next to each other; long texts are worked in slices; empty tables give no rows (an empty target
gives every bucket the gain of absence); other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import stored
from .common import concat_ranges, small_batches, utf8

BUCKETS = 10_000
RUN = 3                   # words of the longest feature
LEAST_WORDS = 20          # of a document that may be drawn
PERCENT = 5               # of these that are drawn
SLICE_WORDS = 1 << 19     # words whose features are hashed together
MATRIX_BYTES = 1 << 22    # of one CRC matrix
POLYNOMIAL = 0xEDB88320   # fixed value: CRC-32 as in zlib, bits reversed


def crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> np.uint32(1) ^ np.uint32(POLYNOMIAL), c >> np.uint32(1))
    return c


TABLE = crc_table()


def crc_matrix(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range of ``data``: ranges of one length are one matrix, and every column
    of it updates the CRCs of all its rows."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lens, kind="stable")
    cuts = np.append(np.nonzero(np.diff(lens[order], prepend=-1))[0], len(order))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        n = int(lens[order[a]])
        step = max(1, MATRIX_BYTES // max(1, n))
        for lo in range(a, b, step):
            rows = order[lo:min(b, lo + step)]
            matrix = data[starts[rows][None, :] + np.arange(n)[:, None]] if n < 4096 else None
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for j in range(n):
                column = data[starts[rows] + j] if matrix is None else matrix[j]
                crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ crc >> np.uint32(8)
            out[rows] = ~crc
    return out


def words_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(lower, starts, ends, row)``: the bytes with A-Z in lower case and the words in them."""
    upper = (data >= 65) & (data <= 90)
    lower = np.where(upper, data + np.uint8(32), data)
    inside = (lower >= 128) | ((lower >= 48) & (lower <= 57)) | ((lower >= 97) & (lower <= 122))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    borders = offs[:-1][(np.diff(offs) > 0)]
    first[borders] = inside[borders]
    borders = borders[borders > 0] - 1
    last[borders] = inside[borders]
    starts, ends = np.nonzero(first)[0], np.nonzero(last)[0] + 1
    return lower, starts, ends, np.searchsorted(offs, starts, "right") - 1


def _numbers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value among the distinct ones, and where each of these is first."""
    codes = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    n = int(codes.max()) + 1 if len(codes) else 0
    first = np.zeros(n, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, first


def feature_buckets(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, bucket)`` of every feature, slice by slice."""
    lower, starts, ends, row = words_of(data, offs)
    for lo in range(0, len(starts), SLICE_WORDS):
        hi = min(len(starts), lo + SLICE_WORDS)
        far = min(len(starts), hi + RUN - 1)     # words that features of this slice may still need
        s, lens, r = starts[lo:far], ends[lo:far] - starts[lo:far], row[lo:far]
        # the words one space apart, so that a feature is a range of bytes
        place = np.cumsum(lens + 1) - (lens + 1)
        text = np.full(int((lens + 1).sum()), 32, np.uint8)
        text[concat_ranges(place, lens)] = lower[concat_ranges(s, lens)]
        bare = np.cumsum(lens)
        word, first = _numbers(pa.Array.from_buffers(
            pa.large_binary(), len(s), [None, pa.py_buffer(np.append(0, bare).astype(np.int64)),
                                        pa.py_buffer(lower[concat_ranges(s, lens)])]))
        code, n_words = word, max(1, len(first))
        for k in range(1, RUN + 1):
            if k > 1:                            # a run and the word after it make the longer run
                whole = np.nonzero(r[:len(r) - k + 1] == r[k - 1:])[0] if len(r) >= k else np.zeros(0, np.int64)
                key = code[np.searchsorted(at, whole)] * n_words + word[whole + k - 1]
                code, first = _numbers(pa.array(key))
                at = whole
            else:
                at = np.arange(len(s))
            mine = at < hi - lo                  # the next slice has the others
            head = at[first]
            size = place[head + k - 1] + lens[head + k - 1] - place[head]
            bucket = crc_matrix(text, place[head], size) % np.uint32(BUCKETS)
            yield r[at[mine]], bucket[code[mine]].astype(np.int64)


def bucket_counts(table: DataFrame, text: str = "text") -> DataFrame:
    """``(bucket, n)`` over all features of all texts; tasks add up their own counts first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, bucket in feature_buckets(*utf8(batch.column(0))):
                seen += np.bincount(bucket, minlength=BUCKETS)
        has = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(seen[has])], ["bucket", "n"])
    return (small_batches(table).select(F.col(text).cast("string").alias("text"))
            .mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text: str = "text") -> np.ndarray:
    """The gain of every bucket (``BUCKETS`` rows come to the driver)."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for which, table in enumerate((docs, target)):
        for r in bucket_counts(table, text).collect():
            counts[which, r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = counts.astype(float), counts.sum(axis=1).astype(float)
    return np.floor(1000.0 * np.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of every row."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            data, offs = utf8(batch.column(1))
            total = np.zeros((3, batch.num_rows), np.int64)
            for i, (row, bucket) in enumerate(feature_buckets(data, offs)):
                if not len(row):
                    continue
                # rows come in order: sums of whole numbers are differences of running sums
                new = np.nonzero(np.diff(row, prepend=-1))[0]
                n = np.diff(np.append(new, len(row)))
                total[0, row[new]] += n if i % RUN == 0 else 0
                total[1, row[new]] += n
                total[2, row[new]] += np.add.reduceat(gain[bucket], new)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, total)],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return (small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"))


def noise(doc_id: str = "doc_id", seed: int = 42):
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of ``seed:doc_id``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored(doc_id, n_words, score, ...)`` with ``rank`` of the drawn rows (null: undrawn).

    Rows that may be drawn are dealt into ranges of (score, doc_id); a row's rank is its place in its
    range after the sizes of the ranges before (as many numbers as there are partitions)."""
    spark = scored.sparkSession
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    may = F.col("n_words") >= least_words
    # a row's number: its range in the upper bits, its place in the range in the lower 33
    dealt = stored(scored.where(may).repartitionByRange(parts, *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "dealt")
    sizes = sorted((r["part"], r["count"]) for r in
                   dealt.groupBy(F.shiftright("_at", 33).alias("part")).count().collect())
    drawn = percent * sum(n for _, n in sizes) // 100
    before, rows = 0, []
    for part, n in sizes:
        rows.append((part, before))
        before += n
    offsets = spark.createDataFrame(rows, "_part bigint, _before bigint")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = (dealt.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part", "left")
              .withColumn("rank", F.when(place <= drawn, place)).drop("_part", "_before", "_at", "_row"))
    return ranked.unionByName(scored.where(~may).drop("_row").withColumn("rank", F.lit(None).cast("bigint")))


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = 42) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row."""
    scored = weights(docs, gains(docs, target, text), doc_id=doc_id, text=text) \
        .withColumn("score", F.col("weight") + noise(seed=seed))
    return draw(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 by a 256-entry table that SQL makes itself; each distinct feature is hashed once.
ORACLE_SQL = r"""
WITH crc_step AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, [0,0,0,0,0,0,0,0]::BIGINT[]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT list_filter(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
fd AS MATERIALIZED (
  SELECT r, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM d),
fb AS MATERIALIZED (
  SELECT unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM b),
known AS (SELECT DISTINCT f FROM (SELECT f FROM fd UNION ALL SELECT f FROM fb)),
bytes AS (SELECT f, hex(encode(f)) AS x FROM known),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2),
      lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, v: xor(crc_step.t[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) % 10000 AS k
  FROM bytes, crc_step),
s AS (SELECT k, count(*)::DOUBLE AS n FROM fd JOIN hashed USING (f) GROUP BY k),
t AS (SELECT k, count(*)::DOUBLE AS n FROM fb JOIN hashed USING (f) GROUP BY k),
tot AS (SELECT (SELECT count(*)::DOUBLE FROM fd) AS alls, (SELECT count(*)::DOUBLE FROM fb) AS allt),
gain AS (
  SELECT s.k, floor(1000 * ln((coalesce(t.n, 0) + 1) * (alls + 10000) / ((s.n + 1) * (allt + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t USING (k), tot),
weighed AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS weight FROM fd JOIN hashed USING (f) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weighed USING (r)),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS p, count(*) OVER () AS n FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN p <= 5 * n // 100 THEN p END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (r)
"""
