"""Result shaping (R1-R5, S5, S6): late content fetch, reports, counts, top chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hexcodec import format_hex_hash
from .sizing import join_small

# CLI report texts and the hash log line format.
FOUND_AT = "Query found in chunk at byte offset: %d"
CONTENT_HEADER = "Chunk content:"
SEPARATOR = "---"
FOUND_COUNT = "Query found %d indexed chunk(s)."
NO_MATCH = "No matches found for query."
HASH_LOG_FORMAT = "%s=>%d"
HASH_LOG_LINES = 10


def chunk_content(matches: DataFrame, docs: DataFrame) -> DataFrame:
    """Bytes ``[offset, offset + size)`` of the source, clamped at its end.

    The index keeps no text; content is joined back for hits only.  ``content`` is
    BINARY (a chunk may cut a character); ``text`` is its display form.
    """
    joined = join_small(docs.select("doc_id", F.col("content").alias("__src")), matches, "doc_id")
    content = F.substring(F.col("__src"), (F.col("offset") + 1).cast("int"), F.col("size"))
    return joined.select(*matches.columns, content.alias("content")) \
        .withColumn("text", F.col("content").cast("string"))


def lookup_report(with_content: DataFrame) -> DataFrame:
    """R2: one report row per hit, as the CLI prints it."""
    return with_content.select(
        *[c for c in with_content.columns if c not in ("content", "text")],
        F.format_string(FOUND_AT, F.col("offset")).alias("header"),
        F.col("text"))


def match_count(queries: DataFrame, matches: DataFrame) -> DataFrame:
    """Hits per query, 0 included."""
    counts = matches.groupBy("query_id").agg(F.count("*").cast("bigint").alias("n_matches"))
    return (queries.select("query_id").join(counts, "query_id", "left")
            .select("query_id", F.coalesce("n_matches", F.lit(0).cast("bigint")).alias("n_matches"),
                    F.when(F.coalesce("n_matches", F.lit(0)) == 0, F.lit(NO_MATCH))
                    .otherwise(F.format_string(FOUND_COUNT, F.col("n_matches"))).alias("summary")))


def report_lines(with_content: DataFrame, queries: DataFrame) -> DataFrame:
    """The CLI report of each query as ordered lines, never gathered in one row; a blank line
    stands before a hit's separator and before the count.

    Order key: ``(query_id, part, distance, doc_id, offset, line_no)``; ``part`` 0 is a
    hit, 1 the summary.  ``write_report`` writes them range-partitioned by that key,
    so one query with very many hits is still split over many tasks.
    """
    hit_lines = F.array(
        F.struct(F.lit(0).alias("line_no"), F.format_string(FOUND_AT, F.col("offset")).alias("line")),
        F.struct(F.lit(1).alias("line_no"), F.lit(CONTENT_HEADER).alias("line")),
        F.struct(F.lit(2).alias("line_no"), F.col("text").alias("line")),
        F.struct(F.lit(3).alias("line_no"), F.lit("").alias("line")),
        F.struct(F.lit(4).alias("line_no"), F.lit(SEPARATOR).alias("line")))
    hits = (with_content
            .select("query_id", F.lit(0).alias("part"), "distance", "doc_id", "offset",
                    F.explode(hit_lines).alias("l"))
            .select("query_id", "part", "distance", "doc_id", "offset", "l.line_no", "l.line"))
    summary = (match_count(queries, with_content)
               .select("query_id", F.lit(1).alias("part"), F.lit(None).cast("int").alias("distance"),
                       F.lit(None).cast("bigint").alias("doc_id"),
                       F.lit(None).cast("bigint").alias("offset"),
                       F.posexplode(F.array(F.lit(""), F.col("summary"))).alias("line_no", "line")))
    return hits.unionByName(summary)


REPORT_ORDER = ("query_id", "part", "distance", "doc_id", "offset", "line_no")


def write_report(lines: DataFrame, path: str) -> None:
    (lines.orderBy(*[F.col(c).asc_nulls_first() for c in REPORT_ORDER])
     .select("line").write.mode("overwrite").text(path))


def first_chunks(chunks: DataFrame, n: int = HASH_LOG_LINES) -> DataFrame:
    """The first n chunks of every file.  ``chunk_idx`` comes from the offset,
    so this is a plain filter: no sort, no window."""
    return chunks.where(F.col("chunk_idx") < n)


def hash_log(chunks: DataFrame, n: int = HASH_LOG_LINES, *, compat: bool = False,
             n_chunks=None) -> DataFrame:
    """``<hex>=><offset>`` for the first chunks of every file.

    ``compat=True`` reproduces the reference's selection: more than 10 chunks ->
    first 9, fewer -> all, exactly 10 -> none.  It needs ``n_chunks`` (a column of
    the per-file chunk count, e.g. from ``chunk_count``).
    """
    if compat:
        limit = (F.when(n_chunks > HASH_LOG_LINES, HASH_LOG_LINES - 1)
                 .when(n_chunks < HASH_LOG_LINES, n_chunks).otherwise(0))
        picked = chunks.where(F.col("chunk_idx") < limit)
    else:
        picked = first_chunks(chunks, n)
    return picked.select("doc_id", "chunk_idx",
                         F.format_string(HASH_LOG_FORMAT, format_hex_hash("hash"),
                                         F.col("offset")).alias("line"))


def write_hash_log(log: DataFrame, path: str) -> None:
    log.orderBy("doc_id", "chunk_idx").select("line").write.mode("overwrite").text(path)


def matches_json(matches: DataFrame, key: str = "query_id") -> DataFrame:
    """One JSON object per hit."""
    return matches.select(key, F.to_json(F.struct(*[F.col(c) for c in matches.columns]))
                          .alias("json"))
