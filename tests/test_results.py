import json
import os

from simdex.operators.lookup import nearest_chunks
from simdex.operators.results import (lookup_report, matches_json, report_lines, write_report)
from simdex.plans.distribution import content_distribution, top_buckets
from tests.conftest import docs_df


def matches(spark):
    return spark.createDataFrame(
        [("q1", 1, 0, 0, 5, 7, 0, "exact"), ("q1", 1, 1, 7, 3, 7, 0, "exact"),
         ("q2", 2, 0, 0, 4, 9, 3, "fuzzy")],
        "query_id string, doc_id bigint, chunk_idx int, offset bigint, size int, hash bigint, "
        "distance int, match_type string")


def test_report_lines_in_cli_order(spark, tmp_dir):
    from simdex.operators.results import chunk_content
    docs = docs_df(spark, {1: "Hello, Go! This is a test file.", 2: "abcd"})
    q = spark.createDataFrame([("q1", 7), ("q2", 9), ("q3", 11)], "query_id string, qhash bigint")
    lines = report_lines(chunk_content(matches(spark), docs), q)
    out = os.path.join(tmp_dir, "report")
    write_report(lines, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out))
                   if f.startswith("part-"))
    assert text.splitlines() == [
        "Query found in chunk at byte offset: 0", "Chunk content:", "Hello", "", "---",
        "Query found in chunk at byte offset: 7", "Chunk content:", "Go!", "", "---", "",
        "Query found 2 indexed chunk(s).",
        "Query found in chunk at byte offset: 0", "Chunk content:", "abcd", "", "---", "",
        "Query found 1 indexed chunk(s).",
        "", "No matches found for query."]
    rep = lookup_report(chunk_content(matches(spark), docs)).where("query_id = 'q2'").first()
    assert rep.header == "Query found in chunk at byte offset: 0" and rep.text == "abcd"


def test_matches_json(spark):
    rows = matches_json(matches(spark)).collect()
    first = json.loads(sorted(r.json for r in rows)[0])
    assert set(first) == {"query_id", "doc_id", "chunk_idx", "offset", "size", "hash", "distance",
                          "match_type"}


def test_nearest_chunks_ties(spark):
    got = nearest_chunks(matches(spark), 1).collect()
    assert sorted((r.query_id, r.offset) for r in got) == [("q1", 0), ("q2", 0)]


def test_distribution_and_top_buckets(spark):
    idx = spark.createDataFrame(
        [(1, 0, "en", "s", 10, 5, 3), (1, 1, "en", "s", 10, 5, 3), (2, 0, "en", "s", 4, 0, -1),
         (3, 0, "fr", "t", 8, 2, 4)],
        "doc_id bigint, chunk_idx int, lang string, source string, size int, n_words int, hash bigint")
    d = {(r.lang, r.source): r for r in content_distribution(idx).collect()}
    en = d[("en", "s")]
    assert (en.n_docs, en.n_chunks, en.n_bytes, en.n_distinct_hashes, en.dup_chunks,
            en.largest_bucket, en.wordless_chunks) == (2, 3, 24, 2, 2, 2, 1)
    top = top_buckets(idx, 1).collect()
    assert sorted((r.lang, r.hash, r.n_chunks) for r in top) == [("en", 3, 2), ("fr", 4, 1)]


def test_hash_log_file(spark, tmp_dir):
    import os
    from simdex.operators.results import write_hash_log
    log = spark.createDataFrame([(1, 1, "b=>10"), (1, 0, "a=>0")], "doc_id bigint, chunk_idx int, line string")
    write_hash_log(log, os.path.join(tmp_dir, "log"))
    assert [r.value for r in spark.read.text(os.path.join(tmp_dir, "log")).collect()] == ["a=>0", "b=>10"]
