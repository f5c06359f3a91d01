"""Registered queries: one per operator, each over whole tables of an sf folder.

Every query callable takes ``(spark, sf_dir)`` and returns a DataFrame; ``ORACLE``
holds the DuckDB SQL that computes the same rows (column names aligned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions.hexcodec import format_hex_hash, parse_hex_hash
from .functions.simhash import shingles, word_features
from .operators.chunking import chunk_count, chunk_fixed
from .operators.index import build_index, hash_buckets, index_summary
from .operators.lookup import lookup, lookup_exact, lookup_fuzzy, nearest, nearest_chunks, unmatched_queries
from .operators.results import (chunk_content, hash_log, lookup_report, match_count,
                                matches_json, report_lines)
from .plans.dedup import dedup_documents, document_fingerprints, near_duplicate_pairs
from .plans.distribution import content_distribution, distance_histogram, top_buckets
from .plans.plagiarism import plagiarism_matches, plagiarism_passages
from .plans.sketches import ITEM_ERROR, MAX_ITEMS, RELATIVE_ERROR, sketched_distribution, write_sketches
from .plans.search import prepare_queries, search_corpus, unanswered
from .operators.sizing import materialize, stored
from .session import work_path
from .sources.band_store import read_bands
from .sources.bucketed_store import lookup_bucketed, write_bucketed
from .sources.documents import load_documents, read_table
from .sources.located_index import (add_documents, current_documents, joined_content, located_content, located_documents,
                                    opened_by_tasks, read_located, with_places)
from .sources.index_store import read_index, write_index

# Fixed parameters of the registered queries.
CHUNK = 512
STRIDE = 256
K = 10
TOP_N = 5
PLAGIARISM_CHUNK = 128
PLAGIARISM_STRIDE = 32
BUCKETED_HOT = 20

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- shared inputs

def _docs(spark, sf, **kw):
    return load_documents(spark, sf, **kw)


def _index(spark, sf, chunk=CHUNK, **kw):
    return build_index(_docs(spark, sf), chunk, **kw)


def _stored_index(spark, sf, chunk=CHUNK, **kw):
    """The index as a lookup job reads it: computed once, then read from storage."""
    return materialize(_index(spark, sf, chunk, **kw))


def _bench_queries(spark, sf):
    """Query hashes: the SimHash of every benchmark text."""
    q = prepare_queries(read_table(spark, sf, "benchmark"), id_col="item_id")
    return q.withColumn("query_id", F.col("query_id").cast("string")).select("query_id", "qhash")


D = O.documents()
IDX = O.index(D, CHUNK)
Q = O.queries()
PAIRS = (f"SELECT q.query_id, c.doc_id, c.chunk_idx, c.\"offset\", c.size, c.hash, "
         f"CAST(bit_count(xor(c.hash, q.qhash)) AS INTEGER) AS distance "
         f"FROM ({IDX}) c JOIN ({Q}) q ON bit_count(xor(c.hash, q.qhash)) <= {K} "
         f"WHERE q.qhash <> 0")
LOOKUP_FILE = (f"SELECT query_id, doc_id, chunk_idx, \"offset\", size, hash, distance, "
               f"CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END AS match_type FROM "
               f"(SELECT *, min(distance) OVER (PARTITION BY query_id, doc_id) AS best "
               f"FROM ({PAIRS}) p) x WHERE distance = 0 OR best > 0")
MATCH_COLS = "query_id, doc_id, chunk_idx, \"offset\", size, hash, distance, match_type"


# ---------------------------------------------------------------- chunking, fingerprints

@register("chunk_fixed", f"SELECT doc_id, chunk_size, chunk_idx, \"offset\", size, "
                         f"md5(chunk) AS chunk_md5 FROM ({O.chunks(D, CHUNK)}) c")
def q_chunk_fixed(spark, sf):
    return chunk_fixed(_docs(spark, sf), CHUNK).select(
        "doc_id", "chunk_size", "chunk_idx", "offset", "size", F.md5("chunk").alias("chunk_md5"))


@register("chunk_count", f"SELECT doc_id, CAST(octet_length(content) AS BIGINT) AS n_bytes, "
                         f"CAST(ceil(octet_length(content) / {CHUNK}) AS INTEGER) AS n_chunks FROM ({D}) d")
def q_chunk_count(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.octet_length("content").cast("bigint").alias("n_bytes"),
                    chunk_count("content", CHUNK).alias("n_chunks"))


@register("word_features", f"SELECT doc_id, chunk_idx, CAST(len(w) AS INTEGER) AS n_words, "
                           f"array_to_string(w, ' ') AS words FROM (SELECT doc_id, chunk_idx, "
                           f"{O.blob_words('chunk')} AS w FROM ({O.chunks(D, CHUNK)}) c) x")
def q_word_features(spark, sf):
    c = chunk_fixed(_docs(spark, sf), CHUNK).withColumn("w", word_features("chunk"))
    return c.select("doc_id", "chunk_idx", F.size("w").alias("n_words"),
                    F.array_join("w", " ").alias("words"))


@register("word_shingles",
          f"SELECT doc_id, CAST(len(s) AS INTEGER) AS n_shingles, "
          f"md5(array_to_string(s, '|')) AS shingles_md5 FROM (SELECT doc_id, "
          f"{O.shingles('w')} AS s FROM (SELECT doc_id, {O.blob_words('content')} AS w "
          f"FROM ({D}) d0) d) x")
def q_word_shingles(spark, sf):
    d = _docs(spark, sf).withColumn("w", word_features("content")) \
        .withColumn("s", shingles("w", 3))
    return d.select("doc_id", F.size("s").alias("n_shingles"),
                    F.md5(F.array_join("s", "|")).alias("shingles_md5"))


@register("simhash_chunks", IDX)
def q_simhash_chunks(spark, sf):
    return _index(spark, sf)


@register("simhash_chunks_native", IDX)
def q_simhash_chunks_native(spark, sf):
    return _index(spark, sf, method="native")


@register("chunk_stride", O.index(D, CHUNK, STRIDE))
def q_chunk_stride(spark, sf):
    return _index(spark, sf, stride=STRIDE)


@register("doc_fingerprints",
          O.with_simhash(D, "content", ["doc_id"], features="shingle", n_col="n_features"))
def q_doc_fingerprints(spark, sf):
    return document_fingerprints(_docs(spark, sf))


@register("query_simhash", f"SELECT query_id, chunk_size, qhash FROM ({Q}) q")
def q_query_simhash(spark, sf):
    q = prepare_queries(read_table(spark, sf, "benchmark"), id_col="item_id")
    return q.withColumn("query_id", F.col("query_id").cast("string"))


# ---------------------------------------------------------------- index views, store

@register("hash_buckets",
          f"SELECT doc_id, hash, CAST(chunk_idx // 4096 AS INTEGER) AS block, "
          f"array_to_string(list_sort(list(chunk_idx)), ',') AS chunk_list, "
          f"CAST(count(*) AS BIGINT) AS n_chunks FROM ({IDX}) i GROUP BY doc_id, hash, chunk_idx // 4096")
def q_hash_buckets(spark, sf):
    b = hash_buckets(_index(spark, sf))
    return b.select("doc_id", "hash", "block", F.array_join("chunk_idxs", ",").alias("chunk_list"), "n_chunks")


@register("index_summary",
          f"SELECT doc_id, chunk_size, CAST(count(*) AS BIGINT) AS n_chunks, "
          f"CAST(sum(size) AS BIGINT) AS n_bytes, CAST(count(DISTINCT hash) AS BIGINT) AS "
          f"n_distinct_hashes FROM ({IDX}) i GROUP BY doc_id, chunk_size")
def q_index_summary(spark, sf):
    return index_summary(_index(spark, sf))


@register("index_roundtrip", IDX)
def q_index_roundtrip(spark, sf):
    path = write_index(_index(spark, sf), work_path(spark, "index"))
    return read_index(spark, path, CHUNK).select(
        "doc_id", "chunk_size", "chunk_idx", "offset", "size", "n_words", "hash")


@register("lookup_bucketed",
          f"WITH i AS MATERIALIZED ({IDX}) SELECT q.doc_id || '-' || q.chunk_idx AS query_id, i.doc_id, i.chunk_idx, i.\"offset\", i.size, "
          f"i.hash, CAST(0 AS INTEGER) AS distance, 'exact' AS match_type FROM i JOIN i q ON i.hash = q.hash "
          f"WHERE q.doc_id % 20 = 0 AND q.hash <> 0")
def q_lookup_bucketed(spark, sf):
    """All chunks of the query set (ids divisible by 20) looked up in a bucketed index of all rows."""
    idx = _stored_index(spark, sf)
    table = write_bucketed(idx, work_path(spark, "bucketed"), 16, hot_rows=BUCKETED_HOT)
    asked = idx.where("doc_id % 20 = 0").select(F.concat_ws("-", "doc_id", "chunk_idx").alias("query_id"),
                                                F.col("hash").alias("qhash"))
    return lookup_bucketed(table, asked)


@register("hash_log", f"SELECT doc_id, chunk_idx, lower(hex(hash)) || '=>' || \"offset\" AS line "
                      f"FROM ({IDX}) i WHERE chunk_idx < 10")
def q_hash_log(spark, sf):
    return hash_log(_index(spark, sf))


@register("hash_log_compat",
          f"SELECT doc_id, chunk_idx, lower(hex(hash)) || '=>' || \"offset\" AS line FROM "
          f"(SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ({IDX}) i) x "
          f"WHERE chunk_idx < CASE WHEN n > 10 THEN 9 WHEN n < 10 THEN n ELSE 0 END")
def q_hash_log_compat(spark, sf):
    d = _docs(spark, sf).withColumn("n_chunks", chunk_count("content", CHUNK))
    idx = build_index(d, CHUNK, keep=("doc_id", "n_chunks"))
    return hash_log(idx, compat=True, n_chunks=F.col("n_chunks"))


@register("first_chunks", f"SELECT * FROM ({IDX}) i WHERE chunk_idx < 3")
def q_first_chunks(spark, sf):
    from .operators.results import first_chunks
    return first_chunks(_index(spark, sf), 3)


@register("parse_hex_hash",
          f"SELECT w, {O.hex_parse('w')} AS parsed FROM (SELECT DISTINCT unnest({O.blob_words('content')}) "
          f"AS w FROM ({D}) d) x")
def q_parse_hex_hash(spark, sf):
    words = _docs(spark, sf).select(F.explode(word_features("content")).alias("w")).distinct()
    return words.select("w", parse_hex_hash("w").alias("parsed"))


@register("format_hex_hash",
          f"SELECT doc_id, chunk_idx, lower(hex(hash)) AS hex, "
          f"{O.hex_parse('lower(hex(hash))')} = hash AS roundtrip FROM ({IDX}) i")
def q_format_hex_hash(spark, sf):
    idx = _index(spark, sf).withColumn("hex", format_hex_hash("hash"))
    return idx.select("doc_id", "chunk_idx", "hex", (parse_hex_hash("hex") == F.col("hash"))
                      .alias("roundtrip"))


# ---------------------------------------------------------------- lookups

@register("lookup_exact",
          f"SELECT {MATCH_COLS} FROM (SELECT *, 'exact' AS match_type FROM ({PAIRS}) p "
          f"WHERE distance = 0) x")
def q_lookup_exact(spark, sf):
    return lookup_exact(_stored_index(spark, sf), _bench_queries(spark, sf))


FLAGGED_Q = (f"SELECT DISTINCT lower(hex(i.hash)) AS query_id, i.hash AS qhash FROM ({IDX}) i "
             f"JOIN labels l ON i.doc_id = l.doc_id WHERE l.toxic = 1")


@register("lookup_exact_flagged",
          f"SELECT q.query_id, i.doc_id, i.chunk_idx, i.\"offset\", i.size, i.hash, 0 AS distance, "
          f"'exact' AS match_type FROM ({IDX}) i JOIN ({FLAGGED_Q}) q ON i.hash = q.qhash "
          f"WHERE q.qhash <> 0")
def q_lookup_exact_flagged(spark, sf):
    """Where does the content of flagged (toxic) documents occur in the corpus?
    Queries are the distinct chunk hashes of those documents, so a hash shared by
    many flagged chunks is looked up once."""
    idx = _stored_index(spark, sf)
    flagged = read_table(spark, sf, "labels").where(F.col("toxic") == 1).select("doc_id")
    q = (idx.join(flagged, "doc_id", "left_semi").select(F.col("hash").alias("qhash")).distinct()
         .withColumn("query_id", format_hex_hash("qhash")))
    return lookup_exact(idx, q).select("query_id", "doc_id", "chunk_idx", "offset", "size", "hash",
                                       F.col("distance").cast("int").alias("distance"), "match_type")


@register("lookup_fuzzy",
          f"SELECT {MATCH_COLS} FROM (SELECT *, CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END "
          f"AS match_type FROM ({PAIRS}) p) x")
def q_lookup_fuzzy(spark, sf):
    return lookup_fuzzy(_stored_index(spark, sf), _bench_queries(spark, sf), K)


@register("lookup", LOOKUP_FILE)
def q_lookup(spark, sf):
    return lookup(_stored_index(spark, sf), _bench_queries(spark, sf), K, scope="file")


@register("lookup_corpus",
          f"SELECT {MATCH_COLS} FROM (SELECT *, CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END "
          f"AS match_type, min(distance) OVER (PARTITION BY query_id) AS best FROM ({PAIRS}) p) x "
          f"WHERE distance = 0 OR best > 0")
def q_lookup_corpus(spark, sf):
    return lookup(_stored_index(spark, sf), _bench_queries(spark, sf), K, scope="corpus")


@register("lookup_banded", LOOKUP_FILE)
def q_lookup_banded(spark, sf):
    return lookup(_stored_index(spark, sf), _bench_queries(spark, sf), K, scope="file", strategy="banded")


@register("unmatched_queries",
          f"SELECT query_id, qhash, CASE WHEN qhash = 0 THEN 'simhash value is required' "
          f"ELSE 'no matches found' END AS reason FROM ({Q}) q WHERE qhash = 0 OR query_id NOT IN "
          f"(SELECT query_id FROM ({LOOKUP_FILE}) m)")
def q_unmatched(spark, sf):
    q = _bench_queries(spark, sf)
    return unmatched_queries(q, lookup(_stored_index(spark, sf), q, K))


@register("nearest_chunks",
          f"SELECT * FROM (SELECT {MATCH_COLS}, CAST(row_number() OVER (PARTITION BY query_id "
          f"ORDER BY distance, doc_id, \"offset\") AS INTEGER) AS rank FROM "
          f"(SELECT *, CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END AS match_type "
          f"FROM ({PAIRS}) p) y) x WHERE rank <= {TOP_N}")
def q_nearest(spark, sf):
    m = lookup_fuzzy(_stored_index(spark, sf), _bench_queries(spark, sf), K)
    return nearest_chunks(m, TOP_N)


@register("nearest_any",
          f"SELECT query_id, doc_id, chunk_idx, \"offset\", size, hash, distance, CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END "
          f"AS match_type, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id "
          f"ORDER BY distance, doc_id, \"offset\") AS rank FROM (SELECT q.query_id, c.doc_id, c.chunk_idx, c.\"offset\", c.size, "
          f"c.hash, CAST(bit_count(xor(c.hash, q.qhash)) AS INTEGER) AS distance FROM ({IDX}) c, ({Q}) q WHERE q.qhash <> 0) p) x "
          f"WHERE rank <= {TOP_N}")
def q_nearest_any(spark, sf):
    """The nearest chunks of every query, however far away."""
    return nearest(_stored_index(spark, sf), _bench_queries(spark, sf), TOP_N)


def _banded_index(spark, sf):
    """An index with band tables: even documents written, the others streamed into it in two runs."""
    from .streaming.incremental import document_stream, incremental_index
    docs = read_table(spark, sf, "documents")
    out, ckpt, inbox = (work_path(spark, n) for n in ("index", "stream-ckpt", "inbox"))
    write_index(build_index(load_documents(spark, sf).where("doc_id % 2 = 0"), CHUNK), out, bands=True)
    for rest in (1, 3):
        docs.where(F.col("doc_id") % 4 == rest).write.parquet(f"{inbox}/run={rest}")
        incremental_index(document_stream(spark, f"{inbox}/*", docs.schema), CHUNK, out, ckpt, bands=True).awaitTermination()
    return out


@register("lookup_stored_bands", LOOKUP_FILE)
def q_lookup_stored_bands(spark, sf):
    path = _banded_index(spark, sf)
    return lookup(read_index(spark, path, CHUNK), _bench_queries(spark, sf), K, bands=read_bands(spark, path))


@register("hamming_histogram",
          f"SELECT distance, CAST(count(*) AS BIGINT) AS n FROM ({PAIRS}) p GROUP BY distance")
def q_hamming_histogram(spark, sf):
    return distance_histogram(lookup_fuzzy(_stored_index(spark, sf), _bench_queries(spark, sf), K))


# ---------------------------------------------------------------- results

CONTENT = (f"SELECT m.*, c.content[m.\"offset\" + 1:m.\"offset\" + m.size] AS content FROM "
           f"({LOOKUP_FILE}) m JOIN ({D}) c ON m.doc_id = c.doc_id")


@register("chunk_content", f"SELECT {MATCH_COLS}, hex(content) AS content_hex FROM ({CONTENT}) x")
def q_chunk_content(spark, sf):
    docs = _docs(spark, sf)
    m = lookup(materialize(build_index(docs, CHUNK)), _bench_queries(spark, sf), K)
    return chunk_content(m, docs).select(*m.columns, F.hex("content").alias("content_hex"))


@register("located_content", f"SELECT {MATCH_COLS}, hex(content) AS content_hex, CAST(NULL AS VARCHAR) AS reason FROM ({CONTENT}) x")
def q_located_content(spark, sf):
    """Content of hits read from their row groups, of an index whose query set (ids divisible by 20) was
    written a second time and so replaced."""
    docs = located_documents(spark, f"{sf.rstrip('/')}/documents.parquet")
    path = work_path(spark, "located")
    add_documents(docs, CHUNK, path)
    add_documents(docs.where("doc_id % 20 = 0"), CHUNK, path)
    idx = materialize(read_located(spark, path))
    hits = with_places(lookup(idx, _bench_queries(spark, sf), K), idx)
    known = current_documents(spark, path)
    found = located_content(hits, known) if opened_by_tasks(sf) else joined_content(hits, known, docs)
    return found.select(
        *MATCH_COLS.replace('"', "").split(", "), F.hex("content").alias("content_hex"), "reason")


@register("lookup_report",
          f"SELECT {MATCH_COLS}, 'Query found in chunk at byte offset: ' || \"offset\" AS header, "
          f"md5(content) AS text_md5 FROM ({CONTENT}) x")
def q_lookup_report(spark, sf):
    docs = _docs(spark, sf)
    m = lookup(materialize(build_index(docs, CHUNK)), _bench_queries(spark, sf), K)
    r = lookup_report(chunk_content(m, docs))
    return r.withColumn("text_md5", F.md5(F.col("text").cast("binary"))).drop("text")


@register("match_count",
          f"SELECT q.query_id, CAST(count(m.query_id) AS BIGINT) AS n_matches, "
          f"CASE WHEN count(m.query_id) = 0 THEN 'No matches found for query.' ELSE "
          f"'Query found ' || count(m.query_id) || ' indexed chunk(s).' END AS summary "
          f"FROM ({Q}) q LEFT JOIN ({LOOKUP_FILE}) m ON q.query_id = m.query_id GROUP BY q.query_id")
def q_match_count(spark, sf):
    q = _bench_queries(spark, sf)
    return match_count(q, lookup(_stored_index(spark, sf), q, K))


@register("report_text",
          f"SELECT query_id, 0 AS part, distance, doc_id, \"offset\", line_no, line FROM "
          f"(SELECT m.*, unnest([0, 1, 2, 3, 4]) AS line_no, unnest(["
          f"'Query found in chunk at byte offset: ' || \"offset\", 'Chunk content:', "
          f"md5(content), '', '---']) AS line FROM ({CONTENT}) m) x "
          f"UNION ALL SELECT query_id, 1, NULL, NULL, NULL, unnest([0, 1]), unnest(['', s]) FROM ("
          f"SELECT q.query_id, CASE WHEN count(m.query_id) = 0 "
          f"THEN 'No matches found for query.' ELSE 'Query found ' || count(m.query_id) || "
          f"' indexed chunk(s).' END AS s FROM ({Q}) q LEFT JOIN ({LOOKUP_FILE}) m "
          f"ON q.query_id = m.query_id GROUP BY q.query_id) y")
def q_report_text(spark, sf):
    docs = _docs(spark, sf)
    q = _bench_queries(spark, sf)
    m = lookup(materialize(build_index(docs, CHUNK)), q, K)
    c = chunk_content(m, docs).withColumn("text", F.md5("content"))
    return report_lines(c, q).select("query_id", "part", "distance", "doc_id", "offset",
                                     "line_no", "line")


@register("matches_json",
          f"SELECT query_id, to_json({{'query_id': query_id, 'doc_id': doc_id, 'chunk_idx': chunk_idx, "
          f"'offset': \"offset\", 'size': size, 'hash': hash, 'distance': distance, "
          f"'match_type': match_type}}) AS json FROM ({LOOKUP_FILE}) m")
def q_matches_json(spark, sf):
    return matches_json(lookup(_stored_index(spark, sf), _bench_queries(spark, sf), K))


# ---------------------------------------------------------------- composed jobs

def _search_sql(scope_key: str, qs: str = O.queries()) -> str:
    lens = f"SELECT DISTINCT chunk_size FROM ({qs}) q"
    idx = O.with_simhash(
        f"SELECT doc_id, chunk_size, CAST(o // chunk_size AS INTEGER) AS chunk_idx, "
        f"CAST(o AS BIGINT) AS \"offset\", CAST(octet_length(content[o + 1:o + chunk_size]) AS INTEGER) "
        f"AS size, content[o + 1:o + chunk_size] AS chunk FROM (SELECT d.doc_id, d.content, l2.chunk_size, "
        f"unnest(range(0, octet_length(d.content), l2.chunk_size)) AS o FROM ({D}) d, ({lens}) l2 "
        f"WHERE octet_length(d.content) > 0) l",
        "chunk", ["doc_id", "chunk_size", "chunk_idx", "\"offset\"", "size"])
    pairs = (f"SELECT c.chunk_size, q.query_id, c.doc_id, c.chunk_idx, c.\"offset\", c.size, c.hash, "
             f"CAST(bit_count(xor(c.hash, q.qhash)) AS INTEGER) AS distance "
             f"FROM ({idx}) c JOIN ({qs}) q ON c.chunk_size = q.chunk_size AND "
             f"bit_count(xor(c.hash, q.qhash)) <= {K} WHERE q.qhash <> 0")
    m = (f"SELECT chunk_size, {MATCH_COLS} FROM (SELECT *, CASE WHEN distance = 0 THEN 'exact' "
         f"ELSE 'fuzzy' END AS match_type, min(distance) OVER (PARTITION BY {scope_key}) AS best "
         f"FROM ({pairs}) p) x WHERE distance = 0 OR best > 0")
    return (f"SELECT m.chunk_size, {', '.join('m.' + c for c in MATCH_COLS.split(', '))}, "
            f"hex(d.content[m.\"offset\" + 1:m.\"offset\" + m.size]) AS content_hex "
            f"FROM ({m}) m JOIN ({D}) d ON m.doc_id = d.doc_id")


def _search(spark, sf, scope):
    docs = _docs(spark, sf)
    bench = read_table(spark, sf, "benchmark").withColumn("item_id", F.col("item_id").cast("string"))
    r = search_corpus(docs, bench, K, scope=scope, id_col="item_id")
    return r.select("chunk_size", "query_id", "doc_id", "chunk_idx", "offset", "size", "hash",
                    "distance", "match_type", F.hex("content").alias("content_hex"))


@register("search_text", _search_sql("query_id, doc_id"))
def q_search_text(spark, sf):
    return _search(spark, sf, "file")


@register("search_corpus", _search_sql("query_id"))
def q_search_corpus(spark, sf):
    return _search(spark, sf, "corpus")


@register("search_documents", _search_sql("query_id, doc_id", O.queries(
    "(SELECT * FROM documents WHERE doc_id % 20 = 0) d20", "doc_id")))
def q_search_documents(spark, sf):
    """Whole documents (the query set: ids divisible by 20) searched in all documents, each at its own
    length: as many lengths as texts."""
    asked = read_table(spark, sf, "documents").where("doc_id % 20 = 0").select(F.col("doc_id").cast("string").alias("query_id"), "text")
    return search_corpus(_docs(spark, sf), asked, K, scope="file").select(
        "chunk_size", "query_id", "doc_id", "chunk_idx", "offset", "size", "hash", "distance", "match_type",
        F.hex("content").alias("content_hex"))


FP = O.with_simhash(D, "content", ["doc_id"], features="shingle", n_col="n_features")
FPW = f"SELECT * FROM ({FP}) f WHERE n_features > 0"
GROUPS = f"SELECT hash, min(doc_id) AS rep FROM ({FPW}) f GROUP BY hash"
DEDUP_PAIRS = (
    f"SELECT f_rep.rep AS doc_a, f.doc_id AS doc_b, f.hash AS hash_a, f.hash AS hash_b, 0 AS distance, "
    f"'exact' AS kind FROM ({FPW}) f JOIN ({GROUPS}) f_rep ON f.hash = f_rep.hash "
    f"WHERE f.doc_id <> f_rep.rep UNION ALL "
    f"SELECT a.rep, b.rep, a.hash, b.hash, CAST(bit_count(xor(a.hash, b.hash)) AS INTEGER), 'near' "
    f"FROM ({GROUPS}) a JOIN ({GROUPS}) b ON a.rep < b.rep AND bit_count(xor(a.hash, b.hash)) <= {K}")
WORDSET = f"SELECT doc_id, list_distinct({O.blob_words('content')}) AS w FROM ({D}) d"


@register("near_duplicate_pairs",
          f"SELECT doc_a, doc_b, hash_a, hash_b, CAST(distance AS INTEGER) AS distance, kind, "
          f"round(CASE WHEN u = 0 THEN 1.0 ELSE i / u END, 6) AS jaccard FROM "
          f"(SELECT p.*, len(list_intersect(a.w, b.w)) AS i, "
          f"len(a.w) + len(b.w) - len(list_intersect(a.w, b.w)) AS u FROM ({DEDUP_PAIRS}) p "
          f"JOIN ({WORDSET}) a ON p.doc_a = a.doc_id JOIN ({WORDSET}) b ON p.doc_b = b.doc_id) x")
def q_near_dups(spark, sf):
    return near_duplicate_pairs(_docs(spark, sf), K)


@register("dedup_documents",
          f"WITH RECURSIVE p AS MATERIALIZED ({DEDUP_PAIRS}), "
          f"e AS MATERIALIZED (SELECT doc_a AS a, doc_b AS b FROM p UNION SELECT doc_b, doc_a FROM p), "
          f"r(node, comp) AS (SELECT doc_id, doc_id FROM ({D}) d UNION "
          f"SELECT e.b, r.comp FROM r JOIN e ON r.node = e.a), "
          f"c AS (SELECT node, min(comp) AS comp FROM r GROUP BY node) "
          f"SELECT node AS doc_id, comp AS group_id, CAST(count(*) OVER (PARTITION BY comp) AS BIGINT) "
          f"AS group_size, node = comp AS keep FROM c")
def q_dedup(spark, sf):
    return dedup_documents(_docs(spark, sf), K)


WEIGHTED_K = 3


@register("weighted_fingerprints", O.weighted_simhash(D))
def q_weighted(spark, sf):
    """Every document's fingerprint of words weighted by their rarity."""
    return document_fingerprints(_docs(spark, sf), features="weighted")


@register("near_duplicates_weighted",
          f"WITH f AS MATERIALIZED (SELECT * FROM ({O.weighted_simhash(D)}) x WHERE n_features > 0), "
          f"g AS (SELECT hash, min(doc_id) AS rep FROM f GROUP BY hash) "
          f"SELECT g.rep AS doc_a, f.doc_id AS doc_b, f.hash AS hash_a, f.hash AS hash_b, 0 AS distance, 'exact' AS kind "
          f"FROM f JOIN g ON f.hash = g.hash WHERE f.doc_id <> g.rep UNION ALL "
          f"SELECT a.rep, b.rep, a.hash, b.hash, CAST(bit_count(xor(a.hash, b.hash)) AS INTEGER), 'near' "
          f"FROM g a JOIN g b ON a.rep < b.rep AND bit_count(xor(a.hash, b.hash)) <= {WEIGHTED_K}")
def q_near_weighted(spark, sf):
    """U1 with words weighted by their rarity."""
    return near_duplicate_pairs(_docs(spark, sf), WEIGHTED_K, features="weighted", with_jaccard=False)


def _plag_sql():
    bench = O.documents("benchmark", "item_id")
    ref = O.index(bench, PLAGIARISM_CHUNK)
    sub = O.index(D, PLAGIARISM_CHUNK, PLAGIARISM_STRIDE)
    pairs = (f"SELECT s.doc_id, s.chunk_idx, r.doc_id AS ref_id, "
             f"bit_count(xor(s.hash, r.hash)) AS distance FROM ({sub}) s JOIN ({ref}) r "
             f"ON bit_count(xor(s.hash, r.hash)) <= {K} WHERE s.hash <> 0 "
             f"AND s.n_words > 0 AND r.n_words > 0")
    kept = (f"SELECT * FROM (SELECT *, min(distance) OVER (PARTITION BY doc_id, chunk_idx) AS best "
            f"FROM ({pairs}) p) x WHERE distance = 0 OR best > 0")
    scored = (f"SELECT doc_id, ref_id, CAST(count(DISTINCT chunk_idx) AS BIGINT) AS matched_chunks, "
              f"round(avg(distance), 6) AS mean_distance, CAST(min(distance) AS INTEGER) AS min_distance "
              f"FROM ({kept}) k GROUP BY doc_id, ref_id")
    return (f"SELECT s.doc_id, s.ref_id, s.matched_chunks, CAST(ceil(octet_length(d.content) / "
            f"{PLAGIARISM_STRIDE}) AS BIGINT) AS n_chunks, round(s.matched_chunks / "
            f"ceil(octet_length(d.content) / {PLAGIARISM_STRIDE}), 6) AS share, s.mean_distance, "
            f"s.min_distance FROM ({scored}) s JOIN ({D}) d ON s.doc_id = d.doc_id")


@register("plagiarism_matches", _plag_sql())
def q_plagiarism(spark, sf):
    refs = load_documents(spark, sf, "benchmark", id_col="item_id")
    return plagiarism_matches(refs, _docs(spark, sf), chunk_size=PLAGIARISM_CHUNK,
                              stride=PLAGIARISM_STRIDE, k=K)


def _passages_sql():
    ref = O.index(O.documents("benchmark", "item_id"), PLAGIARISM_CHUNK)
    sub = O.index(D, PLAGIARISM_CHUNK, PLAGIARISM_STRIDE)
    pairs = (f"SELECT s.doc_id, s.\"offset\" AS o, s.size, r.doc_id AS ref_id, r.\"offset\" AS ro, r.size AS rsize, "
             f"bit_count(xor(s.hash, r.hash)) AS distance FROM ({sub}) s JOIN ({ref}) r "
             f"ON bit_count(xor(s.hash, r.hash)) <= {K} WHERE s.hash <> 0 AND s.n_words > 0 AND r.n_words > 0")
    kept = (f"SELECT *, o - ro AS diagonal FROM (SELECT *, min(distance) OVER (PARTITION BY doc_id, o) AS best "
            f"FROM ({pairs}) p) x WHERE distance = 0 OR best > 0")
    part = "PARTITION BY doc_id, ref_id, diagonal ORDER BY o"
    chains = (f"SELECT *, sum(CASE WHEN before IS NULL OR o > before + {PLAGIARISM_CHUNK} THEN 1 ELSE 0 END) OVER ({part}) AS chain "
              f"FROM (SELECT *, max(o + size) OVER ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before "
              f"FROM ({kept}) k) b")
    return (f"SELECT doc_id, ref_id, min(o) AS doc_from, max(o + size) AS doc_to, min(ro) AS ref_from, max(ro + rsize) AS ref_to, "
            f"CAST(count(*) AS BIGINT) AS chunks, round(avg(distance), 6) AS mean_distance FROM ({chains}) c "
            f"GROUP BY doc_id, ref_id, diagonal, chain")


@register("plagiarism_passages", _passages_sql())
def q_passages(spark, sf):
    """Which bytes of a document match which of a reference text, chained from chunks."""
    refs = load_documents(spark, sf, "benchmark", id_col="item_id")
    return plagiarism_passages(refs, _docs(spark, sf), chunk_size=PLAGIARISM_CHUNK, stride=PLAGIARISM_STRIDE, k=K)


IDX_LS = O.index(O.documents(extra=("lang", "source")), CHUNK, extra=("lang", "source"))


@register("content_distribution",
          f"WITH b AS (SELECT lang, source, hash, count(*) AS cnt, sum(size) AS bytes, "
          f"sum(CASE WHEN n_words = 0 THEN 1 ELSE 0 END) AS wordless FROM ({IDX_LS}) i "
          f"GROUP BY lang, source, hash), "
          f"g AS (SELECT lang, source, CAST(sum(cnt) AS BIGINT) AS n_chunks, "
          f"CAST(sum(bytes) AS BIGINT) AS n_bytes, CAST(count(*) AS BIGINT) AS n_distinct_hashes, "
          f"CAST(sum(CASE WHEN cnt > 1 THEN cnt ELSE 0 END) AS BIGINT) AS dup_chunks, "
          f"CAST(max(cnt) AS BIGINT) AS largest_bucket, CAST(sum(wordless) AS BIGINT) AS wordless_chunks "
          f"FROM b GROUP BY lang, source), "
          f"n AS (SELECT lang, source, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_docs FROM ({IDX_LS}) i "
          f"GROUP BY lang, source) "
          f"SELECT g.lang, g.source, n_docs, n_chunks, n_bytes, n_distinct_hashes, dup_chunks, "
          f"round(dup_chunks / n_chunks, 6) AS dup_share, largest_bucket, wordless_chunks "
          f"FROM g JOIN n ON g.lang = n.lang AND g.source = n.source")
def q_distribution(spark, sf):
    idx = build_index(_docs(spark, sf, extra=("lang", "source")), CHUNK,
                      keep=("doc_id", "lang", "source"))
    return content_distribution(idx)


@register("distribution_sketches",
          f"SELECT lang, source, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(size) AS BIGINT) AS n_bytes, "
          f"true AS distinct_near, true AS largest_near FROM ({IDX_LS}) i GROUP BY lang, source")
def q_sketches(spark, sf):
    """Sketches of two parts merged, held against the exact figures: distinct hashes within four
    standard errors, the largest bucket within the sketch's bound."""
    idx = materialize(build_index(_docs(spark, sf, extra=("lang", "source")), CHUNK, keep=("doc_id", "lang", "source")))
    path = work_path(spark, "sketches")
    write_sketches(idx.where("chunk_idx < 2"), path, "heads")
    write_sketches(idx.where("chunk_idx >= 2"), path, "rest")
    exact = content_distribution(idx).select(F.col("lang").alias("l"), F.col("source").alias("s"),
                                             F.col("n_distinct_hashes").alias("n_exact"), "largest_bucket")
    found = sketched_distribution(spark, path, 1)
    off = F.abs(F.col("n_distinct_hashes") - F.col("n_exact"))
    top_off = F.abs(F.col("top")[0]["count"] - F.col("largest_bucket"))
    return found.join(exact, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "lang", "source", "n_chunks", "n_bytes",
        (off <= F.greatest(F.lit(1.0), 4 * RELATIVE_ERROR * F.col("n_exact"))).alias("distinct_near"),
        (top_off <= ITEM_ERROR / MAX_ITEMS * F.col("n_chunks")).alias("largest_near"))


@register("top_buckets",
          f"SELECT * FROM (SELECT lang, hash, n_chunks, CAST(row_number() OVER (PARTITION BY lang "
          f"ORDER BY n_chunks DESC, hash) AS INTEGER) AS rank FROM (SELECT lang, hash, "
          f"CAST(count(*) AS BIGINT) AS n_chunks FROM ({IDX_LS}) i GROUP BY lang, hash) b) x "
          f"WHERE rank <= {TOP_N}")
def q_top_buckets(spark, sf):
    idx = build_index(_docs(spark, sf, extra=("lang",)), CHUNK, keep=("doc_id", "lang"))
    return top_buckets(idx, TOP_N)


@register("incremental_index", IDX)
def q_incremental(spark, sf):
    from .streaming.incremental import document_stream, incremental_index
    schema = read_table(spark, sf, "documents").schema
    # the table is one file or a folder of part files: a pattern names either (a plain path must be a folder)
    stream = document_stream(spark, f"{sf.rstrip('/')}/documents.parque[t]", schema)
    out, ckpt = work_path(spark, "stream-index"), work_path(spark, "stream-ckpt")
    q = incremental_index(stream, CHUNK, out, ckpt)
    q.awaitTermination()
    return read_index(spark, out, CHUNK).select(
        "doc_id", "chunk_size", "chunk_idx", "offset", "size", "n_words", "hash")


@register("incremental_append", IDX)
def q_incremental_append(spark, sf):
    """Even documents as a batch index; odd ones streamed into it in two runs of one stream."""
    from .streaming.incremental import document_stream, incremental_index
    docs = read_table(spark, sf, "documents")
    out, ckpt, inbox = (work_path(spark, n) for n in ("index", "stream-ckpt", "inbox"))
    even = F.col("doc_id") % 2 == 0
    write_index(build_index(load_documents(spark, sf).where(even), CHUNK), out)
    for third in (1, 3):
        docs.where(F.col("doc_id") % 4 == third).write.parquet(f"{inbox}/run={third}")
        stream = document_stream(spark, f"{inbox}/*", docs.schema)
        incremental_index(stream, CHUNK, out, ckpt).awaitTermination()
    return read_index(spark, out, CHUNK).select(
        "doc_id", "chunk_size", "chunk_idx", "offset", "size", "n_words", "hash")


# ---------------------------------------------------------------- exact first, hex, rejects

MIXED_Q = (f"SELECT query_id, min(hash) AS qhash FROM (SELECT 'd' || doc_id AS query_id, hash FROM ({IDX}) i "
           f"WHERE chunk_idx = 0 AND doc_id % 20 = 0 AND hash <> 0) x GROUP BY query_id")
MIXED_PAIRS = (f"SELECT q.query_id, c.doc_id, c.chunk_idx, c.\"offset\", c.size, c.hash, "
               f"CAST(bit_count(xor(c.hash, q.qhash)) AS INTEGER) AS distance "
               f"FROM ({IDX}) c JOIN ({MIXED_Q}) q ON bit_count(xor(c.hash, q.qhash)) <= {K}")


def _mixed_sql(key):
    return (f"SELECT query_id, doc_id, chunk_idx, \"offset\", size, hash, distance, "
            f"CASE WHEN distance = 0 THEN 'exact' ELSE 'fuzzy' END AS match_type FROM "
            f"(SELECT *, min(distance) OVER (PARTITION BY {key}) AS best FROM ({MIXED_PAIRS}) p) x "
            f"WHERE distance = 0 OR best > 0")


def _mixed(spark, sf, scope):
    """The query set (ids divisible by 20) against all rows: a query is the document's first chunk, exact
    there, in copies exact or near."""
    idx = _stored_index(spark, sf)
    q = (idx.where((F.col("chunk_idx") == 0) & (F.col("doc_id") % 20 == 0))
         .groupBy(F.concat(F.lit("d"), F.col("doc_id")).alias("query_id")).agg(F.min("hash").alias("qhash")))
    return lookup(idx, q, K, scope=scope)


@register("lookup_mixed_file", _mixed_sql("query_id, doc_id"))
def q_lookup_mixed_file(spark, sf):
    return _mixed(spark, sf, "file")


@register("lookup_mixed_corpus", _mixed_sql("query_id"))
def q_lookup_mixed_corpus(spark, sf):
    return _mixed(spark, sf, "corpus")


@register("search_exact_hits",
          f"SELECT 'd' || d.doc_id AS query_id, c.doc_id, c.chunk_idx FROM ({O.chunks(D, 300)}) c JOIN "
          f"(SELECT doc_id, content[301:600] AS t FROM ({D}) d0 WHERE octet_length(content) >= 600 "
          f"AND doc_id % 20 = 0) d ON c.chunk = d.t")
def q_search_exact_hits(spark, sf):
    """Texts cut from documents at aligned offsets, found again: the hits whose bytes agree."""
    docs = _docs(spark, sf)
    cut = docs.where((F.octet_length("content") >= 600) & (F.col("doc_id") % 20 == 0)) \
        .select(F.concat(F.lit("d"), F.col("doc_id")).alias("query_id"),
                F.substring("content", 301, 300).alias("bytes"))
    # the search hashes the text's bytes, so a cut inside a character stays as it is
    hits = search_corpus(docs, cut.withColumnRenamed("bytes", "text"), K, scope="file", exact_only=True)
    return hits.where(F.col("distance") == 0).alias("h").join(
        cut.alias("q"), (F.col("h.query_id") == F.col("q.query_id")) & (F.col("h.content") == F.col("q.bytes"))) \
        .select(F.col("h.query_id").alias("query_id"), "doc_id", "chunk_idx")


HEX_Q = (f"SELECT query_id, CASE WHEN query_id LIKE 'z%' THEN '0' WHEN query_id LIKE 'x%' THEN 'g' || h ELSE h END AS hex "
         f"FROM (SELECT CASE chunk_idx % 10 WHEN 8 THEN 'z' WHEN 9 THEN 'x' ELSE 'h' END || doc_id || '-' || chunk_idx AS query_id, "
         f"lower(hex(hash)) AS h FROM ({IDX}) i WHERE doc_id % 20 = 0) y")
HEX_P = f"SELECT query_id, hex, {O.hex_parse('hex')} AS qhash FROM ({HEX_Q}) x"


@register("lookup_hex",
          f"WITH p AS MATERIALIZED ({HEX_P}), m AS (SELECT p.query_id, count(*) AS n, min(bit_count(xor(c.hash, p.qhash))) AS best "
          f"FROM p JOIN ({IDX}) c ON bit_count(xor(c.hash, p.qhash)) <= {K} WHERE p.qhash <> 0 GROUP BY p.query_id) "
          f"SELECT p.query_id, p.qhash, CASE WHEN p.qhash IS NULL THEN 'invalid hash' WHEN p.qhash = 0 THEN "
          f"'simhash value is required' WHEN m.n IS NULL THEN 'no matches found' END AS reason, "
          f"CAST(m.best AS INTEGER) AS best FROM p LEFT JOIN m ON p.query_id = m.query_id")
def q_lookup_hex(spark, sf):
    """Hex texts of all chunks of the query set (ids divisible by 20; some broken, some zero) -> parsed,
    looked up in all rows, or given a reason."""
    idx = _stored_index(spark, sf)
    kind = F.when(F.col("chunk_idx") % 10 == 8, "z").when(F.col("chunk_idx") % 10 == 9, "x").otherwise("h")
    h = format_hex_hash("hash")
    q = idx.where(F.col("doc_id") % 20 == 0).select(
        F.concat(kind, F.col("doc_id"), F.lit("-"), F.col("chunk_idx")).alias("query_id"),
        F.when(kind == "z", "0").when(kind == "x", F.concat(F.lit("g"), h)).otherwise(h).alias("hex"))
    q = materialize(q.select("query_id", parse_hex_hash("hex").alias("qhash")))
    hits = materialize(lookup(idx, q, K, scope="corpus"))
    best = hits.groupBy("query_id").agg(F.min("distance").alias("best"))
    return (q.join(unmatched_queries(q, hits).select("query_id", "reason"), "query_id", "left")
            .join(best, "query_id", "left").select("query_id", "qhash", "reason", "best"))


@register("search_unanswered",
          "SELECT CAST(item_id AS VARCHAR) AS query_id, CASE item_id % 4 WHEN 0 THEN 'search text is missing' "
          "ELSE 'search text is empty' END AS reason FROM benchmark WHERE item_id % 4 < 2")
def q_search_unanswered(spark, sf):
    """Of the benchmark texts every fourth is missing and every fourth empty; the others occur."""
    i = F.col("item_id") % 4
    q = read_table(spark, sf, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"),
        F.when(i == 0, F.lit(None)).when(i == 1, "").otherwise(F.col("text")).alias("text"))
    return unanswered(q, search_corpus(load_documents(spark, sf, "benchmark", id_col="item_id"), q, K, with_content=False))


@register("chain_components",
          "WITH n AS (SELECT (doc_id * 7919 + 13) % 1000003 AS node, doc_id FROM documents) "
          "SELECT node, min(node) OVER () AS component FROM n")
def q_chain_components(spark, sf):
    """One chain through all documents (each to the next id there is), its numbers shuffled.

    A node is its number with the id, as ids a million apart share a number."""
    from pyspark.sql import Window as W

    from .plans.graph import connected_components
    d = read_table(spark, sf, "documents").select("doc_id")
    # ranges of ids, stored so that they are cut once; the next id is found within each, and the
    # ranges' ends are linked here (a row a partition)
    ids = stored(d.distinct().repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    following = F.lead(F.struct("doc_id")).over(W.partitionBy("part").orderBy("doc_id"))
    inside = ids.select(F.col("doc_id").alias("a"), following.alias("to")).where("to is not null") \
        .select("a", F.col("to.doc_id").alias("b"))
    ends = ids.groupBy("part").agg(F.min(F.struct("doc_id")).alias("first"), F.max(F.struct("doc_id")).alias("last")) \
        .orderBy("part").collect()
    across = spark.createDataFrame([(x["last"]["doc_id"], y["first"]["doc_id"]) for x, y in zip(ends, ends[1:])],
                                   inside.schema)

    def node(c):
        number = (F.col(c) * 7919 + 13) % 1000003
        return F.struct(number.isNull().alias("none"), number.alias("number"), F.col(c).alias("doc_id"))
    edges = inside.unionByName(across).select(node("a").alias("src"), node("b").alias("dst"))
    nodes = d.select(node("doc_id").alias("node"))
    found = connected_components(nodes, edges)
    return nodes.join(found, "node").select(F.col("node.number").alias("node"),
                                            F.col("component.number").alias("component"))


# ---------------------------------------------------------------- raw files

FILE_DOCS = 512   # numbers of documents to a file
FILES_BLOB = (f"SELECT coalesce(source, 'none') || '/' || doc_id // {FILE_DOCS} AS doc_id, "
              f"encode(string_agg(text || chr(10), '' ORDER BY doc_id)) AS content "
              f"FROM documents WHERE text IS NOT NULL GROUP BY coalesce(source, 'none'), doc_id // {FILE_DOCS}")
FILES_IDX = O.index(FILES_BLOB, CHUNK)


def _raw_files(spark, sf):
    """The documents as raw text files, several for each source."""
    path = work_path(spark, "files")
    docs = read_table(spark, sf, "documents").where("text is not null").select(
        F.coalesce("source", F.lit("none")).alias("source"), F.floor(F.col("doc_id") / FILE_DOCS).alias("file"), "doc_id", "text")
    (docs.repartition("source", "file").sortWithinPartitions("source", "file", "doc_id")
     .select("source", "file", "text").write.partitionBy("source", "file").text(path))
    return path


FILE_NAME = r"source=([^/]+)/file=([0-9]+)/"


def _file_name():
    return F.concat(F.regexp_extract("path", FILE_NAME, 1), F.lit("/"), F.regexp_extract("path", FILE_NAME, 2)).alias("source")


def _files_index(spark, sf):
    from .operators.index import index_chunks
    from .sources.file_source import read_chunks
    chunks = read_chunks(spark, _raw_files(spark, sf), CHUNK, recursive=True, range_bytes=64 * CHUNK)
    path = write_index(index_chunks(chunks), work_path(spark, "index"))
    return read_index(spark, path, CHUNK)


@register("files_index", f"SELECT doc_id AS source, chunk_idx, \"offset\", size, n_words, hash FROM ({FILES_IDX}) i")
def q_files_index(spark, sf):
    return _files_index(spark, sf).select(_file_name(), "chunk_idx", "offset", "size", "n_words", "hash")


@register("files_lookup_report",
          f"SELECT x.query_id, x.source, x.\"offset\", x.size, x.distance, "
          f"hex(f.content[x.\"offset\" + 1:x.\"offset\" + x.size]) AS content_hex FROM "
          f"(SELECT *, min(distance) OVER (PARTITION BY query_id, source) AS best FROM "
          f"(SELECT q.query_id, c.doc_id AS source, c.\"offset\", c.size, CAST(bit_count(xor(c.hash, q.qhash)) AS INTEGER) "
          f"AS distance FROM ({FILES_IDX}) c JOIN ({Q}) q ON bit_count(xor(c.hash, q.qhash)) <= {K} WHERE q.qhash <> 0) p) x "
          f"JOIN ({FILES_BLOB}) f ON f.doc_id = x.source WHERE x.distance = 0 OR x.best > 0")
def q_files_lookup_report(spark, sf):
    """Hits in raw files, with the file they are in and their bytes read from it."""
    from .sources.ranged_files import file_content
    idx = materialize(_files_index(spark, sf))
    hits = lookup(idx, _bench_queries(spark, sf), K)
    paths = idx.select("doc_id", "path").distinct()
    return file_content(hits.join(paths, "doc_id")).select(
        "query_id", _file_name(), "offset", "size", "distance",
        F.hex("content").alias("content_hex"))


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: search every benchmark text in the corpus (W1 per file), with content."""
    return q_search_text(spark, sf_dir)
