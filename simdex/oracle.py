"""DuckDB SQL that recomputes our operators, used as the correctness oracle.

The SQL follows the same definitions as the Spark code (see functions/simhash.py)
but is written independently in DuckDB's dialect: blob slices for chunks,
``CAST(blob AS VARCHAR)`` with its ``\\xNN`` escapes turned into spaces (they are
never part of an ASCII word), md5 prefixes as UBIGINT, and 64 per-bit list sums
for the vote.  Builders return SQL text; nothing here touches Spark.
"""

from __future__ import annotations

# Fixed values shared with the Spark side.
WORD_PATTERN = "[a-z0-9_]+"
TWO_63 = 9223372036854775808
TWO_64 = 18446744073709551616


def blob_words(blob: str) -> str:
    text = f"regexp_replace(CAST({blob} AS VARCHAR), '\\\\x[0-9A-F]{{2}}', ' ', 'g')"
    return f"regexp_extract_all(lower({text}), '{WORD_PATTERN}')"


def shingles(words: str, n: int = 3) -> str:
    return (f"CASE WHEN len({words}) = 0 THEN []::VARCHAR[] "
            f"WHEN len({words}) < {n} THEN [array_to_string({words}, ' ')] "
            f"ELSE list_transform(generate_series(1, len({words}) - {n - 1}), "
            f"lambda i: array_to_string({words}[i:i + {n - 1}], ' ')) END")


def feature_hashes(features: str) -> str:
    return f"list_transform({features}, lambda w: ('0x' || substr(md5(w), 1, 16))::UBIGINT)"


def _vote_unsigned(fh: str) -> str:
    terms = [f"CASE WHEN 2 * coalesce(list_sum(list_transform({fh}, "
             f"lambda x: ((x >> {i}) & 1)::INTEGER)), 0) >= len({fh}) "
             f"THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END" for i in range(64)]
    return "(" + " + ".join(terms) + ")"


def to_signed(u: str) -> str:
    return (f"CASE WHEN {u} >= {TWO_63}::UBIGINT THEN CAST(CAST({u} AS HUGEINT) - {TWO_64} AS BIGINT) "
            f"ELSE CAST({u} AS BIGINT) END")


def with_simhash(source: str, blob: str, keep: list[str], *, out: str = "hash",
                 features: str = "word", shingle_n: int = 3,
                 n_col: str | None = "n_words") -> str:
    """SELECT keep..., [n_col,] out FROM (source) computing the SimHash of ``blob``."""
    keep_s = ", ".join(keep)
    if features == "shingle":
        source = f"SELECT *, {blob_words(blob)} AS __w FROM ({source}) __s0"
        feats = shingles("__w", shingle_n)
    else:
        feats = blob_words(blob)
    inner = f"SELECT {keep_s}, {feature_hashes(feats)} AS __fh FROM ({source}) __s"
    mid = (f"SELECT {keep_s}, CAST(len(__fh) AS INTEGER) AS __n, {_vote_unsigned('__fh')} AS __u "
           f"FROM ({inner}) __f")
    n_sel = f", __n AS {n_col}" if n_col else ""
    return f"SELECT {keep_s}{n_sel}, {to_signed('__u')} AS {out} FROM ({mid}) __m"


def weighted_simhash(docs_sql: str) -> str:
    """doc_id, n_features, hash: words weighted by floor(1000 * ln(N / df)), 64 sums a document."""
    terms = (f"SELECT doc_id, h, count(*) AS tf FROM (SELECT doc_id, unnest({feature_hashes(blob_words('content'))}) AS h "
             f"FROM ({docs_sql}) __d) __e GROUP BY doc_id, h")
    bits = " + ".join(f"CASE WHEN sum(CASE WHEN ((h >> {i}) & 1) = 1 THEN w ELSE -w END) >= 0 "
                      f"THEN {1 << i}::UBIGINT ELSE 0::UBIGINT END" for i in range(64))
    return (f"WITH t AS MATERIALIZED ({terms}), n AS (SELECT count(*) AS n FROM ({docs_sql}) __d), "
            f"d AS (SELECT h, floor(1000 * ln((SELECT CAST(n AS DOUBLE) FROM n) / count(*)))::BIGINT AS weight FROM t GROUP BY h), "
            f"v AS (SELECT doc_id, CAST(sum(tf) AS INTEGER) AS n_features, {bits} AS u FROM "
            f"(SELECT t.doc_id, t.h, t.tf, t.tf * d.weight AS w FROM t JOIN d ON t.h = d.h) x GROUP BY doc_id) "
            f"SELECT b.doc_id, coalesce(n_features, 0) AS n_features, coalesce({to_signed('u')}, -1) AS hash "
            f"FROM ({docs_sql}) b LEFT JOIN v ON b.doc_id = v.doc_id")


def documents(table: str = "documents", id_col: str = "doc_id", text_col: str = "text",
              extra: tuple[str, ...] = ()) -> str:
    ex = "".join(f", {c}" for c in extra)
    return (f"SELECT CAST({id_col} AS BIGINT) AS doc_id, encode({text_col}) AS content{ex} "
            f"FROM {table} WHERE {text_col} IS NOT NULL")


def chunks(docs_sql: str, chunk_size: int, stride: int | None = None,
           extra: tuple[str, ...] = ()) -> str:
    """doc_id, extra..., chunk_size, chunk_idx, offset, size, chunk."""
    step = stride or chunk_size
    ex = "".join(f", {c}" for c in extra)
    exploded = (f"SELECT doc_id{ex}, content, unnest(range(0, octet_length(content), {step})) AS o "
                f"FROM ({docs_sql}) __d WHERE octet_length(content) > 0")
    return (f"SELECT doc_id{ex}, CAST({chunk_size} AS INTEGER) AS chunk_size, "
            f"CAST(o // {step} AS INTEGER) AS chunk_idx, CAST(o AS BIGINT) AS \"offset\", "
            f"CAST(octet_length(content[o + 1:o + {chunk_size}]) AS INTEGER) AS size, "
            f"content[o + 1:o + {chunk_size}] AS chunk FROM ({exploded}) __e")


INDEX_KEEP = ["doc_id", "chunk_size", "chunk_idx", "\"offset\"", "size"]


def index(docs_sql: str, chunk_size: int, stride: int | None = None,
          extra: tuple[str, ...] = ()) -> str:
    """doc_id, extra..., chunk_size, chunk_idx, offset, size, n_words, hash."""
    return with_simhash(chunks(docs_sql, chunk_size, stride, extra), "chunk",
                        INDEX_KEEP[:1] + list(extra) + INDEX_KEEP[1:])


def queries(table: str = "benchmark", id_col: str = "item_id", text_col: str = "text") -> str:
    """query_id, chunk_size (byte length), qhash of every non-empty query text."""
    src = (f"SELECT CAST({id_col} AS VARCHAR) AS query_id, encode({text_col}) AS qb FROM {table} "
           f"WHERE {text_col} IS NOT NULL AND octet_length(encode({text_col})) > 0")
    sim = with_simhash(src, "qb", ["query_id", "qb"], out="qhash", n_col=None)
    return f"SELECT query_id, CAST(octet_length(qb) AS INTEGER) AS chunk_size, qhash FROM ({sim}) __q"


def hex_parse(s: str) -> str:
    u = f"('0x' || {s})::UBIGINT"
    return (f"CASE WHEN regexp_full_match({s}, '0*[0-9a-fA-F]{{1,16}}') THEN {to_signed(u)} END")
