"""Text search (W1, U4): chunk the corpus at the byte length of each query text,
fingerprint, and look up the query's SimHash exact-first.

One pass over the corpus: a task tokenises and hashes each document once, takes the
votes of the chunks of all query lengths from running sums
(``functions.chunk_votes``), compares them with the queries of their length (one by one, or by the
bands of ``hamming_join`` where these are many), and sends on hits only, with their bytes.  Lengths from a document's own size on share its one
chunk, so many distinct lengths cost no more than their chunks.  Nothing that doesn't match is written or
shuffled.  Queries go to the tasks in blocks of ``QUERY_BLOCK`` rows (a broadcast of
bounded size); more queries take more passes.

Texts that can't be searched (NULL or empty: the chunk length would be 0; hash 0) and
texts without a hit come out of ``unanswered`` with a reason.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.chunk_votes import WordBits, chunk_hashes
from ..functions.simhash import with_simhash
from ..functions.validate import DEFAULT_MAX_DISTANCE
from ..operators.hamming_join import BandTables, cell_bands
from ..operators.lookup import valid_queries
from ..operators.sizing import materialize, n_rows

QUERY_BLOCK = 400_000     # of some 30 bytes; each block is a pass over the corpus
_PAIRS = 1 << 18          # hash pairs compared at a time
FEW_QUERIES = 16          # of a length, up to which chunks are judged before their cut words are hashed
MANY_QUERIES = 1024       # of a length, from which on they are asked by bands, for several documents together
SORTED_HITS = 1 << 20     # of a document that are put in order together
OUT_BYTES, ROW_BYTES = 4 << 20, 400   # of hits that a task holds; what a row takes besides its text
WAITING_BYTES = 4 << 20   # of documents whose chunks are asked for together, and of these


def prepare_queries(queries: DataFrame, *, id_col: str = "query_id", text_col: str = "text",
                    method: str = "arrow") -> DataFrame:
    """``(query_id, chunk_size, qhash)``; chunk size = byte length of the text (or bytes).

    NULL and empty texts have no hash; ``unanswered`` reports them.
    """
    raw = F.col(text_col)
    if queries.schema[text_col].dataType.simpleString() != "binary":
        raw = F.encode(raw, "UTF-8")
    q = (queries.where(F.col(text_col).isNotNull())
         .select(F.col(id_col).alias("query_id"), raw.alias("__qbytes"))
         .where(F.octet_length("__qbytes") > 0))
    q = with_simhash(q, "__qbytes", "qhash", n_features_col=None, method=method)
    return q.select("query_id", F.octet_length("__qbytes").cast("int").alias("chunk_size"), "qhash")


def _hits(content: bytes, lengths: np.ndarray, first: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, k: int,
          bits: WordBits, left: list[tuple[np.ndarray, ...]] | None = None) -> list[tuple[np.ndarray, ...]]:
    """``(query numbers, lengths, chunk numbers, hashes, distances)`` of one document, in parts.

    Queries are in the order of their sizes; those of ``lengths[i]`` start at ``first[i]``.  Given ``left``, chunks that meet
    the queries of one length only, ``MANY_QUERIES`` or more, go there: ``(numbers of lengths, chunk numbers, hashes)``."""
    def maybe(number: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
        """Whether any query of a chunk's length may lie within k of it."""
        keep = np.zeros(len(number), bool)
        asked = first[number + 1] - first[number]
        for t in range(int(asked.max(initial=0))):
            q = hashes[np.minimum(first[number] + t, len(hashes) - 1)].view(np.uint64)
            keep |= (t < asked) & (np.bitwise_count((q & zeros) | (~q & ones)) <= k)
        return keep
    few = len(lengths) and np.diff(first).max() <= FEW_QUERIES
    out = []
    for number, chunk, h in chunk_hashes(content, lengths, bits, maybe if few else None):
        # a chunk meets the queries of its length; the whole text those of all lengths from its own on
        upto = np.where(lengths[number] >= len(content), len(sizes), first[number + 1])
        if left is not None:
            many = (upto == first[number + 1]) & (upto - first[number] >= MANY_QUERIES)
            if many.any():
                left.append((number[many], chunk[many], h[many]))
                number, chunk, h, upto = (v[~many] for v in (number, chunk, h, upto))
        total = np.cumsum(upto - first[number])
        done = 0
        while done < len(number):
            before = int(total[done - 1]) if done else 0
            end = max(done + 1, int(np.searchsorted(total, before + _PAIRS, "right")))
            count = np.diff(total[done:end], prepend=before)
            row = np.repeat(np.arange(done, end), count)
            q = np.arange(len(row)) - np.repeat(total[done:end] - count - before, count) + first[number[row]]
            d = np.bitwise_count((h[row] ^ hashes[q]).view(np.uint64))
            hit = np.nonzero(d <= k)[0]
            if len(hit):
                out.append((q[hit], sizes[q[hit]], chunk[row[hit]], h[row[hit]], d[hit]))
            done = end
    return out


def _kept(hits: list[tuple[np.ndarray, ...]], scope: str, n_queries: int) -> list[tuple[np.ndarray, ...]]:
    """One document's hits; in the scope of a file a query with an exact hit there has exact hits only."""
    if scope != "file" or not hits:
        return hits
    exact = np.zeros(n_queries, bool)
    for q, _, _, _, d in hits:
        exact[q[d == 0]] = True
    return [tuple(c[keep] for c in part) for part in hits if (keep := (part[4] == 0) | ~exact[part[0]]).any()]


def _by_place(parts: list[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """One document's hits by their offsets, ``SORTED_HITS`` or so at a time.  Pieces of a text that overlap then follow each
    other, which takes less room where rows are stored compressed."""
    at = 0
    while at < len(parts):
        end, held = at, 0
        while end < len(parts) and (end == at or held + len(parts[end][0]) <= SORTED_HITS):
            held += len(parts[end][0])
            end += 1
        q, n, c, h, d = (np.concatenate(v) for v in zip(*parts[at:end]))
        order = np.lexsort((n, c * n))
        yield q[order], n[order], c[order], h[order], d[order]
        at = end


class ManyQueries:
    """The queries of one length, to be asked by bands for the chunks of some documents together."""

    def __init__(self, hashes: np.ndarray, k: int):
        self.distinct, self.of = np.unique(hashes, return_inverse=True)
        self.bands = BandTables(hashes, k, cell_bands(k, len(hashes), len(hashes)))

    def hits(self, doc: np.ndarray, h: np.ndarray, scope: str) -> Iterator[tuple[np.ndarray, ...]]:
        """``(places of chunks, places of queries, distances)`` for chunks of documents ``doc``, all of a document's, and
        hashes ``h``; by the rule of ``_kept``, in parts."""
        n = len(self.distinct)
        at = np.minimum(np.searchsorted(self.distinct, h), n - 1)
        exact = np.unique((doc * n + at)[self.distinct[at] == h])
        exact = np.append(exact, np.iinfo(np.int64).max)
        for i, j, d in self.bands.near(h):
            if scope == "file":
                code = doc[i] * n + self.of[j]
                keep = np.nonzero((d == 0) | (exact[np.searchsorted(exact, code)] != code))[0]
                i, j, d = i[keep], j[keep], d[keep]
            yield i, j, d


def _answers(batches: Iterator[pa.RecordBatch], ids: list, sizes: np.ndarray, hashes: np.ndarray, k: int, scope: str,
             id_type: str, most: int = OUT_BYTES, exact_only: bool = False) -> Iterator[pa.RecordBatch]:
    """Hits of the queries in batches of documents, sent on before they come to more than ``most`` bytes and a row."""
    lengths, first = np.unique(sizes, return_index=True)
    first = np.append(first, len(sizes))
    bits = WordBits()
    out, held = [], 0
    many: dict[int, ManyQueries] = {}
    # chunks that wait to be asked for together, and their documents
    waiting, texts, size = [], [], 0

    def flush():
        nonlocal out, held
        cols, out, held = (list(zip(*out)) if out else [[]] * 10), [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          ["chunk_size", "query_id", "doc_id", "chunk_idx", "offset", "size",
                                           "hash", "distance", "match_type", "content"])
    kinds = [pa.int32(), None, pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(),
             pa.string(), pa.binary()]
    kinds[1] = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    def send(of: list[tuple], t, q, n, c, h, d) -> Iterator[pa.RecordBatch]:
        nonlocal held
        if exact_only:
            t, q, n, c, h, d = (v[d == 0] for v in (t, q, n, c, h, d))
        for t, q, n, c, h, d in zip(*(x.tolist() for x in (t, q, n, c, h, d))):
            doc, raw = of[t]
            piece = raw[c * n:(c + 1) * n]
            out.append((n, ids[q], doc, c, c * n, len(piece), h, d, "fuzzy" if d else "exact", piece))
            held += ROW_BYTES + len(piece)
            if held >= most:      # hits and their bytes are sent on as they come
                yield flush()

    def ask() -> Iterator[pa.RecordBatch]:
        nonlocal waiting, texts, size
        rows, of = [np.concatenate(v) for v in zip(*waiting)], texts
        waiting, texts, size = [], [], 0
        for number in np.unique(rows[1]).tolist():
            t, _, c, h = (v[rows[1] == number] for v in rows)
            if number not in many:
                many[number] = ManyQueries(hashes[first[number]:first[number + 1]], k)
            for i, j, d in many[number].hits(t, h, scope):
                yield from send(of, t[i], j + first[number], np.full(len(i), lengths[number]), c[i], h[i], d)
    for batch in batches:
        for doc, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = content.as_py()
            if not raw:
                continue
            left: list[tuple[np.ndarray, ...]] = []
            hits = _hits(raw, lengths, first, sizes, hashes, k, bits, left)
            for part in _by_place(_kept(hits, scope, len(sizes))):
                yield from send([(doc, raw)], np.zeros(len(part[0]), np.int64), *part)
            if left:
                waiting += [(np.full(len(v[0]), len(texts)), *v) for v in left]
                texts.append((doc, raw))
                size += len(raw) + ROW_BYTES * sum(len(v[0]) for v in left)
                if size >= WAITING_BYTES:
                    yield from ask()
    if waiting:
        yield from ask()
    yield flush()


def _search_block(docs: DataFrame, rows: pa.Table, k: int, scope: str, id_type: str, exact_only: bool = False) -> DataFrame:
    """Hits of one block of queries in every document."""
    ids = rows.column("query_id").to_pylist()
    sizes, hashes = (rows.column(c).to_numpy().astype(np.int64) for c in ("chunk_size", "qhash"))
    order = np.argsort(sizes, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast(([ids[i] for i in order], sizes[order], hashes[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answers(batches, *shared.value, k, scope, id_type, exact_only=exact_only)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "content").mapInArrow(
        run, f"chunk_size int, query_id {id_type}, doc_id bigint, chunk_idx int, offset bigint, size int, "
             "hash bigint, distance int, match_type string, content binary")


def search_corpus(docs: DataFrame, queries: DataFrame, k: int = DEFAULT_MAX_DISTANCE, *,
                  scope: str = "corpus", id_col: str = "query_id", text_col: str = "text",
                  with_content: bool = True, method: str = "arrow",
                  block_rows: int = QUERY_BLOCK, exact_only: bool = False) -> DataFrame:
    """U4 (W1 for one query): hits of every query text in every document.

    ``exact_only`` gives what ``where(distance = 0)`` leaves of them: the search is the same, the other hits stay in its tasks."""
    if scope not in ("file", "corpus"):
        raise ValueError(f"unknown scope {scope!r}")
    ids = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("text"))
    id_type = ids.schema["query_id"].dataType.simpleString()
    if id_type not in ("bigint", "int", "string"):
        ids, id_type = ids.withColumn("query_id", F.col("query_id").cast("string")), "string"
    q = materialize(valid_queries(prepare_queries(ids, method=method)))
    n_blocks = max(1, -(-n_rows(q) // block_rows))
    parts = []
    for b in range(n_blocks):
        rows = q.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == b).toArrow()
        parts.append(_search_block(docs, rows, k, scope, id_type, exact_only))
    hits = reduce(DataFrame.unionByName, parts)
    if scope == "corpus":
        hits = materialize(hits)
        best = hits.groupBy("query_id").agg(F.min("distance").alias("__best"))
        hits = hits.join(best, "query_id").where((F.col("distance") == 0) | (F.col("__best") > 0)) \
            .select(*hits.columns)
    return hits.withColumn("text", F.col("content").cast("string")) if with_content else hits.drop("content")


def search_text(docs: DataFrame, text: str, k: int = DEFAULT_MAX_DISTANCE, *,
                scope: str = "file", with_content: bool = True, method: str = "arrow") -> DataFrame:
    """One search text over every document (each document is one "file")."""
    spark = docs.sparkSession
    queries = spark.createDataFrame([("q0", text)], "query_id string, text string")
    return search_corpus(docs, queries, k, scope=scope, with_content=with_content, method=method)


def unanswered(queries: DataFrame, hits: DataFrame, *, id_col: str = "query_id", text_col: str = "text",
               method: str = "arrow") -> DataFrame:
    """``(query_id, reason)`` of every search text that has no hit, rejected ones included."""
    q = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("text"))
    empty = q.where(F.coalesce(F.octet_length("text"), F.lit(0)) == 0).select(
        "query_id", F.when(F.col("text").isNull(), "search text is missing").otherwise("search text is empty")
        .alias("reason"))
    hashed = prepare_queries(q, method=method)
    zero = hashed.where(F.col("qhash") == 0).select("query_id", F.lit("simhash value is required").alias("reason"))
    rest = valid_queries(hashed).join(hits.select("query_id").distinct(), "query_id", "left_anti") \
        .select("query_id", F.lit("no matches found").alias("reason"))
    return empty.unionByName(zero).unionByName(rest)
