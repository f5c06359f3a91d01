"""Document fingerprints whose words are weighted by their rarity in the corpus (U1's log(N/df)).

A word of N documents' corpus that df of them hold weighs floor(1000 * ln(N / df)) for each of its
occurrences: whole numbers, so votes add up alike in any order.  A word is known by its 64-bit hash.

The counts are corpus tables, and no row of them stands for one word of one document.  A task reads
a text once and keeps its words with their counts as two arrays.  A block of some documents adds up how
many of them hold each of its distinct words and asks for the weights of these, so
a word moves once a block however many of the documents hold it; the votes are added up in the
blocks.  A word that more than ``HOT_ROWS`` documents hold is asked for by nearly every block; such
words are few and are joined first, broadcast while their size is small.

Defined results: null and wordless contents have no features and hash -1; a word that all documents
hold weighs nothing, and a document of such words alone has hash -1, too (ties give 1).
``doc_id`` tells documents apart: rows that share one are one document (each row gets its fingerprint),
and those without one count as a document together, whose rows have no features.
"""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.simhash import (DEFAULT_WORD_PATTERN, NO_FEATURES_HASH, _made_once, weighted_vote,
                                 word_features)
from ..operators.sizing import join_small, n_rows, stored

# Ship this module's code with its functions, so Python workers need no package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass

UNIT = 1000            # of the weights' fixed point
HOT_ROWS = 100_000     # documents that hold a word from which on it is joined apart
BLOCK_TERMS = 250_000  # words of the documents of a block, each counted once a document, about
CACHE_WORDS = 400_000  # words whose hashes a task remembers at a time
SLICE_TEXT = 64        # texts whose words are out of Arrow at a time

# A-Z in lower case, what is no part of a word (bytes of other letters, too) as a blank
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b == 95 else 32
                    for b in range(256))


class WordHashes(dict):
    """The 64-bit hashes of words, remembered: the first eight bytes of their md5."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.md5(word).digest()[:8], "big", signed=True)
        return h


def term_lists(docs: DataFrame, word_pattern: str = DEFAULT_WORD_PATTERN) -> DataFrame:
    """``(doc_id, h, tf)`` of every row: its distinct word hashes and how often it holds each."""
    plain = word_pattern == DEFAULT_WORD_PATTERN
    source = docs.select("doc_id", F.col("content").cast("binary").alias("w")) if plain else \
        _made_once(docs.select("doc_id", "content"), "w", word_features("content", word_pattern)).select("doc_id", "w")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_TEXT):
                ids, texts = (c.slice(at, SLICE_TEXT) for c in batch.columns)
                upto, hs, tfs = [0], [], []
                for text in texts.to_pylist():
                    words = [] if text is None else text.translate(_WORD_BYTES).split() if plain else [w.encode() for w in text]
                    found = Counter(words)
                    keys = [hashes[word] for word in found]
                    if len(set(keys)) < len(keys):           # words of one hash are one word
                        one: Counter = Counter()
                        for h, n in zip(keys, found.values()):
                            one[h] += n
                        keys, found = list(one), one
                    hs += keys
                    tfs += found.values()
                    upto.append(len(hs))
                upto = pa.array(upto, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(upto, pa.array(hs, pa.int64())),
                     pa.ListArray.from_arrays(upto, pa.array(tfs, pa.int64()))], ["doc_id", "h", "tf"])
    return source.mapInArrow(run, f"doc_id {kind}, h array<bigint>, tf array<bigint>")


def by_document(lists: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``term_lists`` made one a document, and the words of the document without id (None: no such)."""
    repeated = stored(lists.groupBy("doc_id").agg(F.count("*").alias("rows"))
                      .where((F.col("rows") > 1) | F.col("doc_id").isNull()).select("doc_id"), "repeated")
    if not n_rows(repeated):
        return lists, None
    marked = join_small(lists.where(F.col("doc_id").isNotNull()),
                        repeated.where(F.col("doc_id").isNotNull()).withColumn("again", F.lit(True)), "doc_id", "left")
    terms = marked.where("again").drop("again").unionByName(lists.where(F.col("doc_id").isNull())) \
        .select("doc_id", F.explode(F.arrays_zip("h", "tf")).alias("t")) \
        .groupBy("doc_id", F.col("t.h").alias("h")).agg(F.sum("t.tf").alias("tf"))
    terms = stored(terms, "terms")
    # a list holds the distinct words of one document, which is a row already
    whole = terms.where(F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.collect_list(F.struct("h", "tf")).alias("t")).select("doc_id", "t.h", "t.tf")
    return stored(marked.where("again is null").drop("again").unionByName(whole), "documents"), \
        terms.where(F.col("doc_id").isNull()).select("h")


def word_weights(words: DataFrame, n_docs: int) -> DataFrame:
    """``(h, df, weight)`` of the word hashes of ``words(h, n)``, which n documents each hold."""
    return words.groupBy("h").agg(F.sum("n").alias("df")) \
        .withColumn("weight", F.floor(F.lit(float(UNIT)) * F.log(F.lit(float(n_docs)) / F.col("df"))).cast("bigint"))


def term_blocks(lists: DataFrame) -> DataFrame:
    """Documents in blocks: ``(block, doc_id, upto, which, tf, words, n)``, where a document's words are the places
    ``which[upto[i]:upto[i + 1]]`` of the block's distinct ``words``, which ``n`` of its documents hold."""
    kind = lists.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, held, n = TaskContext.get().partitionId() << 32, [], [], 0

        def row():
            nonlocal block, ids, held, n
            block += 1
            sizes = np.concatenate([s for s, _, _ in held])
            words, which = np.unique(np.concatenate([h for _, h, _ in held]), return_inverse=True)
            arrays = [pa.concat_arrays(ids), pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                      pa.array(which.astype(np.int32)), pa.array(np.concatenate([t for _, _, t in held])), pa.array(words),
                      pa.array(np.bincount(which, minlength=len(words)))]
            ids, held, n = [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in arrays)],
                ["block", "doc_id", "upto", "which", "tf", "words", "n"])
        for batch in batches:
            size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(size), 0
            while at < len(size):
                # as many documents as the block has room for, one at least
                before = int(ends[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(ends, before + BLOCK_TERMS - n, "right")))
                ids.append(batch.column(0).slice(at, end - at))
                held.append((size[at:end], *(batch.column(c).slice(at, end - at).flatten()
                                             .to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))))
                n += int(ends[end - 1]) - before
                at = end
                if n >= BLOCK_TERMS or at < len(size):
                    yield row()
        if held:
            yield row()
    return lists.select("doc_id", "h", "tf").mapInArrow(
        run, f"block bigint, doc_id array<{kind}>, upto array<int>, which array<int>, tf array<bigint>, "
             "words array<bigint>, n array<bigint>")


def vote_blocks(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """``(doc_id, n_features, hash)`` of the documents of ``term_blocks``; ``found(block, at, weight)`` has the
    weights of a block's words."""
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    lists = found.groupBy("block").agg(F.collect_list(F.struct("at", "weight")).alias("f")) \
        .select("block", "f.at", "f.weight")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, upto, which, tf, words, at, weight = (batch.column(c)[i].values for c in batch.schema.names)
                upto, which, tf = (c.to_numpy() for c in (upto, which, tf))
                each = np.zeros(len(words), np.int64)
                if at is not None:
                    each[at.to_numpy()] = weight.to_numpy()
                hashes = weighted_vote(pa.ListArray.from_arrays(upto, words.take(pa.array(which))),
                                       pa.ListArray.from_arrays(upto, pa.array(each[which] * tf)))
                n = np.diff(np.append(0, np.cumsum(tf))[upto])
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(n.astype(np.int32)), pa.array(hashes)],
                                                 ["doc_id", "n_features", "hash"])
    return blocks.join(lists, "block", "left").select("doc_id", "upto", "which", "tf", "words", "at", "weight") \
        .mapInArrow(run, f"doc_id {kind}, n_features int, hash bigint")


def weighted_fingerprints(docs: DataFrame, *, word_pattern: str = DEFAULT_WORD_PATTERN,
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(doc_id, n_features, hash)`` for every document of ``docs(doc_id, content)``."""
    every = stored(term_lists(docs, word_pattern), "terms")
    lists, without_id = by_document(every)
    blocks = stored(term_blocks(lists), "blocks")
    words = blocks.select(F.explode(F.arrays_zip("words", "n")).alias("w")).select(F.col("w.words").alias("h"), "w.n")
    if without_id is not None:
        words = words.unionByName(without_id.withColumn("n", F.lit(1).cast("bigint")))
    weights = stored(word_weights(words, n_rows(every)), "weights")
    asked = blocks.select("block", F.posexplode("words").alias("at", "h"))
    hot = weights.where(F.col("df") > hot_rows).select("h", F.col("weight").alias("hot"))
    asked = join_small(asked, stored(hot, "hot-words"), "h", "left")
    rare = asked.where(F.col("hot").isNull()).drop("hot") \
        .join(weights.where(F.col("df") <= hot_rows).select("h", "weight"), "h")
    found = asked.where(F.col("hot").isNotNull()).withColumnRenamed("hot", "weight").unionByName(rare)
    hashed = vote_blocks(blocks, found.select("block", "at", "weight"))
    return docs.select("doc_id").join(hashed, "doc_id", "left").select(
        "doc_id", F.coalesce("n_features", F.lit(0)).alias("n_features"),
        F.coalesce("hash", F.lit(NO_FEATURES_HASH).cast("bigint")).alias("hash"))
