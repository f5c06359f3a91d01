"""Document deduplication.

Each document gets one SimHash over its 3-word shingles (single words are too
coarse for whole documents).  Documents with equal fingerprints form exact
groups, represented by their smallest ``doc_id``; the Hamming join runs on the
distinct fingerprints only.  Pairs are emitted as

* ``member -> representative`` edges for each exact group (linear in the group,
  never all pairs inside it), and
* ``representative -> representative`` pairs for distinct fingerprints within k.

Wordless documents (no features; all share hash -1) are left out of the pairs.

Groups (U2) need no pairs, only enough links: ``near_links`` first hangs every hash on one
representative for each of its bands (four rows a hash, each link checked on all bits), and
then looks for pairs within k whose hashes lie in *different* groups so far, of which a hash keeps one
for each group it meets.  So links grow with the hashes of a near group, not with its square, and the
components are the same as those of all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.simhash import DEFAULT_WORD_PATTERN, with_simhash, word_features
from ..functions.hexcodec import hamming
from ..operators.hamming_join import hamming_pairs, layout
from ..operators.sizing import materialize, stored
from .graph import connected_components
from .weighted import weighted_fingerprints

DEFAULT_DEDUP_DISTANCE = 10


def document_fingerprints(docs: DataFrame, *, features: str = "shingle", shingle_n: int = 3,
                          word_pattern: str = DEFAULT_WORD_PATTERN,
                          method: str = "arrow") -> DataFrame:
    """``(doc_id, n_features, hash)`` for every document; ``features``: 'shingle', 'word' or 'weighted'
    (words by their rarity in ``docs``, see plans/weighted)."""
    if features == "weighted":
        return weighted_fingerprints(docs.select("doc_id", "content"), word_pattern=word_pattern)
    fp = with_simhash(docs.select("doc_id", "content"), "content", features=features,
                      shingle_n=shingle_n, word_pattern=word_pattern,
                      n_features_col="n_features", method=method)
    return fp.select("doc_id", "n_features", "hash")


def near_duplicate_pairs(docs: DataFrame, k: int = DEFAULT_DEDUP_DISTANCE, *,
                         features: str = "shingle", shingle_n: int = 3,
                         word_pattern: str = DEFAULT_WORD_PATTERN, with_jaccard: bool = True,
                         method: str = "arrow", strategy: str = "auto") -> DataFrame:
    """``(doc_a, doc_b, hash_a, hash_b, distance, kind[, jaccard])`` with doc_a < doc_b."""
    # wordless documents all share hash -1; they are left out
    fp = materialize(document_fingerprints(docs, features=features, shingle_n=shingle_n,
                                           word_pattern=word_pattern, method=method)
                     .where(F.col("n_features") > 0).select("doc_id", "hash"))
    groups = materialize(fp.groupBy("hash").agg(F.min("doc_id").alias("rep")))
    exact = (fp.join(groups, "hash").where(F.col("doc_id") != F.col("rep"))
             .select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"),
                     F.col("hash").alias("hash_a"), F.col("hash").alias("hash_b"),
                     F.lit(0).alias("distance"), F.lit("exact").alias("kind")))
    left = groups.select("hash", F.col("rep").alias("rep_l"))
    right = groups.select(F.col("hash").alias("qhash"), F.col("rep").alias("rep_r"))
    near = (hamming_pairs(left, right, k, strategy=strategy, ordered=("rep_l", "rep_r"))
            .select(F.col("rep_l").alias("doc_a"), F.col("rep_r").alias("doc_b"),
                    F.col("hash").alias("hash_a"), F.col("qhash").alias("hash_b"),
                    "distance", F.lit("near").alias("kind")))
    pairs = materialize(exact.unionByName(near))
    if not with_jaccard:
        return pairs
    # only documents that occur in a pair are tokenised, once
    paired = pairs.select(F.col("doc_a").alias("doc_id")) \
        .unionByName(pairs.select(F.col("doc_b").alias("doc_id"))).distinct()
    words = materialize(docs.join(paired, "doc_id", "left_semi").select(
        "doc_id", F.array_distinct(word_features("content", word_pattern)).alias("w")))
    joined = (pairs.join(words.select(F.col("doc_id").alias("doc_a"), F.col("w").alias("wa")), "doc_a")
              .join(words.select(F.col("doc_id").alias("doc_b"), F.col("w").alias("wb")), "doc_b"))
    inter = F.size(F.array_intersect("wa", "wb"))
    union = F.size("wa") + F.size("wb") - inter
    jac = F.when(union == 0, F.lit(1.0)).otherwise(inter / union)
    return joined.select("doc_a", "doc_b", "hash_a", "hash_b", "distance", "kind",
                         F.round(jac, 6).alias("jaccard"))


def near_links(hashes: DataFrame, k: int = DEFAULT_DEDUP_DISTANCE, *, strategy: str = "auto") -> DataFrame:
    """``hashes(hash)``, distinct -> ``(a, b)``: links within k that connect what all pairs within k do."""
    hashes = materialize(hashes)
    links = None
    for bands in (4, 3):
        values = [F.struct(F.lit(j).alias("j"), F.shiftrightunsigned("hash", start).bitwiseAND(F.lit((1 << width) - 1)).alias("v"))
                  for j, (start, width, _) in enumerate(layout(bands, 0))]
        rows = hashes.select("hash", F.explode(F.array(*values)).alias("band")).select("hash", "band.j", "band.v")
        reps = stored(rows.groupBy("j", "v").agg(F.min("hash").alias("rep")), "reps")
        star = rows.join(reps, ["j", "v"]).where((F.col("hash") != F.col("rep")) & (hamming("hash", "rep") <= k)) \
            .select(F.col("hash").alias("a"), F.col("rep").alias("b"))
        links = star if links is None else links.unionByName(star)
    links = materialize(links.distinct())
    groups = connected_components(hashes.select(F.col("hash").alias("node")), links, src="a", dst="b")
    groups = materialize(groups.select(F.col("node").alias("hash"), F.col("component").alias("g")))
    other = materialize(groups.select(F.col("hash").alias("qhash"), F.col("g").alias("qg")))
    across = hamming_pairs(groups, other, k, strategy=strategy, ordered=("g", "qg"))
    across = across.groupBy("hash", "qg").agg(F.min("qhash").alias("b")).select(F.col("hash").alias("a"), "b")
    return links.unionByName(across)


def dedup_documents(docs: DataFrame, k: int = DEFAULT_DEDUP_DISTANCE, *,
                    features: str = "shingle", shingle_n: int = 3,
                    method: str = "arrow", strategy: str = "auto") -> DataFrame:
    """``(doc_id, group_id, group_size, keep)``; a group is a connected set of U1
    pairs (found by ``near_links``), ``group_id`` its smallest doc_id, and only that document is kept."""
    fp = materialize(document_fingerprints(docs, features=features, shingle_n=shingle_n, method=method)
                     .where(F.col("n_features") > 0).select("doc_id", "hash"))
    groups = materialize(fp.groupBy("hash").agg(F.min("doc_id").alias("rep")))
    links = near_links(groups.select("hash"), k, strategy=strategy)
    exact = fp.join(groups, "hash").where(F.col("doc_id") != F.col("rep")) \
        .select(F.col("rep").alias("doc_a"), F.col("doc_id").alias("doc_b"))
    near = (links.join(groups.select(F.col("hash").alias("a"), F.col("rep").alias("doc_a")), "a")
            .join(groups.select(F.col("hash").alias("b"), F.col("rep").alias("doc_b")), "b").select("doc_a", "doc_b"))
    nodes = docs.select(F.col("doc_id").alias("node"))
    comp = connected_components(nodes, exact.unionByName(near), src="doc_a", dst="doc_b")
    sizes = comp.groupBy("component").agg(F.count("*").cast("bigint").alias("group_size"))
    return (comp.join(sizes, "component")
            .select(F.col("node").alias("doc_id"), F.col("component").alias("group_id"),
                    "group_size", (F.col("node") == F.col("component")).alias("keep")))


def drop_duplicates(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Documents that survive deduplication."""
    return docs.join(groups.where("keep").select("doc_id"), "doc_id", "left_semi")
