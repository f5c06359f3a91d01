"""From raw documents to token ids in five stages, each an operator of ``simdex.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.  All
but the last return the columns of documents.

1. language_id: the random field is fitted on the labelled rows; a document it can't
   place (no letter, or a score under ``MIN_SCORE``) goes, ``lang`` becomes the prediction.
   Where no row is labelled nothing can be learned and only letterless texts go.
2. near_duplicates: of each group of linked texts the document of the smallest id stays.
3. pii: every span found is replaced by its kind's name.
4. mixing: a document comes once for each pass of the mix that takes all of it, and with
   its first words where a source's target ends inside it; untaken ones go.
5. bpe: the token ids of every text, with their number and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simdex.llm import bpe, jaccard_join, langid, mixing, pii
from simdex.llm.common import load
from simdex.operators.sizing import stored

MIN_SCORE = 0.4
TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = langid.fit(docs)
    if field is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = langid.identify(docs, field, keep=tuple(docs.columns))
    return (named.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= MIN_SCORE))
            .withColumn("lang", F.col("lang_pred")).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_copies(docs, jaccard_join.jaccard_join(docs))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_mix(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("pii", redact),
          ("mixing", mix), ("bpe", tokens)]

#: The random field, the trees and BPE can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
