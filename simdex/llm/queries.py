"""The registered queries of this folder: one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, html_text, importance, jaccard_join, langid, lm_score, mixing, pii, quality, suffix_dedup, token_counts
from .common import load

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(load(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(load(spark, sf_dir, "pages"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(load(spark, sf_dir, "documents")).drop("row", "class")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).drop("source")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(load(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).drop("failed_rule")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.sentence_pieces(public_tokenizers.path(PIECES))
    return token_counts.token_counts(load(spark, sf_dir, "documents"), pieces)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(load(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(load(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                           public_tokenizers.path(PIECES))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_score(load(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ann": op2_ann,
    "op3_html": op3_html,
    "op4_jaccard": op4_jaccard,
    "op5_mixing": op5_mixing,
    "op6_pii": op6_pii,
    "op7_langid": op7_langid,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_bpe": op10_bpe,
    "op11_alignment": op11_alignment,
    "op12_lm_score": op12_lm_score,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {
    "op5_mixing": mixing.ORACLE_SQL,
    "op13_importance": importance.ORACLE_SQL,
}
