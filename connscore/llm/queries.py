"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from connscore.llm import ann as _ann
from connscore.llm import bpe as _bpe
from connscore.llm import common as C
from connscore.llm import conversation_repair as _repair
from connscore.llm import exact_dedup as _exact
from connscore.llm import jaccard_join as _jaccard
from connscore.llm import language_id as _language
from connscore.llm import lm as _lm
from connscore.llm import near_dedup as _near
from connscore.llm import packing as _packing
from connscore.llm import quality as _quality
from connscore.llm import sharding as _sharding
from connscore.llm import substring_dedup as _substring
from connscore.llm import whitening as _whitening


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _exact.exact_dedup(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpe.round_trip(C.table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language.language_id(C.table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.shard(C.table(spark, sf_dir, "documents"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ann.nearest(C.table(spark, sf_dir, "embeddings"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lm.score(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _near.near_dedup(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.classify(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(C.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _substring.substring_dedup(C.table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whitening.whiten(C.table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repair.repair(_repair.damaged(C.table(spark, sf_dir, "conversations")), "gone")


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.jaccard_components(C.table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_language_id": op3_language_id,
    "op4_sharding": op4_sharding,
    "op5_nearest": op5_nearest,
    "op6_lm_score": op6_lm_score,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_whitening": op11_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_jaccard_join": op13_jaccard_join,
}
