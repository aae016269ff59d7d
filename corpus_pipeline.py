"""Cleaning pipeline over ``documents``: stages that each write and reread their rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from connscore.llm import common as C
from connscore.llm import exact_dedup as _exact
from connscore.llm import near_dedup as _near
from connscore.llm import packing as _packing
from connscore.llm import quality as _quality
from connscore.llm import substring_dedup as _substring


#: Words that a worker keeps while packing; workers also hold what earlier stages left.
PACKING_CACHE = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is above their language's threshold go."""
    return _quality.kept_rows(spark, docs, C.table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return _exact.kept_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class stays."""
    return _near.kept_rows(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once are cut out of the texts; every row stays."""
    return _substring.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its sequence and its place there."""
    return _packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached=PACKING_CACHE)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]

#: Alignment, perplexity and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and reread."""
    docs = C.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = C.written(docs, f"stage-{i}-{name.replace(' ', '-')}")
    return docs
