"""The corpus pipeline: stages that clean, mix and encode ``documents``.

Each stage works on all rows its predecessor kept and returns them with the
columns of ``documents``; the last returns the token ids. Rows that are null,
empty or repeated are treated as the operators' docstrings say; an empty table
passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartwheel.llm import bpe, exact_dedup, langid, mixing, near_dedup
from cartwheel.llm.common import Scratch, table
from cartwheel.llm.queries import WORD_BPE

#: The language model, the signatures and the tokens have no SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose language the model rejects."""
    return langid.drop_rejected(docs, langid.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of equal texts."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every near-duplicate class."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by their sources' target weights, some of them twice."""
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, and the text they decode to."""
    return bpe.encode_decode(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each one's rows written and reread."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        done = scratch.write(stage(spark, docs, sf_dir), f"stage-{name}")
        if k:
            scratch.drop(docs)
        docs = done
    return docs
