"""A corpus made ready for training: quality rules, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns of `documents`; nulls, repeats and empty tables are
treated as each stage's operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waymeter.llm import bagminhash, packing, quality, toxicity
from waymeter.llm.queries import WORD_BPE, learns_toxicity, table
from waymeter.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what base rules and adaptive fences keep."""
    return quality.kept(docs)


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what is not predicted toxic, learnt from the labels of the documents at hand."""
    return toxicity.kept(docs, table(spark, sf_dir, "labels"), learns_toxicity)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return bagminhash.kept(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, with their ids."""
    return packing.pieces(docs, public_tokenizers.path(WORD_BPE), narrow=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_texts),
    ("minhash_near_dedup", near_duplicates),
    ("packing", pack),
]

#: The learnt stage and the tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
