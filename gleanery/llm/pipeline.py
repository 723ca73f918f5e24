"""The corpus pipeline: quality rules, toxicity, near copies, repeated passages, packing.

Every stage takes documents with any further columns and gives them back; only the last gives pieces. Null texts count as empty
ones and go with the quality rules; rows that repeat an id are judged one by one until one of them stays of each group of near
copies; an empty table goes through empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import jaccard, packing, quality, substring, toxicity
from .common import discard_stored, stored, stored_count, table
from .queries import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; every labelled document of the input may teach."""
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.one_of_each(docs, jaccard.near_duplicates(docs))


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds."""
    return substring.remove_passages(docs, substring.repeated_passages(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequence and place in it."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), 2048, 0)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("substring dedup", passages_stage),
    ("best-fit packing", packing_stage),
]

#: Signatures, chains and tokenizers are beyond SQL; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again, and what led to it is deleted then."""
    docs, mark = table(spark, sf_dir, "documents"), stored_count()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard_stored(spark, mark, keep=1)
    return docs
