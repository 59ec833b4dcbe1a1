"""Corpus pipeline: toxicity filter, exact dedup, near-duplicate dedup, source mixing, piece sampling.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``. ``run`` applies them to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm.common import free, read_table, written
from hearth.llm.op3_toxicity import drop_toxic
from hearth.llm.op6_exact import drop_duplicates
from hearth.llm.op7_pieces import sample_encodings
from hearth.llm.op8_jaccard import drop_near_duplicates
from hearth.llm.op10_mix import mixed_documents


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; learned from the labelled rows among ``docs``."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times)."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every row."""
    return sample_encodings(docs)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

# The fitted classifier and the sampled segmentations have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        free(before)  # the stage before has been read to its end
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
