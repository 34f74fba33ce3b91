"""The corpus pipeline: STAGES over documents, each written and read again.

Language identification rejects what has no known language, exact and near duplicates leave one document of each group,
documents that a benchmark item leaks into go, and the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm.common import materialize, scratch, table
from tallyloom.llm.decontaminate import clean
from tallyloom.llm.exact_dedup import drop_duplicates
from tallyloom.llm.language_id import accepted
from tallyloom.llm.ngram_join import one_of_each
from tallyloom.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, by the text alone; the model is fitted on the labelled ones among docs."""
    return accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents, the one with the smallest doc_id."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no item of the benchmark leaks into."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in bins."""
    return pack(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("ngram_join", near), ("decontaminate", benchmark), ("packing", sequences)]
#: The language model, string tiling and packing have no SQL form; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:  # a stage's intermediate tables go once its result is written
            docs = materialize(stage(spark, docs, sf_dir), name, keep)
    return STAGES[-1][1](spark, docs, sf_dir)
