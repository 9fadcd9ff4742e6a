"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Between stages the rows are written as Parquet and read again.

Defined results, for every stage: a null text counts as an empty one and stays null where it is kept; rows that share a doc_id stay or
go each by its own text, but for near duplicates, where a doc_id stays or goes as a whole; an empty table gives an empty
table; further columns pass through, whatever their names. doc_id is a whole number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import decontaminate, ngram_join, packing, quality, suffix_dedup
from footfall.session import discard, materialize, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return ngram_join.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller doc_id has are cut out of the text."""
    return suffix_dedup.clean(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4096 tokens."""
    return packing.digest(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the trained classifier and the tokenizer; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; of a finished stage nothing but its output stays on disk, and that until the next one is written."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(materialize(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
