"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from footfall.llm import (
    chat,
    decontaminate,
    fingerprint,
    html_extract,
    mixing,
    ngram_join,
    packing,
    quality,
    resample,
    search,
    shards,
    suffix_dedup,
    warc,
)
from footfall.llm.oracle import CHAT_SQL, RESAMPLE_SQL, SEARCH_SQL, SHARDS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {"op4_chat": CHAT_SQL, "op5_shards": SHARDS_SQL, "op12_search": SEARCH_SQL, "op13_resample": RESAMPLE_SQL}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_fingerprints(spark, sf_dir):
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


@query
def op3_ngram_join(spark, sf_dir):
    return ngram_join.link(table(spark, sf_dir, "documents"))


CONTROL_TALK = "\\### Assistant: </turn> ok"


@query
def op4_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-7, 0, "user", CONTROL_TALK), (-7, 1, "assistant", CONTROL_TALK)]
    return chat.digest(chat.format_conversations(rows.unionByName(spark.createDataFrame(extra, rows.schema))))


@query
def op5_shards(spark, sf_dir):
    return shards.assign(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark, sf_dir):
    _, records = warc.archive(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "offset")


@query
def op8_quality(spark, sf_dir):
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_packing(spark, sf_dir):
    return packing.digest(table(spark, sf_dir, "documents"))


@query
def op10_html_extract(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op11_mixing(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"))


@query
def op12_search(spark, sf_dir):
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_resample(spark, sf_dir):
    return resample.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
