"""The training-data pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import decontaminate, lines, packing, toxicity
from panelwright.llm.near_copies import near_copies
from panelwright.session import store_alone

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose doc_id isn't in ``dropped``; null ones stay."""
    return docs.join(dropped.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts to be toxic go; of rows that share a doc_id, all do."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, toxicity.scores(docs, labels).where("predicted = 1"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier one go, and documents of which no line is left; n_chars counts what is left."""
    kept = lines.without_repeats(docs.select(*COLUMNS), drop_emptied=True)
    return kept.selectExpr("doc_id", "text", "lang", "source",
                           "if(size(removed_lines) > 0, cast(length(text) as bigint), n_chars) as n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest doc_id."""
    return _without(docs, near_copies(docs, size=5, percent=80).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.contaminated(docs, items))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in packed sequences."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# Learnt scores and token ids can't be had in SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. A stage's inner tables go once its own is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return docs
