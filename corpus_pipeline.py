"""From raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and returns a
frame; all but the last return the columns of ``documents``. Stages are written as Parquet in the
shared folder and read again, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from packetflow.llm import decontamination, jaccard_join, packing, quality_rules, site_quality
from packetflow.llm.common import table
from packetflow.llm.queries import tokenizer_path
from packetflow.session import work_dir


def keep_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are content, by the labels of the field."""
    field = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, field)


def keep_good_sites(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good by their text and their site.

    The classifier learns from all labelled documents: few bad ones are left at this stage.
    """
    model = site_quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return site_quality.kept_documents(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_content),
    ("quality_classifier", keep_good_sites),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: No SQL: a random field, a classifier and a linear program decide. Tests compare with plain code.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of what is left."""
    folder = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        path = f"{folder}/{number}-{name}"
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
