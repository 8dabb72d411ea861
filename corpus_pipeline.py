"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet to the shared folder and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import packing, quality_gam, quality_rules, simhash, substring
from ontime.llm.common import prepare
from ontime.session import checkpoint_dir


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.5 go."""
    return quality_gam.filter_by_quality(docs, _labels(spark, sf_dir))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the isolation forest go."""
    return quality_rules.filter_by_rules(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    prepare(spark)
    return simhash.near_dedup(docs, shingle=3, max_distance=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows go; a text that loses none stays as it is."""
    prepare(spark)
    cut = substring.remove_duplicate_spans(docs, width=35)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return (cut.withColumn("text", text).select(*docs.columns)
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the texts that are left, one sequence each."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", rules),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

# The classifier, the forest and the tokeniser have no SQL form; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; the pieces of the documents that are left."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
