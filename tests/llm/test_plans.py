"""Python functions run once for each text or vector: their evaluations are counted in the physical plans."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ontime.llm import ann, packing, quality_rules, sentencepiece, warc
from ontime.llm.queries import QUERIES
from ontime.llm.text_stats import COUNTS

SF = "/root/testdata/sf0.001"


def evaluations(df) -> Counter:
    """Function name -> evaluations in the plan (a node lists what it evaluates; nested calls are evaluated there, too)."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    found = Counter()
    for node in re.findall(r"ArrowEvalPython \[(.*?)\], \[", plan):
        found.update(re.findall(r"(\w+)\(", re.sub(r"cast\(|\bas\b", "", node)))
    return found


@pytest.mark.parametrize("name,function", [("op1_packing", "pieces"), ("op10_sentencepiece", "both")])
def test_texts_are_encoded_once(spark, name, function):
    assert evaluations(QUERIES[name](spark, SF))[function] == 1


def test_payloads_need_no_python_digest(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert not evaluations(warc.revisit_plan(pages, "page_id", "html"))


def test_vectors_are_placed_once(spark):
    found = evaluations(ann.search(spark.read.parquet(f"{SF}/embeddings.parquet"), F.col("vec_id") % 20 == 0))
    assert found["place"] == 1 and found["reach"] == 1


def test_rules_count_a_text_once(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    found = evaluations(quality_rules.filter_by_rules(docs, labels))
    assert found["passes"] == 1 and found["stats"] == 0


def test_rules_filter_as_they_judge(spark):
    """The filter takes counts and verdict in one function; it keeps the rows that judge keeps."""
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    stats = quality_rules.stats_table(docs)
    judged = quality_rules.judge(stats, quality_rules.fit_rules(stats, labels)).where("kept")
    assert sorted(r.doc_id for r in quality_rules.filter_by_rules(docs, labels).collect()) == sorted(r.doc_id for r in judged.collect())
    assert "n_words" in COUNTS


def test_stages_of_the_pipeline_evaluate_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        if name in ("quality_classifier", "quality_rules", "packing"):
            assert all(n == 1 for n in evaluations(stage(spark, docs, SF)).values()), name


def test_round_trip_is_encode_then_decode(spark):
    path = packing.public_tokenizers.path("piece_bpe_32k.model")
    df = spark.createDataFrame([("a b",), (None,), ("",), ("x" * 400,), ("é 日本 ▁",)], "t string")
    both = df.select(sentencepiece.round_trip(F.col("t"), path).alias("b")).select("b.*").collect()
    each = df.select(sentencepiece.encode(F.col("t"), path).alias("ids")).withColumn("back", sentencepiece.decode(F.col("ids"), path))
    assert sorted(map(tuple, both)) == sorted(map(tuple, each.collect()))
