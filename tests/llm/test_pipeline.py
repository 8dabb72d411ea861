"""Every stage of the pipeline on whole small tables, and the registered queries."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpus_pipeline import STAGES, run
from ontime.llm.queries import ORACLE, QUERIES
from tests.llm.test_simhash import reference_fingerprint
from tests.llm.test_substring import reference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in STAGES:
        f(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out.append((docs, spark.read.parquet(f"{folder}/{name}")))
        docs = out[-1][1]
    return out


def test_columns_and_subsets(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
    assert 0 < stages[2][1].count() < stages[0][0].count()


def test_filters_keep_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    left = {r.doc_id for r in stages[0][1].collect()}
    assert len(good & left) >= 0.98 * len(good) and len(bad & left) <= 0.1 * len(bad)


def test_one_document_of_each_group_stays(stages):
    before, after = ([(r.doc_id, reference_fingerprint(r.text)) for r in d.collect()] for d in stages[2])
    label = {i: i for i, _ in before}
    changed = True
    while changed:
        changed = False
        for a, x in before:
            for b, y in before:
                if label[a] < label[b] and bin(x ^ y).count("1") <= 3:
                    label[b], changed = label[a], True
    assert sorted(i for i, _ in after) == sorted(set(label.values()))


def test_repeated_windows_go(stages):
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in stages[3])
    ids = sorted(before)
    want = {i: before[i] if removed == 0 else kept for i, (_, removed, kept) in zip(ids, reference([before[i] for i in ids], 35))}
    assert after == want
    assert all(r.n_chars == len(r.text) for r in stages[3][1].collect())


def test_pieces_hold_every_token_once(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in stages[4][1].collect():
        pieces.setdefault(r.doc_id, {})[r.start] = bytes(r.tokens)
    for r in stages[4][0].collect():
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], np.uint32)
        assert b"".join(pieces[r.doc_id][s] for s in sorted(pieces[r.doc_id])) == ids.tobytes()


def test_run_equals_its_stages(spark, stages):
    count = lambda df: Counter((r.doc_id, r.start, r.length, zlib.crc32(r.tokens)) for r in df.collect())
    assert count(run(spark, SF)) == count(stages[4][1])


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE.items():
        if name not in QUERIES:
            continue
        got = QUERIES[name](spark, SF)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(got.columns)
        assert Counter(tuple(r) for r in cur.fetchall()) == Counter(tuple(r) for r in got.select(*names).collect())


def test_every_operator_has_a_query(spark):
    assert [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")] == list(range(1, 14))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("op1_packing", "op3_simhash", "op4_quality_rules", "op7_substring", "op8_quality", "op9_language", "op10_sentencepiece",
                 "op11_alignment"):
        got = QUERIES[name](spark, SF).select("doc_id").distinct()
        assert got.exceptAll(docs.select("doc_id")).count() == 0 and got.count() == docs.select("doc_id").distinct().count(), name
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for name in ("op2_url_filters", "op6_warc"):
        assert QUERIES[name](spark, SF).select("page_id").exceptAll(pages.select("page_id")).count() == 0
    assert QUERIES["op5_ann"](spark, SF).where(F.col("query_id") % 20 != 0).count() == 0
