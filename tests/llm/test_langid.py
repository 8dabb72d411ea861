import itertools

import numpy as np
from pyspark.sql import functions as F

from ontime.llm import langid

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths, labels = np.array([3, 1, 5, 2]), 3
    e, t, i = rng.normal(size=(11, labels)) * 3, rng.normal(size=(labels, labels)), rng.normal(size=labels)
    got, at = langid.forward_backward(e, lengths, t, i), 0
    for n in lengths.tolist():
        want = np.zeros((n, labels))
        for y in itertools.product(range(labels), repeat=n):
            score = i[y[0]] + sum(e[at + k, y[k]] for k in range(n)) + sum(t[a, b] for a, b in zip(y, y[1:]))
            for k, label in enumerate(y):
                want[k, label] += np.exp(score)
        assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_long_chain_stays_finite():
    p = langid.forward_backward(np.random.default_rng(1).normal(size=(50_000, 4)) * 40, np.array([50_000]), np.eye(4) * 3, np.zeros(4))
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)


def test_word_features():
    f = langid.word_features(["ab", "c", "été", "ab", "abx"])
    assert f.first.tolist() == [0, 2, 3, 8, 10] and len(f.trigram) == 13
    assert all(v[0] == v[3] for v in f.single.values()) and f.single["prefix2"][0] == f.single["prefix2"][4]
    assert f.trigram[0:2].tolist() == f.trigram[8:10].tolist() and f.trigram[0] == f.trigram[10]
    alone = langid.word_features(["c"])
    assert alone.trigram[0] == f.trigram[2]  # words do not depend on their neighbours
    assert langid.letters("12 _ ² ½ !") == [] and langid.letters("A2b") == ["a", "b"]


def test_held_out_accuracy_and_switches(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from ontime.llm.common import held_out
    rows = langid.identify(docs).where(held_out("doc_id")).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)
    texts = {r.lang: r.text for r in docs.where("length(text) BETWEEN 600 AND 900").select("lang", "text").collect()}
    mixed = " ".join(texts["en"].split()[:60] + texts["de"].split()[:60])
    one = spark.createDataFrame([(1, mixed)], "doc_id bigint, text string")
    model = langid.learn_languages(docs)
    runs = [r for r in one.select(langid.language(model)(F.col("text")).alias("l")).first().l.runs if r.words > 5]
    assert [r.lang for r in runs] == ["en", "de"] and abs(runs[1].word - 60) < 12


def test_quotas():
    assert langid.quotas([5, 3], 100) == [5, 3] and langid.quotas([], 10) == []
    got = langid.quotas([100_000, 50_000, 1, 7], 4000)
    assert got[2:] == [1, 7] and sum(got) <= 4000 and got[0] > got[1] >= 500
    assert langid.quotas([9] * 30, 10) == [1] * 30


def test_rare_languages_are_labels(spark):
    docs = [(i, f"the house and the garden number {i} of the town", "en") for i in range(400)]
    docs += [(1000 + i, "talo ja puutarha kaupungin keskellä yöllä", "fi") for i in range(3)]
    docs += [(2000 + i, "1234 !", "cy") for i in range(40)] + [(2100, "tŷ a gardd yng nghanol y dref", "cy")]
    docs += [(3000, "dom i ogród w środku miasta", "pl")] * 500  # one id only
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(4)
    from ontime.llm.common import learnable
    assert {r.lang for r in df.where(learnable("doc_id") & (F.length("text") > 6)).select("lang").distinct().collect()} == {"en", "fi", "cy", "pl"}
    model = langid.learn_languages(df, max_rows=16)
    assert model.languages == ["cy", "en", "fi", "pl"]


def test_odd_rows(odd_docs, no_docs, spark):
    for docs in (odd_docs, odd_docs.withColumn("lang", F.lit(None).cast("string"))):
        got = langid.identify(docs)
        assert sorted(got.columns) == sorted({*odd_docs.columns, "lang_pred", "score", "runs"})
        rows = got.collect()
        assert len(rows) == 11 and {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
        assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows} == {"und"}  # nothing to learn from
    assert langid.identify(no_docs).count() == 0
