import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ontime.llm import quality_gam as gam
from ontime.llm import quality_rules as rules
from ontime.llm.text_stats import COUNTS, FEATURES, feature_matrix, text_counts

SF = "/root/testdata/sf0.01"


def reference(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@settings(deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "日\n", "\n", " ", "\x0b", "a a a a a a", "<x>|"]), max_size=40))
def test_counts_equal_the_rules(parts):
    text = " ".join(parts)
    assert text_counts(text.encode())[:5] == reference(text)


def test_path_length_of_a_tree():
    assert rules.average_path(1) == 0 and rules.average_path(2) == 1
    assert rules.average_path(256) == pytest.approx(10.24, abs=0.02)


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    forest = rules.grow_forest(x)
    far = forest.scores(np.full((1, 5), 6.0))[0]
    assert far > np.quantile(forest.scores(x), 0.99) and 0 < far <= 1
    assert (forest.scores(x) == rules.grow_forest(x).scores(x)).all()  # same seed, same trees
    one = rules.grow_forest(np.zeros((1, 5)))
    assert np.isfinite(one.scores(np.ones((3, 5)))).all()


def test_threshold_loses_at_most_the_allowed_share():
    import pandas as pd
    bins = pd.DataFrame({"_quality": [1] * 4 + [0], "_bin": [800, 900, 1000, 1500, 1600], "count": [900, 95, 4, 1, 50]})
    assert rules._threshold(bins, 0.005) == 901 / rules.SCORE_BINS  # loses 1000 and 1500: 5 of 1000
    assert rules._threshold(bins[bins["_quality"] == 0], 0.005) == 1.0


def test_a_forest_without_gain_rejects_nothing():
    import pandas as pd
    bins = pd.DataFrame({"_quality": [1, 1, 0], "_bin": [800, 1500, 700], "count": [999, 1, 50]})
    assert rules._threshold(bins, 0.005) == 1.0
    assert rules._threshold(bins[bins["_quality"] == 1], 0.005) == 1.0


def test_step_forest_equals_its_trees():
    x = np.random.default_rng(3).normal(size=(900, 4)).round(1)
    step = rules.step_forest(x, 2, 16, 64)
    trees = rules.grow_forest(x[:, [2]], 16, 64, seed=45)
    odd = np.concatenate([x, np.full((1, 4), -50.0), np.full((1, 4), 50.0), np.repeat(step.cuts[:, None], 4, axis=1)])
    assert (step.scores(odd) == trees.scores(odd[:, [2]])).all()
    assert (rules.step_forest(np.zeros((5, 1)), 0, 4, 64).scores(np.ones((2, 1))) <= 1).all()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_rules_keep_clean_documents(docs, labels):
    kept = rules.filter_by_rules(docs, labels)
    assert kept.columns == docs.columns
    rate = (labels.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left").groupBy("quality")
            .agg(F.avg(F.coalesce("k", F.lit(0))).alias("r")).collect())
    rate = {r.quality: r.r for r in rate}
    assert rate[1] > 0.95 and rate[0] < 0.6  # quality 1 has some texts of under 10 words, which the base rules reject


def test_forests_reject_bad_held_out_rows(docs, labels):
    """Beyond the base rules, on rows whose labels the calibration never saw."""
    stats = rules.stats_table(docs)
    judged = rules.judge(stats, rules.fit_rules(stats, labels)).where("NOT base_failed").join(labels, "doc_id").collect()
    held = [r for r in judged if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    bad, clean = ([not r.kept for r in held if r.quality == q] for q in (0, 1))
    assert np.mean(bad) > 0.9 and np.mean(clean) < 0.02


def test_classifier_on_held_out_rows(docs, labels):
    scored = gam.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_held_out_labels_are_never_learned(docs, labels):
    from ontime.llm.common import learnable
    flipped = labels.withColumn("quality", F.when(learnable("doc_id"), F.col("quality")).otherwise(1 - F.col("quality")))
    a = {r.doc_id: r.score for r in gam.score_documents(docs, labels, max_rows=200).collect()}
    b = {r.doc_id: r.score for r in gam.score_documents(docs.repartition(5), flipped, max_rows=200).collect()}
    assert a == b


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit_gam(x, y, rounds=20, pair_rounds=40, n_pairs=1)
    assert model.pairs[0][:2] == (0, 1)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.9
    assert gam.Gam(0.0).scores(x).tolist() == [0.5] * 4000
    assert gam.fit_gam(x, np.ones(4000)).scores(x).min() > 0.99 and len(gam.fit_gam(x[:0], y[:0]).scores(x)) == 4000


def test_score_is_a_sum_of_table_entries():
    x = feature_matrix(np.array([text_counts(t) for t in (b"", b"a b", None, b"x\n" * 50)]))
    assert x.shape == (4, len(FEATURES)) and np.isfinite(x).all()
    model = gam.Gam(0.5, [np.array([1.0])] * 15, [np.array([0.0, 0.1])] * 15, [np.array([1.0])] * 15,
                    [(0, 1, np.array([[0.0, 0.2], [0.3, 0.4]]))])
    want = 0.5 + 0.1 * (x >= 1).sum(axis=1) + np.array([[0.0, 0.2], [0.3, 0.4]])[(x[:, 0] >= 1).astype(int), (x[:, 1] >= 1).astype(int)]
    assert model.scores(x) == pytest.approx(1 / (1 + np.exp(-want)))


def test_odd_rows(odd_docs, no_docs, odd_labels):
    none = odd_labels.limit(0)
    for table in (odd_labels, none):
        judged = rules.judge(rules.stats_table(odd_docs), rules.fit_rules(rules.stats_table(odd_docs), table)).collect()
        assert len(judged) == 11 and all(r.base_failed and not r.kept for r in judged if r.doc_id in (3, 4, 5, 8, 9))
        scored = gam.score_documents(odd_docs, table).collect()
        assert len(scored) == 11 and all(0 <= r.score <= 1 for r in scored)
        assert rules.filter_by_rules(odd_docs, table).columns == odd_docs.columns
        assert gam.filter_by_quality(odd_docs, table).columns == odd_docs.columns
        assert rules.filter_by_rules(no_docs, table).count() == gam.filter_by_quality(no_docs, table).count() == 0
    assert {r.score for r in gam.score_documents(odd_docs, none).collect()} == {0.5}
    assert [c for c in COUNTS if c not in rules.stats_table(no_docs).columns] == []
