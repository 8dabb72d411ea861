"""Tree fits over counted cells against Spark's fits on the rows, and the split that all fits and reports share."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import RFormula
from pyspark.sql import functions as F

from ontime.plans import binned
from ontime.plans.binned import BinnedRows, bootstrap_counts, candidates, counted_cells
from ontime.plans.classify import _formula, stored_split_and_train, train_classifiers
from ontime.plans.evaluate import roc_points
from ontime.plans.ml_common import fit_layout, hash_split
from ontime.plans.model_store import ModelStore

COLUMNS = ["OnTime", "DepDelay", "Distance", "TaxiIn", "TaxiOut"]


def sample(spark, n, seed=5):
    """Real values, values with many zeros, few values and a constant-like column with negative zero."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a, d = rnd.gauss(3, 8), rnd.uniform(50, 3000)
        t, o = float(rnd.choice([0, 0, 0, 1, 4, 9])), rnd.choice([-0.0, 0.0, 2.5])
        rows.append((float(rnd.random() < 1 / (1 + np.exp(0.3 * a - d / 2000 + 0.1 * t))), a, d, t, o))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLUMNS))


@pytest.fixture(scope="module")
def rows(spark):
    """More rows than Spark finds split candidates from, so that it draws some."""
    laid_out = fit_layout(sample(spark, 15_000), COLUMNS).persist()
    vectors = RFormula(formula=_formula()).fit(laid_out).transform(laid_out).select("features", "label")
    yield laid_out, vectors
    laid_out.unpersist()


@pytest.fixture(scope="module")
def cells(rows):
    found = BinnedRows(*rows, 32, 42)
    yield found
    found.close()


def splits(model) -> list:
    return [[line for line in tree.toDebugString.split("\n")[1:] if "Predict" not in line] for tree in getattr(model, "trees", [model])]


def test_trees_on_cells_are_the_trees_on_rows(spark, rows, cells):
    laid_out, vectors = rows
    one, boosted = DecisionTreeClassifier(seed=42), GBTClassifier(seed=42, maxIter=4)
    of_rows, of_cells = one.fit(vectors), cells.fit(one)
    assert of_cells.toDebugString.split("\n")[1:] == of_rows.toDebugString.split("\n")[1:] and of_cells.depth == 5
    assert of_cells.getMaxBins() == 32 and not of_cells.isSet("weightCol")
    of_rows, of_cells = boosted.fit(vectors), cells.fit(boosted)
    assert splits(of_cells) == splits(of_rows) and of_cells.treeWeights == of_rows.treeWeights
    assert np.allclose(of_cells.featureImportances.toArray(), of_rows.featureImportances.toArray(), rtol=1e-9)
    both = zip(of_rows.transform(vectors).select("probability").collect(), of_cells.transform(vectors).select("probability").collect())
    assert max(abs(a[0][1] - b[0][1]) for a, b in both) < 1e-9


def test_saved_trees_of_cells_state_rows(spark, rows, cells, tmp_path):
    _, vectors = rows
    tree = DecisionTreeClassifier(seed=42)
    for kind, model in (("rows", tree.fit(vectors)), ("cells", cells.fit(tree))):
        model.save(f"{tmp_path}/{kind}")
    saved = [[(r.id, r.gain, r.rawCount, tuple(r.impurityStats), r.split) for r in spark.read.parquet(f"{tmp_path}/{kind}/data").orderBy("id").collect()]
             for kind in ("rows", "cells")]
    assert saved[0] == saved[1] and saved[0][0][2] == 15_000


def test_fits_read_cells_not_rows(spark, monkeypatch):
    """However many rows there are, the tree fits read at most one cell for each label and bins."""
    df = sample(spark, 3000).withColumn("Distance", F.lit(1.0)).withColumn("DepDelay", F.round("DepDelay", 4))
    read = {}
    for kind in (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, data, fit=fit, kind=kind: (read.setdefault(kind, []).append(data.count()), fit(self, data))[1])
    monkeypatch.setattr(binned, "MOST_ROWS_DRAWN_SINGLY", 100)
    models = train_classifiers(df)
    assert set(read) == {DecisionTreeClassifier, GBTClassifier, RandomForestClassifier}
    assert max(max(n) for n in read.values()) <= 2 * 32 * 1 * 4 * 2 < 3000 and len(read[RandomForestClassifier]) == 20
    assert [len(models[m].stages[-1].trees) for m in ("Random Forest", "Gradient Boosted Trees")] == [20, 20]


def test_forest_of_cells_is_a_bootstrap_of_all_rows(spark, rows, cells, monkeypatch):
    _, vectors = rows
    forest = RandomForestClassifier(seed=42)
    by_row = cells.fit(forest)  # few rows: Spark's own draws, as before
    assert splits(by_row) == splits(forest.fit(vectors))
    monkeypatch.setattr(binned, "MOST_ROWS_DRAWN_SINGLY", 0)
    by_cell = cells.fit(forest)
    assert splits(by_cell) == splits(cells.fit(forest))
    assert by_cell.getNumTrees == 20 and len({tuple(s) for s in splits(by_cell)}) == 20
    roots = [tree._java_obj.rootNode() for tree in by_cell.trees]
    drawn = [root.impurityStats().count() for root in roots]
    assert len(set(drawn)) > 10 and abs(np.mean(drawn) - 15_000) < 6 * (15_000 / 20) ** 0.5
    assert {root.split().threshold() for root in roots} <= {c for cuts in cells.cuts for c in cuts}
    assert {root.split().featureIndex() for root in roots} >= {0, 1}  # a root sees two of the four features
    assert np.allclose(by_cell.featureImportances.toArray(), by_row.featureImportances.toArray(), atol=0.08)
    right = [m.transform(vectors).where("prediction = label").count() for m in (by_row, by_cell)]
    assert abs(right[0] - right[1]) < 150


def test_bootstrap_counts_are_poisson_and_do_not_depend_on_the_layout(spark):
    cells = spark.range(2000).select((F.col("id") % 2).cast("double").alias("label"), "id", F.lit(25).cast("bigint").alias("n"))
    first = {r.id: list(r.drawn) for r in bootstrap_counts(fit_layout(cells, ["id"]), 20, 42).collect()}
    assert first == {r.id: list(r.drawn) for r in bootstrap_counts(fit_layout(cells.repartition(3), ["id"]), 20, 42).collect()}
    drawn = np.array([*first.values()])
    assert drawn.shape == (2000, 20) and abs(drawn.mean() - 25) < 0.2 and abs(drawn.var() - 25) < 1
    assert abs(np.corrcoef(drawn.T) - np.eye(20)).max() < 0.12  # the trees draw on their own


def test_candidates():
    assert candidates(Counter([1.0, 1.0, 3.0]), 3, 31) == [2.0]
    assert candidates(Counter([0.0, 0.0, 3.0]), 3, 31) == [1.5]
    assert candidates(Counter([0.0, 0.0]), 2, 31) == [] and candidates(Counter([7.0]), 1, 31) == []
    assert candidates(Counter(float(v) for v in range(1, 101)), 100, 3) == [25.5, 50.5, 75.5]


def test_cells_hold_every_row_on_its_side_of_every_candidate(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (0.0, 2.0), (0.0, 5.0), (0.0, 5.0)], "OnTime double, DepDelay double")
    got = {(r.label, r.b0, r.n) for r in counted_cells(df, [[1.0, 2.0, 3.0, 4.0]]).collect()}
    assert got == {(1.0, 0, 1), (1.0, 1, 1), (0.0, 1, 1), (0.0, 4, 2)}


def flights(spark, n):
    return sample(spark, n).select(F.when(F.col("OnTime") == 1, 0.0).otherwise(40.0).alias("ArrDelay"), *COLUMNS[1:])


def test_the_split_is_kept_with_the_fits(spark, tmp_path):
    df = flights(spark, 600)
    df = df.unionByName(df.limit(50)).unionByName(df.limit(1).withColumn("ArrDelay", F.lit(None).cast("double")))
    store = ModelStore(spark, f"{tmp_path}/models")
    models, test = stored_split_and_train(df, store)
    plan = test._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "md5" not in plan and "Exchange" not in plan
    data = df.where("ArrDelay is not null").select(F.when(F.col("ArrDelay") > 15, 0.0).otherwise(1.0).alias("OnTime"), *COLUMNS[1:])
    assert sorted(test.collect()) == sorted(hash_split(data)[1].collect()) and test.columns == COLUMNS
    again, same = stored_split_and_train(df.repartition(3), ModelStore(spark, f"{tmp_path}/models"))
    assert again is models and sorted(same.collect()) == sorted(test.collect())


def test_kept_rows_without_rows(spark, tmp_path):
    store = ModelStore(spark, f"{tmp_path}/models")
    none = spark.createDataFrame([], "a int, training boolean")
    for _ in range(2):
        assert store.rows("r", none, none, ["training"]).where("training").drop("training").collect() == []


def test_roc_points_read_the_scores_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch
    scored = spark.range(100).selectExpr("id / 10 as score", "cast(id % 3 = 0 as double) as label")
    curve = roc_points(scored.mapInPandas(count, scored.schema)).collect()
    assert len(curve) == 102 and seen.value == 100
    assert max(r.FPR for r in curve) == max(r.TPR for r in curve) == 1.0
