"""Delay classification (R12-R15): on-time label, four classifiers, metrics,
ROC of the logistic model and tree feature importances.

Training and scoring are distributed ``pyspark.ml`` jobs; only model
summaries (a few numbers per model) reach the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import RFormula
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ontime.plans.binned import BinnedRows
from ontime.plans.evaluate import confusion_metrics, roc_points
from ontime.plans.ml_common import fit_layout, hash_split, labelled_rows
from ontime.plans.model_store import ModelStore, rows_fingerprint
from ontime.session import checkpoint_dir

# The report's features.
FEATURES = ["DepDelay", "Distance", "TaxiIn", "TaxiOut"]
LABEL = "OnTime"

# Model names in report order.
MODEL_NAMES = ["Logistic", "Decision Tree", "Random Forest", "Gradient Boosted Trees"]


def on_time(arr_delay: Column, late_after: float = 15.0) -> Column:
    """1.0 when ArrDelay <= late_after, 0.0 when later; NULL delay stays NULL."""
    return F.when(arr_delay > late_after, F.lit(0.0)).when(arr_delay <= late_after, F.lit(1.0))


def classification_set(flights: DataFrame, late_after: float = 15.0, features=FEATURES) -> DataFrame:
    """R12 input: (OnTime, features...) with any-NULL rows dropped."""
    return (flights.select(on_time(F.col("ArrDelay"), late_after).alias(LABEL), *features)
            .na.drop("any"))


def _formula(features=FEATURES, label=LABEL) -> str:
    return f"{label} ~ {' + '.join(features)}"


def _estimators(seed: int):
    return {
        "Logistic": LogisticRegression(),
        "Decision Tree": DecisionTreeClassifier(seed=seed),
        "Random Forest": RandomForestClassifier(seed=seed),
        "Gradient Boosted Trees": GBTClassifier(seed=seed, checkpointInterval=10),
    }


def train_classifiers(train: DataFrame, features=FEATURES, label=LABEL, seed: int = 42) -> dict:
    """Fit the four models (library defaults, as the dashboard) on ``train``.

    The rows are dealt by content and persisted once for all four fits, so the
    models do not depend on the input's layout. The trees are fitted on the
    rows counted by bins (:class:`BinnedRows`), unless a column is no number:
    the formula makes categories of texts. Each result is a ``PipelineModel``
    (formula, classifier).
    """
    checkpoint_dir(train.sparkSession)
    laid_out = fit_layout(train.select(label, *features), [label, *features]).persist(StorageLevel.MEMORY_AND_DISK)
    formula = RFormula(formula=_formula(features, label)).fit(laid_out)
    vectors = formula.transform(laid_out).select("features", "label")
    estimators, models, binned = _estimators(seed), {}, None
    try:
        models["Logistic"] = estimators.pop("Logistic").fit(vectors)
        if all(isinstance(f.dataType, NumericType) for f in laid_out.schema):
            binned = BinnedRows(laid_out, vectors, estimators["Decision Tree"].getMaxBins(), seed)
        for name, est in estimators.items():
            models[name] = binned.fit(est) if binned else est.fit(vectors)
        return {name: PipelineModel(stages=[formula, model]) for name, model in models.items()}
    finally:
        if binned:
            binned.close()
        laid_out.unpersist()


def split_and_train(flights: DataFrame, seed: int = 42, fraction: float = 0.7):
    """Label, 70/30 repeatable split, four fitted models.

    Returns (models, test). The data are persisted for the split and the test
    part for scoring; the caller unpersists the test part when done, as
    ``FlightReports.close`` does."""
    data = classification_set(flights).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = hash_split(data, fraction=fraction, seed=seed)
        test = test.persist(StorageLevel.MEMORY_AND_DISK)
        test.count()
        return train_classifiers(train, seed=seed), test
    finally:
        data.unpersist()


def stored_split_and_train(flights: DataFrame, store: ModelStore, seed: int = 42, fraction: float = 0.7, key: str | None = None):
    """R12 with the split and the fits kept on shared storage (S9): (models, test), read back if any session had equal rows.

    The rows are split once, for all fits and for the reports over the test part. ``key``: their fingerprint, if known."""
    data = classification_set(flights)
    key = key or rows_fingerprint(data)
    rows = store.rows("classifier_rows", key, labelled_rows(data, fraction, seed), ["training"], seed=seed, fraction=fraction)
    train, test = rows.where("training").drop("training"), rows.where("not training").drop("training")
    return store.fitted("classifiers", key, lambda: train_classifiers(train, seed=seed), seed=seed, fraction=fraction), test


def scored_by_all(models: dict, test: DataFrame) -> DataFrame:
    """(Classifier, label, prediction, probability of class 1): every model applied
    in one pass over the test rows, one output row per model."""
    formula = next(iter(models.values())).stages[0]
    rows = formula.transform(test).select("features", "label")
    cells = []
    for i, (name, model) in enumerate(models.items()):
        fitted = model.stages[-1].copy({
            model.stages[-1].predictionCol: f"p{i}", model.stages[-1].rawPredictionCol: f"r{i}",
            model.stages[-1].probabilityCol: f"q{i}"})
        rows = fitted.transform(rows)
        cells.append(F.struct(F.lit(name).alias("Classifier"), F.col("label"), F.col(f"p{i}").alias("prediction"),
                              vector_to_array(F.col(f"q{i}"))[1].alias("score")))
    return rows.select(F.inline(F.array(*cells)))


def confusion_counts(models: dict, test: DataFrame) -> DataFrame:
    """(Classifier, label, prediction, n): the confusion matrix of every model, one pass over the test rows."""
    return scored_by_all(models, test).groupBy("Classifier", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def classifier_comparison(models: dict, test: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(Classifier, Metric, Performance), four metrics per model, one aggregate.

    ``counts``: the test rows' :func:`confusion_counts`, if they are already there."""
    counts = confusion_counts(models, test) if counts is None else counts
    return confusion_metrics(counts, "label", "prediction", by=["Classifier"], count_col="n")


def logistic_roc(models: dict, test: DataFrame) -> DataFrame:
    """ROC of the logistic model on the test part (FPR, TPR)."""
    pipe = models["Logistic"]
    prepared = pipe.stages[0].transform(test)
    return pipe.stages[-1].evaluate(prepared).roc


def exact_roc(models: dict, test: DataFrame, name: str = "Logistic") -> DataFrame:
    """Every point of one model's ROC (FPR, TPR, threshold), without down-sampling."""
    return roc_points(scored_by_all({name: models[name]}, test))


def feature_importance(spark: SparkSession, models: dict, features=FEATURES) -> DataFrame:
    """(Model, feature, importance) for the three tree models, largest first.

    The importances are a few numbers per fitted model (one per feature)."""
    rows = []
    for name in MODEL_NAMES[1:]:
        imp = models[name].stages[-1].featureImportances.toArray()
        rows += [(name, f, float(v)) for f, v in zip(features, imp)]
    return (spark.createDataFrame(rows, "Model string, feature string, importance double")
            .orderBy("Model", F.desc("importance")))
