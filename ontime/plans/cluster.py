"""Delay-cause clustering (R16-R19): dominant-cause label, scaled features,
PCA variance and projection, k-means silhouette sweep, per-cluster sample.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.functions.argmax import argmax_name, delay_code, sum_of
from ontime.functions.columns import matching_columns
from ontime.functions.keys import hash_key
from ontime.operators.ranking import stratified_sample
from ontime.plans.ml_common import fit_layout, hash_split
from ontime.plans.stats import complete_rows, min_max_scale
from ontime.sources.schemas import CAUSE_COLUMNS


def feature_columns(df: DataFrame) -> list[str]:
    """Columns named *Time, *Delay, Taxi*, Wheels* and Distance, without the
    five cause columns (they define the label, not the features)."""
    picked = matching_columns(df, ends_with=("Time", "Delay"), starts_with=("Taxi", "Wheels"),
                              names=("Distance",))
    return [c for c in picked if c not in CAUSE_COLUMNS]


def with_delay_code(flights: DataFrame, min_total: float = 15.0) -> DataFrame:
    """Flights whose five causes add to more than ``min_total`` (a NULL cause
    drops the row), labelled with the largest cause (first wins ties)."""
    return (flights.where(sum_of(CAUSE_COLUMNS) > min_total)
            .withColumn("DelayCode", delay_code(argmax_name(CAUSE_COLUMNS))))


def cluster_features(flights: DataFrame, min_total: float = 15.0, keys=(), features=None) -> DataFrame:
    """DelayCode plus the feature columns min-max scaled to [0, 1]
    (scaler fitted on all kept rows, as the dashboard does).

    Rows with a NULL feature are dropped; pass ``features`` to leave out
    columns that are mostly NULL (e.g. second-diversion times). If they
    empty the table, the error names the NULL count of each column."""
    feats = list(features or feature_columns(flights))
    coded = with_delay_code(flights, min_total).select(*keys, "DelayCode", *feats)
    return min_max_scale(complete_rows(coded, feats), feats)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def pca_variance(spark: SparkSession, features: DataFrame, features_col: str = "features",
                 n_features: int | None = None) -> DataFrame:
    """Explained variance (percent) per component and its running total."""
    p = n_features or len(features.select(features_col).first()[0])
    model = PCA(k=p, inputCol=features_col, outputCol="__pc").fit(features)
    # The fit already returns the p ratios to the driver; the running total
    # of p numbers is done there, as the dashboard did.
    rows, total = [], 0.0
    for i, v in enumerate(model.explainedVariance.toArray()):
        total += float(v) * 100
        rows.append((i + 1, float(v) * 100, total))
    return spark.createDataFrame(rows, "NPC int, PCValue double, PCCum double")


def pca_project(features: DataFrame, features_col: str = "features", k: int = 3,
                keep=(), fit_df: DataFrame | None = None) -> DataFrame:
    """ML18: project onto the first k components, columns PC1..PCk (sign arbitrary).
    The components come from ``fit_df`` when given (e.g. the training part)."""
    model = PCA(k=k, inputCol=features_col, outputCol="__pcs").fit(
        fit_df if fit_df is not None else features)
    arr = vector_to_array(F.col("__pcs"))
    return model.transform(features).select(
        *keep, F.col("__pcs").alias("pcs"), *[arr[i].alias(f"PC{i + 1}") for i in range(k)])


def training_fitted_projection(coded: DataFrame, feature_cols, k: int = 3, seed: int = 42,
                               fraction: float = 0.7, keep=("DelayCode",)):
    """Q13 option: split first, then fit the min-max bounds and the PCA on the
    training part only and apply them to both parts (no test-set leakage).
    Returns (training, testing) projections with ``pcs`` and PC1..PCk."""
    cols = list(feature_cols)
    train_raw, test_raw = hash_split(complete_rows(coded, cols), fraction=fraction, seed=seed)
    train = assemble(min_max_scale(train_raw, cols, fit_df=train_raw), cols)
    test = assemble(min_max_scale(test_raw, cols, fit_df=train_raw), cols)
    model = PCA(k=k, inputCol="features", outputCol="__pcs").fit(train)
    arr = vector_to_array(F.col("__pcs"))

    def project(df):
        return model.transform(df).select(*keep, F.col("__pcs").alias("pcs"),
                                          *[arr[i].alias(f"PC{i + 1}") for i in range(k)])
    return project(train), project(test)


def _split_pcs(projected, key_cols, seed, split):
    """(training, testing) rows with PC1..PCk; the split key is the row where there is no other."""
    if split:
        return split
    if key_cols:
        return hash_split(projected, key_cols=key_cols, seed=seed)
    names = [c for c in projected.columns if c != "pcs"]  # a vector has no grouping order
    pcs = F.array(*[F.col(c) for c in names if c.startswith("PC")])
    return tuple(part.withColumn("pcs", array_to_vector(pcs)) for part in hash_split(projected.select(*names), seed=seed))


def _pc_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("PC")]


def kmeans_silhouette(spark: SparkSession, projected: DataFrame | None, ks=range(2, 9), seed: int = 42,
                      key_cols=None, split=None) -> DataFrame:
    """Silhouette on the test part of k-means fitted on the training part,
    for each k. The projection is persisted before the split and each part
    once for all fits; a fit depends on the rows alone, not on their layout."""
    source = None if split else projected.persist(StorageLevel.MEMORY_AND_DISK)
    train, test = _split_pcs(source, key_cols, seed, split)
    train = fit_layout(train, _pc_columns(train)).select("pcs").persist(StorageLevel.MEMORY_AND_DISK)
    test = fit_layout(test, _pc_columns(test)).select("pcs").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = []
        for k in ks:
            model = KMeans(k=k, seed=seed, featuresCol="pcs").fit(train)
            score = ClusteringEvaluator(featuresCol="pcs").evaluate(model.transform(test))
            rows.append((int(k), float(score)))
    finally:
        train.unpersist()
        test.unpersist()
        if source is not None:
            source.unpersist()
    return spark.createDataFrame(rows, "NumberCluster int, Silhouette double")


def cluster_sample(projected: DataFrame | None, k: int = 5, points: int = 5000, seed: int = 42,
                   id_col: str | None = None, key_cols=None, split=None) -> DataFrame:
    """K-means on the training part, the test part labelled, and at most
    floor(points / k) test rows per cluster (repeatable hash order)."""
    train, test = _split_pcs(projected, key_cols, seed, split)
    train = fit_layout(train, _pc_columns(train)).select("pcs").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, seed=seed, featuresCol="pcs").fit(train)
    finally:
        train.unpersist()
    pred = model.transform(test)
    order = hash_key(F.col(id_col), seed) if id_col else F.xxhash64(*[F.col(c) for c in _pc_columns(pred)])
    per_cluster = int(math.floor(points / k))
    sample = stratified_sample(pred, "prediction", per_cluster, order)
    return sample.select(
        *([id_col] if id_col else []), *_pc_columns(pred), "prediction",
        F.concat(F.lit("Cluster "), (F.col("prediction") + 1).cast("string")).alias("Cluster"))


def scaled_vectors(df: DataFrame, array_col: str, keep=(), out: str = "features") -> DataFrame:
    """Dense array column -> vector -> MinMaxScaler (fitted on all rows)."""
    vec = df.select(*keep, array_to_vector(F.col(array_col)).alias("__raw"))
    model = MinMaxScaler(inputCol="__raw", outputCol=out).fit(vec)
    return model.transform(vec).drop("__raw")
