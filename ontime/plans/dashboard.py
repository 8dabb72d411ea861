"""All reports over one set of flight sources, with the dashboard's reuse.

``FlightReports`` holds the three sources and keeps the expensive shared
pieces (fitted classifiers and their test predictions, the clustering
feature table) after first use, as the dashboard's reactive store did.
Every method returns a DataFrame. Relational reports run at most small size
probes while they are built; the statistics and model reports fit when called.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ontime.plans import classify, cluster, reports, stats


class FlightReports:
    def __init__(self, spark: SparkSession, flights: DataFrame, carriers: DataFrame, airports: DataFrame,
                 seed: int = 42, cluster_columns=None, fit_on_training: bool = False, columns=None, model_store=None):
        self.spark, self.flights, self.carriers, self.airports = spark, flights, carriers, airports
        self.seed = seed
        # ``columns``: the columns for R11 and R16-R19 (only those that hold features are clustered)
        self.columns = list(columns) if columns else None
        features = [c for c in cluster.feature_columns(flights) if not columns or c in columns]
        self.cluster_columns = list(cluster_columns or features)
        # False: scaler and PCA see all rows before the split, as the dashboard did;
        # True: they are fitted on the training part only.
        self.fit_on_training = fit_on_training
        # a ModelStore: fits are read from it where any session saved them for the same rows
        self.model_store = model_store
        self._split = None
        self._classifiers = None
        self._cluster_table = None
        self._projection = None

    # relational reports -------------------------------------------------------
    def attribute_distribution(self, column: str) -> DataFrame:
        return reports.attribute_distribution(self.flights, column)

    def airport_codes(self) -> DataFrame:
        return reports.airport_codes(self.flights)

    def traffic_windows(self, airport=None, days: int = 12) -> DataFrame:
        return reports.traffic_windows(self.flights, self.airports, days=days, airport=airport)

    def routes_per_carrier(self) -> DataFrame:
        return reports.routes_per_carrier(self.flights, self.carriers)

    def cancellation_causes(self) -> DataFrame:
        return reports.cancellation_causes(self.flights, self.carriers)

    def carrier_codes(self) -> DataFrame:
        return reports.carrier_codes(self.flights)

    def delay_cause_share(self, carrier=None) -> DataFrame:
        return reports.delay_cause_share(self.flights, carrier)

    def arrival_delay_buckets(self) -> DataFrame:
        return reports.arrival_delay_buckets(self.flights, self.carriers)

    def top_routes(self, k: int = 25) -> DataFrame:
        return reports.top_routes(self.flights, self.airports, k)

    def busiest_airports(self, k: int = 25) -> DataFrame:
        return reports.busiest_airports(self.flights, self.airports, k)

    # statistics and ML ---------------------------------------------------------
    def correlation_matrix(self) -> DataFrame:
        return stats.correlation_matrix(self.flights, self.columns)

    def _fitted(self):
        if self._classifiers is None:
            if self.model_store is None:
                self._classifiers = classify.split_and_train(self.flights, seed=self.seed)
            else:
                self._classifiers = classify.stored_split_and_train(self.flights, self.model_store, seed=self.seed)
        return self._classifiers

    def classifier_comparison(self) -> DataFrame:
        return classify.classifier_comparison(*self._fitted())

    def classifier_roc(self) -> DataFrame:
        return classify.logistic_roc(*self._fitted())

    def feature_importance(self) -> DataFrame:
        return classify.feature_importance(self.spark, self._fitted()[0])

    def cluster_features(self) -> DataFrame:
        """R16, assembled into a ``features`` vector and persisted once."""
        if self._cluster_table is None:
            table = cluster.cluster_features(self.flights, features=self.cluster_columns)
            self._cluster_table = cluster.assemble(table, self.cluster_columns) \
                .persist(StorageLevel.MEMORY_AND_DISK)
        return self._cluster_table

    def pca_variance(self) -> DataFrame:
        return cluster.pca_variance(self.spark, self.cluster_features(), n_features=len(self.cluster_columns))

    def _projected(self) -> DataFrame:
        """PC1..PC3 of the clustering table; the PCA is fitted once."""
        if self._projection is None:
            self._projection = cluster.pca_project(self.cluster_features(), keep=("DelayCode",))
        return self._projection

    def _train_test(self):
        """(training, testing) projections, fitted on the training part only."""
        if self._split is None:
            coded = cluster.with_delay_code(self.flights).select("DelayCode", *self.cluster_columns)
            self._split = cluster.training_fitted_projection(coded, self.cluster_columns, seed=self.seed)
        return self._split

    def silhouette_by_k(self, ks=range(2, 9)) -> DataFrame:
        if self.fit_on_training:
            return cluster.kmeans_silhouette(self.spark, None, ks=ks, seed=self.seed, split=self._train_test())
        return cluster.kmeans_silhouette(self.spark, self._projected(), ks=ks, seed=self.seed)

    def cluster_sample(self, k: int = 5) -> DataFrame:
        if self.fit_on_training:
            return cluster.cluster_sample(None, k=k, seed=self.seed, split=self._train_test())
        return cluster.cluster_sample(self._projected(), k=k, seed=self.seed)

    def close(self) -> None:
        if self._cluster_table is not None:
            self._cluster_table.unpersist()
            self._cluster_table = None
        if self._classifiers is not None:
            self._classifiers[1].unpersist()
        self._classifiers = None
        self._projection = None
        self._split = None
