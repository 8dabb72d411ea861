"""Fitted models kept on shared storage and found again by what they were fitted on.

The dashboard kept its models for a session. Here a fit is saved through the ML
writer under the fingerprint of its training rows and parameters; any session
that asks for the same fit on equal rows reads it. A manifest is written after
the model, so a fit that died half way is never read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import checkpoint_dir


def rows_fingerprint(df: DataFrame) -> str:
    """32 hex digits over the multiset of rows: the same for any layout, another for any other rows.

    Sums of two independent 64-bit hashes (as exact decimals) and the count; one pass with a map-side step.
    """
    values = [F.col(f"`{c}`") for c in df.columns]
    values += [c.isNull() for c in values]  # a hash passes over NULLs
    one, two = F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)
    seen = df.agg(F.count(F.lit(1)), F.sum(one.cast("decimal(20,0)")), F.sum(two.cast("decimal(20,0)"))).first()
    return hashlib.md5(f"{df.schema.simpleString()}|{tuple(seen)}".encode()).hexdigest()


class ModelStore:
    """Models by name, rows and parameters, below the session's shared folder (or ``folder``)."""

    _loaded: dict = {}  # models read by a session, so that its reports share them

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or f"{checkpoint_dir(spark).rstrip('/')}/models").rstrip("/")

    def _path(self, name: str, rows_key: str, params: dict) -> str:
        key = hashlib.md5(f"{rows_key}|{json.dumps(params, sort_keys=True, default=str)}".encode()).hexdigest()
        return f"{self.folder}/{name}-{key}"

    def _saved(self, path: str) -> str | None:
        """The folder of the first finished attempt."""
        try:
            rows = self.spark.read.schema("attempt string").json(f"{path}/manifest").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return min((r["attempt"] for r in rows), default=None)

    @staticmethod
    def _rows_key(training: DataFrame | str) -> str:
        """The fingerprint of the rows, which may be given instead of them."""
        return training if isinstance(training, str) else rows_fingerprint(training)

    def _note(self, path: str, attempt: str) -> None:
        self.spark.createDataFrame([(attempt,)], "attempt string").coalesce(1).write.mode("append").json(f"{path}/manifest")

    def rows(self, name: str, training: DataFrame | str, made: DataFrame, parts: list[str], **params) -> DataFrame:
        """The rows of ``made``, written once, in a folder for each value of ``parts``, for equal training rows and parameters."""
        path = self._path(name, self._rows_key(training), params)
        attempt = self._saved(path)
        if attempt is None:
            attempt = f"{path}/attempt-{uuid.uuid4().hex}"
            made.write.partitionBy(*parts).parquet(f"{attempt}/rows")
            self._note(path, attempt)
        return self.spark.read.schema(made.schema).parquet(f"{attempt}/rows")

    def fitted(self, name: str, training: DataFrame | str, fit: Callable[[], dict[str, PipelineModel]], **params) -> dict[str, PipelineModel]:
        """The models of ``fit()``, read back if they were saved for equal training rows and parameters."""
        path = self._path(name, self._rows_key(training), params)
        known = (self.spark.sparkContext.applicationId, path)
        if known in self._loaded:
            return self._loaded[known]
        attempt = self._saved(path)
        if attempt is None:
            models, attempt = fit(), f"{path}/attempt-{uuid.uuid4().hex}"
            for i, (part, model) in enumerate(models.items()):
                model.write().save(f"{attempt}/{i}")
            self.spark.createDataFrame([(json.dumps(list(models)),)], "names string").coalesce(1).write.json(f"{attempt}/names")
            self._note(path, attempt)
            self._loaded[known] = models
            return models
        names = json.loads(self.spark.read.schema("names string").json(f"{attempt}/names").first()[0])
        self._loaded[known] = {part: PipelineModel.load(f"{attempt}/{i}") for i, part in enumerate(names)}
        return self._loaded[known]

    def node_tables(self, name: str, training: DataFrame | str, **params) -> dict[str, DataFrame]:
        """The saved nodes of the last stage of each tree model, as its writer laid them out."""
        attempt = self._saved(self._path(name, self._rows_key(training), params))
        if attempt is None:
            raise LookupError(f"no saved fit of {name} for these rows")
        names, out = json.loads(self.spark.read.schema("names string").json(f"{attempt}/names").first()[0]), {}
        for i, part in enumerate(names):
            stages = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{attempt}/{i}/stages")
            last = stages.select(F.max(F.regexp_extract("path", r"(.*/stages/\d+_[^/]+)/data/", 1)).alias("p")).first()["p"]
            table = self.spark.read.parquet(f"{last}/data")
            if "nodeData" in table.columns or "leftChild" in table.columns:
                out[part] = table
        return out
