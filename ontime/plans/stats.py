"""Correlation matrix (R11, ML15, ML16) and min-max scaling (ML5)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.functions.columns import non_string_columns


def complete_rows(df: DataFrame, cols) -> DataFrame:
    """Listwise deletion over ``cols`` (N1); an error that names the NULL count of
    each column if no row is left, instead of a fit that fails without a reason."""
    cols = list(cols)
    kept = df.na.drop("any", subset=cols)
    if kept.isEmpty():
        n = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        if n["rows"]:
            nulls = ", ".join(f"{c}: {n[c]}" for c in cols if n[c])
            raise ValueError(f"no row of {n['rows']} is complete; NULLs by column: {nulls}. Name the columns to use.")
        raise ValueError("the table has no rows")
    return kept


def correlation_pairs(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """Pearson r for every pair below the diagonal, as rows (x, y, r).

    Listwise deletion first (N1). ``Correlation.corr`` makes one distributed
    pass for the means and one for the centred co-moments (tree aggregate of
    a p x p matrix); only that p x p matrix reaches the driver. A constant
    column gives NULL r.
    """
    cols = list(cols or non_string_columns(df))
    clean = complete_rows(df.select(*[F.col(c).cast("double") for c in cols]), cols)
    vectors = VectorAssembler(inputCols=cols, outputCol="__v").transform(clean).select("__v")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)  # the fit reads it twice
    try:
        matrix = Correlation.corr(vectors, "__v").first()[0].toArray()
    finally:
        vectors.unpersist()
    rows = []
    for i in range(len(cols)):
        for j in range(i):
            r = float(matrix[i, j])
            rows.append((cols[i], cols[j], None if math.isnan(r) else round(r, digits)))
    return df.sparkSession.createDataFrame(rows, "x string, y string, r double")


def correlation_matrix(flights: DataFrame, columns=None) -> DataFrame:
    """Every non-string column of the fact table, or ``columns`` (needed where
    some columns are mostly NULL, since rows must be complete)."""
    return correlation_pairs(flights, columns or non_string_columns(flights))


def min_max_scale(df: DataFrame, cols, out_cols=None, lo: float = 0.0, hi: float = 1.0,
                  fit_df: DataFrame | None = None) -> DataFrame:
    """Rescale each column to [lo, hi] with the column's min and max over all rows
    (or over ``fit_df``, e.g. the training part only).

    Same rule as ``MinMaxScaler``: a constant column maps to (lo + hi) / 2.
    Like the scaler's ``fit``, one aggregate pass finds the 2 x p bounds
    first; the rescaling is then a plain projection with literals.
    """
    cols = list(cols)
    out_cols = list(out_cols or cols)
    bounds = (fit_df if fit_df is not None else df).agg(*[F.min(c).alias(f"min{i}") for i, c in enumerate(cols)],
                    *[F.max(c).alias(f"max{i}") for i, c in enumerate(cols)]).first()
    scaled = {}
    for i, (c, o) in enumerate(zip(cols, out_cols)):
        mn, mx = bounds[f"min{i}"], bounds[f"max{i}"]
        if mn is None:
            scaled[o] = F.lit(None).cast("double")
        elif mx - mn != 0:
            scaled[o] = (F.col(c) - F.lit(mn)) / F.lit(mx - mn) * (hi - lo) + lo
        else:
            scaled[o] = F.when(F.col(c).isNotNull(), F.lit(0.5 * (hi - lo) + lo))
    return df.withColumns(scaled)
