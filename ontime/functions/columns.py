"""Column selection by name pattern, by type and by user-supplied name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def matching_columns(df: DataFrame, ends_with=(), starts_with=(), names=()) -> list[str]:
    """Columns whose name ends/starts with any pattern (case-insensitive), plus names.

    File order is kept; each column appears once.
    """
    ends = [e.lower() for e in ends_with]
    starts = [s.lower() for s in starts_with]
    wanted = {n.lower() for n in names}
    out = []
    for c in df.columns:
        low = c.lower()
        if any(low.endswith(e) for e in ends) or any(low.startswith(s) for s in starts) or low in wanted:
            out.append(c)
    return out


def select_matching(df: DataFrame, ends_with=(), starts_with=(), names=()) -> DataFrame:
    return df.select(*matching_columns(df, ends_with, starts_with, names))


def drop_matching(df: DataFrame, ends_with=(), starts_with=()) -> DataFrame:
    return df.drop(*matching_columns(df, ends_with, starts_with))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def non_string_columns(df: DataFrame) -> list[str]:
    """Everything that is not a string; restricted to numbers so it can be correlated."""
    return numeric_columns(df)


def resolve_column(df: DataFrame, name: str) -> str:
    """Validate a user-supplied column name."""
    if name not in df.columns:
        raise ValueError(f"unknown column {name!r}; available: {df.columns}")
    return name
