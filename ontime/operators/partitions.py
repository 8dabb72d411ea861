"""Functions over partitions (D1, D2): a hook for row code that expressions cannot state.

Prefer expressions: they stay in generated code and the optimizer sees through
them. Where that fails, ``map_partitions`` hands Arrow batches of bounded size to
a Python function on the executors and holds the result to a declared schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _conformed(batch: pa.RecordBatch | pa.Table, schema: pa.Schema, names: dict[str, str]) -> list[pa.RecordBatch]:
    """Columns by name (after renaming) in the declared order and types; a clear error where they differ."""
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    table = table.rename_columns([names.get(c, c) for c in table.column_names])
    missing, more = set(schema.names) - set(table.column_names), set(table.column_names) - set(schema.names)
    if missing or more or len(table.column_names) != len(schema.names):
        raise ValueError(f"the function's columns {table.column_names} are not the declared {schema.names}")
    return table.select(schema.names).cast(schema).to_batches()


def map_partitions(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | Iterable], schema: str | T.StructType,
                   columns: list[str] | None = None, batch_rows: int = 10_000, names: dict[str, str] | None = None) -> DataFrame:
    """``fn`` applied to the Arrow batches of every partition; its results, as rows of ``schema``.

    ``fn`` gets a batch of at most ``batch_rows`` rows with ``columns`` (default:
    all) and returns a batch, a table, an iterable of those, or None for no rows.
    ``names`` renames its columns ({its name: declared name}); they are taken by
    name and cast to the declared types, and anything missing or left over is an
    error. No state may pass from batch to batch, since batches are cut anywhere.
    Nothing is shuffled; an empty partition calls nothing.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out, renamed = to_arrow_schema(declared), dict(names or {})

    def run(batches):
        for whole in batches:
            for start in range(0, len(whole), batch_rows):
                result = fn(whole.slice(start, batch_rows))
                if result is None:
                    continue
                for part in [result] if isinstance(result, (pa.RecordBatch, pa.Table)) else result:
                    yield from _conformed(part, out, renamed)

    return (df.select(*columns) if columns else df).mapInArrow(run, declared)


def melt_batch(ids: list[str], values: list[str], var_name: str, value_name: str):
    """A function for :func:`map_partitions` that turns columns into rows, each with its column's name."""
    def melt(batch: pa.RecordBatch) -> pa.Table:
        parts = [pa.table({**{c: batch.column(c) for c in ids}, var_name: pa.array([v] * len(batch), pa.string()),
                           value_name: batch.column(v)}) for v in values]
        return pa.concat_tables(parts)
    return melt


def argmax_batch(values: list[str], name: str):
    """A function that puts the name of the largest column in front, the first one on ties (D1); NULL if all are."""
    import numpy as np

    def largest(batch: pa.RecordBatch) -> pa.Table:
        x = np.stack([batch.column(v).cast(pa.float64()).to_numpy(zero_copy_only=False) for v in values], axis=1)
        none = np.isnan(x).all(axis=1)
        at = np.where(np.isnan(x), -np.inf, x).argmax(axis=1)
        code = pa.array(np.array(values, object)[at], pa.string(), mask=none)
        return pa.Table.from_arrays([code, *batch.columns], names=[name, *batch.schema.names])
    return largest
