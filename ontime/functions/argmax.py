"""Row-wise argmax over columns (C9) and the delay-code label (C6, ML21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_name(columns: list[str], names: list[str] | None = None) -> Column:
    """Name of the largest column; the first one wins ties.

    ``array_max`` skips NULL entries; a row of all NULL gives NULL.
    """
    names = names or columns
    values = F.array(*[F.col(c).cast("double") for c in columns])
    position = F.array_position(values, F.array_max(values))
    labels = F.array(*[F.lit(n) for n in names])
    return F.when(position > 0, F.element_at(labels, position.cast("int")))


def delay_code(name: Column) -> Column:
    """'LateAircraftDelay' -> 'LateAircraft'."""
    return F.regexp_extract(name, "([A-Za-z]+)Delay", 1)


def sum_of(columns: list[str]) -> Column:
    """Plain '+' over columns: NULL in any term gives NULL."""
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total
