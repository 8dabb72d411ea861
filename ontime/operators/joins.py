"""Equi-joins with dplyr-style output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast
from ontime.operators.skew import salted_join


def _suffixed(left: DataFrame, right: DataFrame, keys_left, keys_right, suffixes):
    """Rename clashing non-key columns with the suffixes (J8); the kept key
    has the left key's name, so a right column of that name clashes, too."""
    lkeys, rkeys = set(keys_left), set(keys_right)
    lclash = (set(left.columns) - lkeys) & (set(right.columns) - rkeys)
    rclash = set(left.columns) & (set(right.columns) - rkeys)
    lsuf, rsuf = suffixes
    left = left.select(*[F.col(c).alias(c + lsuf) if c in lclash else F.col(c) for c in left.columns])
    right = right.select(*[F.col(c).alias(c + rsuf) if c in rclash else F.col(c) for c in right.columns])
    return left, right


def join_with_suffix(left: DataFrame, right: DataFrame, left_on, right_on=None, how: str = "left",
                     suffixes=("_x", "_y"), salted: bool = False, **salting) -> DataFrame:
    """Join on equal keys and keep one key column named after the left key.

    SQL equality: NULL keys never match. For a full join the kept key is
    ``coalesce(left, right)``. Clashing non-key columns get ``_x`` / ``_y``.
    ``salted`` deals the rows of frequent keys over tasks (:func:`salted_join`,
    which takes the options ``salting``): for fact-sized sides, and full joins above all.
    """
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    left, right = _suffixed(left, right, left_on, right_on, suffixes)
    if salted:
        renamed = right.select(*[F.col(r).alias(lk) for lk, r in zip(left_on, right_on)],
                               *[c for c in right.columns if c not in right_on])
        return salted_join(left, renamed, left_on, how, **salting)
    tmp = [f"__rk{i}" for i in range(len(right_on))]
    right = right.select(*[F.col(r).alias(t) for r, t in zip(right_on, tmp)],
                         *[c for c in right.columns if c not in right_on])
    cond = None
    for lk, t in zip(left_on, tmp):
        term = left[lk] == right[t]
        cond = term if cond is None else cond & term
    joined = left.join(right, cond, how)
    if how in ("full", "outer", "full_outer", "fullouter"):
        joined = joined.select(*[F.coalesce(left[lk], right[t]).alias(lk) for lk, t in zip(left_on, tmp)],
                               *[left[c] for c in left.columns if c not in left_on],
                               *[right[c] for c in right.columns if c not in tmp])
    elif how in ("right", "right_outer"):
        joined = joined.select(*[right[t].alias(lk) for lk, t in zip(left_on, tmp)],
                               *[left[c] for c in left.columns if c not in left_on],
                               *[right[c] for c in right.columns if c not in tmp])
    else:
        joined = joined.drop(*tmp)
    return joined


def lookup(df: DataFrame, dim: DataFrame, left_on: str, right_on: str, how: str = "left",
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, suffixes=("_x", "_y")) -> DataFrame:
    """Fact/aggregate -> dimension lookup (J1-J3); the dimension is broadcast
    only when a bounded count proves it small."""
    return join_with_suffix(df, bounded_broadcast(dim, max_broadcast_rows), left_on, right_on, how,
                            suffixes)


def key_union(df: DataFrame, first: str, second: str, name: str | None = None) -> DataFrame:
    """All values seen in either key column, once each (J4 / U3); one scan,
    deduplicated map-side before the shuffle."""
    name = name or first
    return df.select(F.explode(F.array(F.col(first), F.col(second))).alias(name)).distinct()
