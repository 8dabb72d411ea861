"""Repeatable hash keys for splits and samples (ML1, K3).

A row's key depends only on its id and a seed, never on partitioning or
task order, so a re-run or a lost executor gives the same split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 2 ** 32


def hash_key(cols: Column | list[Column], seed: int = 42) -> Column:
    """First 32 bits of md5('<values>|<seed>') as a non-negative BIGINT; several
    values are joined by '|', a NULL among them counts as an empty text."""
    cols = cols if isinstance(cols, (list, tuple)) else [cols]
    text = cols[0].cast("string") if len(cols) == 1 else F.concat_ws(
        "|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    digest = F.md5(F.concat(text, F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def fraction_threshold(fraction: float) -> int:
    return int(round(fraction * HASH_SPACE))


def sql_hash_key(id_expr: str, seed: int = 42) -> str:
    """DuckDB text of :func:`hash_key`."""
    return f"('0x' || substr(md5(cast({id_expr} as varchar) || '|{seed}'), 1, 8))::bigint"
