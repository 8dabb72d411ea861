"""Small relational building blocks that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def predicate_counts(li: DataFrame) -> DataFrame:
    """Rows kept by each filter form (F1-F6) and a NULL-skipping sum (N2),
    in one pass. A NULL predicate keeps no row, as in ``filter``."""
    rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    tax, disc = F.col("tax"), F.col("discount")
    return li.agg(
        F.count_if(rf == "R").alias("f1_equal"),
        F.count_if((rf == "R") | (ls == "F")).alias("f2_either"),
        F.count_if((rf == "R") & (q >= 15)).alias("f3_both"),
        F.count_if(tax > 0).alias("f4_positive"),
        F.count_if(q + tax * 100 + disc * 100 > 15).alias("f5_sum"),
        F.count_if(F.col("l_linenumber") == 1).alias("f6_typed"),
        F.sum(tax).alias("n2_sum"),
        F.count(F.lit(1)).alias("n_rows"),
    )
