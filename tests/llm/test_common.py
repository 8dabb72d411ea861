from pyspark.sql import functions as F

from ontime.llm.common import hash_sample


def test_sample_is_full_whatever_the_keys(spark):
    for ids in (1, 2, 3, 20_000):
        df = spark.range(20_000).select((F.col("id") % ids).alias("k"), F.col("id").alias("v")).repartition(3)
        got = hash_sample(df, "k", 500)
        assert got.count() == 500
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, hash_sample(df.repartition(5), "k", 500).collect()))
    same = spark.range(5_000).select(F.lit(1).alias("k"), (F.col("id") % 2).alias("v"))
    assert sorted(map(tuple, hash_sample(same, "k", 500).collect())) == [(1, 0), (1, 1)]
    assert hash_sample(df.limit(0), "k", 5).collect() == [] and hash_sample(df, "k", 10 ** 6).count() == 20_000
