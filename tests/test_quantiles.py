"""Distributed exact quantiles equal Spark's single-task ``percentile`` exactly."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def test_matches_spark_percentile_with_duplicates_and_a_hot_value(spark):
    rng = np.random.default_rng(3)
    vals = list(np.round(rng.lognormal(5, 1, 3000), 2)) + [42.0] * 1500 + [None] * 10
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    want = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in PROBS]))).first()[0]
    got = exact_quantiles(df, F.col("x"), PROBS)
    assert got == list(want)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, F.col("x"), [0.5]) == [None]
    one = spark.createDataFrame([(7.5,)], "x double")
    assert exact_quantiles(one, F.col("x"), [0.01, 0.99]) == [7.5, 7.5]
