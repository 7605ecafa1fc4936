"""Exact selection of n rows without handing a task or the driver more than a few of them."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from corpusmap.operators import rows


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 7, 1500, 4999, 5000, 9000])
def test_smallest(spark, n):
    df = spark.range(5000).repartition(7)
    order = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    got = rows.smallest(df, n, F.md5(F.col("id").cast("string")))
    assert sorted(r.id for r in got.collect()) == sorted(sorted(range(5000), key=order)[:n])
    if 0 < n < 5000:
        assert "Limit" not in plan_of(got) and "Sort" not in plan_of(got)


def test_smallest_of_copies(spark):
    """One id holds most rows: it fills up the number, whatever its place is."""
    df = spark.range(6000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("id")).repartition(5)
    order = F.md5(F.col("id").cast("string"))
    for n in (1, 1000, 3999, 5500):
        got = [r.id for r in rows.smallest(df, n, order).collect()]
        assert len(got) == n
        ranked = sorted([1] * 4000 + list(range(4000, 6000)), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert sorted(got) == sorted(ranked[:n])


@pytest.mark.parametrize("most", [0, 1, 99, 2500, 2999, 3000, 4000])
def test_cap(spark, most):
    for kind in ("bigint", "string"):
        df = spark.range(3000).select(F.col("id").cast(kind).alias("key")).repartition(6)
        want = sorted((r.key for r in df.collect()))[:most]
        got = rows.cap(df, most, "key")
        assert [r.key for r in got.collect()] == want
        assert "Limit" not in plan_of(got) or most == 0


def test_cap_with_nulls_and_copies(spark):
    values = [None] * 30 + [5] * 200 + list(range(100))
    df = spark.createDataFrame([(v, "x") for v in values], "id int, upto string").repartition(4)
    ranked = sorted(values, key=lambda v: (v is not None, v or 0))
    for most in (10, 30, 33, 100, 230, 330):
        assert [r.id for r in rows.cap(df, most).collect()] == ranked[:most]


@pytest.mark.parametrize("mean", [0.0, 0.3, 2.5])
def test_poisson(spark, mean):
    df = spark.range(20_000).withColumn("times", F.lit("x"))
    got = rows.sample_with_replacement(df, mean, seed=3)
    assert got.columns == ["id", "times"]
    counts = got.groupBy("id").count().groupBy("count").agg(F.count("*").alias("n")).collect()
    for k in (1, 2, 3):
        share = sum(r.n for r in counts if r["count"] == k) / 20_000
        assert abs(share - math.exp(-mean) * mean**k / math.factorial(k)) < 0.012
    again = rows.sample_with_replacement(df.repartition(5), mean, seed=3)
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in got.collect())
