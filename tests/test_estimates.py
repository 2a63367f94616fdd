"""Distinct values from a sample, and draws that read only as much of the pool as they take."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tablespan.operators import profile, synth


@pytest.mark.parametrize("name, expr, within", [
    ("unique", "id", 0.1), ("pairs", "id div 2", 0.1), ("tens", "id div 10", 0.1), ("hundreds", "id div 100", 0.1),
    ("uneven", "if(id % 2 = 0, id, id % 500)", 0.1), ("a third alike", "if(id % 3 = 0, -1, id div 4)", 0.1), ("few", "id % 7", 0.1),
    ("Zipf-like", "cast(pow(1.00003, id % 100000) * 1000 as long)", 0.125)])
def test_estimates_are_near(spark, name, expr, within):
    df = spark.range(200_000).select("id", F.expr(expr).alias("v"))
    r = profile.estimated_distinct(df, ["v"], 0.1, 11, ["id"]).first()
    true = df.select("v").distinct().count()
    assert r.at_least <= true <= 1.1 * r.at_most and abs(r.num_distinct_estimate / true - 1) < within, (name, true, r)


def test_nulls_and_empty_tables(spark):
    df = spark.range(1000).select("id", F.lit(None).cast("string").alias("v"), F.lit("x").alias("w"))
    assert [(r.column_name, r.num_distinct_estimate) for r in profile.estimated_distinct(df, ["v", "w"], 0.1, 11, ["id"]).collect()] == [("w", 1)]
    assert profile.estimated_distinct(df.limit(0), ["v"], 0.1, 11, ["id"]).count() == 0


@pytest.mark.parametrize("takers, pool", [(3, 5000), (400, 5000), (50, 10), (0, 100), (5, 0), (60, 60)])
def test_draws_are_those_of_the_whole_order(spark, takers, pool):
    mixed = sorted((hashlib.md5(f"{i}|s".encode()).hexdigest(), i) for i in range(pool))
    got = dict(synth.drawn_without_repeats(spark.range(pool).withColumnRenamed("id", "v"), "v", spark.range(takers).withColumnRenamed("id", "t"), "t", "s")
               .collect())
    assert got == {t: mixed[t][1] if t < pool else None for t in range(takers)}


def test_equal_pool_values_are_all_found(spark):
    """A limit below which too few rows lie is raised."""
    pool = spark.range(3000).select(F.when(F.col("id") < 2990, 5).otherwise(F.col("id")).alias("v"))
    assert synth.drawn_without_repeats(pool, "v", spark.range(2000).withColumnRenamed("id", "t"), "t", "s").where("v is not null").count() == 2000


def test_the_pool_is_not_sorted_as_a_whole(spark, monkeypatch):
    written = []
    monkeypatch.setattr(synth, "written_table", lambda df, label: written.append(df.count()) or df)
    synth.drawn_without_repeats(spark.range(100_000).withColumnRenamed("id", "v"), "v", spark.range(100).withColumnRenamed("id", "t"), "t", "s")
    assert len(written) == 1 and 100 <= written[0] < 300
