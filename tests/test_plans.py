"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry
from tablespan.plans import JOBS

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in JOBS if not n.startswith("stream_")])
def test_no_all_pairs_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["filter_eq_conj"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,F)" in text and "o_totalprice" not in text


def test_key_range_is_inferred_for_the_other_side(spark):
    text = plan(entry.queries()["join_key_range"](spark, FOLDER))
    assert "LessThanOrEqual(o_custkey,100)" in text and "LessThanOrEqual(c_custkey,100)" in text


def test_mean_year_bounds_share_one_aggregate(spark):
    text = plan(entry.queries()["within_years_of_mean"](spark, FOLDER))
    assert "named_struct(make_timestamp_ntz" in text


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["three_youngest"](spark, FOLDER))


def test_children_are_counted_before_their_shuffle(spark):
    text = plan(entry.queries()["books_per_category"](spark, FOLDER))
    assert "partial_count" in text


def test_sessions_merge_within_each_task_first(spark):
    from pyspark.sql import functions as F

    from tablespan.streaming import jobs

    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    stream = jobs.arriving(spark, FOLDER, "events.parquet", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    with jobs._stream_settings(spark):
        assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition") == "true"
    assert jobs.sessions(stream, "user_id", "ts", "12 hours", "1 day").isStreaming
