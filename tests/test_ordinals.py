"""Running totals and nesting where one group holds a third of the rows, against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablespan.operators import nested, profile
from tablespan.operators.ordinals import ranged, running_total, top_in_group

SMALL_SAMPLE = dict(range_rows=100)


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; key 0 holds a third, key NULL a tenth; order values repeat across keys."""
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 97).alias("k"),
        (F.col("id") * 7919 % 3001).alias("at"), (F.col("id") % 5).alias("w"))
    return df.cache()


def expected(rows, weight):
    groups = defaultdict(list)
    for r in rows:
        groups[r.k].append(r)
    out = {}
    for members in groups.values():
        total = 0
        for r in sorted(members, key=lambda r: r["at"]):
            total += r.w if weight else 1
            out[r.id] = total
    return out


@pytest.mark.parametrize("sampling", [{}, SMALL_SAMPLE], ids=["one", "many"])
@pytest.mark.parametrize("weight", [None, "w"])
def test_running_total(skewed, sampling, weight):
    got = {r.id: r.total for r in running_total(skewed, ["k"], ["at"], "total", weight, **sampling).collect()}
    assert got == expected(skewed.collect(), weight)


def test_ranges_grow_in_number_with_the_rows(spark):
    def shares(n):
        df = spark.range(n).select(F.when(F.col("id") % 200 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
        rows = ranged(df, ["k"], ["at"], range_rows=n // 400 if n == 40_000 else 100)
        return rows.select("_range").distinct().count(), rows.where("k = -1").select("_range").distinct().count()

    whole, group = shares(40_000)
    twice, larger = shares(80_000)
    # a group of one row in 200 is above the range size, and is divided
    assert whole > 300 and twice > 1.7 * whole and group > 1 and larger > group


def test_input_is_read_twice_at_most(skewed):
    plan = running_total(skewed, ["k"], ["at"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2


def test_total_over_the_whole_table(skewed):
    got = sorted((r["at"], r.ordinal) for r in running_total(skewed, [], ["at"], **SMALL_SAMPLE).collect())
    assert [n for _, n in got] == list(range(1, 3001))


def test_top_in_group_limits_before_the_shuffle(skewed):
    df = top_in_group(skewed, ["k"], [F.col("at")], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Partial") and "WindowGroupLimit" in plan
    assert df.where("k = 0").count() == 3


def test_nested_chunks_are_whole(skewed):
    df = nested.nest(skewed, ["k"], ["id"], ["at"], chunk=50, **SMALL_SAMPLE)
    rows = df.where("k = 0").orderBy("chunk_no").collect()
    want = [r.id for r in sorted(skewed.where("k = 0").collect(), key=lambda r: r["at"])]
    assert len(want) > 1000
    assert [r.chunk_no for r in rows] == list(range(len(rows)))
    assert all(len(r["items"]) == 50 for r in rows[:-1])
    assert [i.id for r in rows for i in r["items"]] == want


def test_height_balanced_histogram_in_ranges(skewed):
    got = {r.bucket: r.endpoint for r in profile.height_balanced_histogram(skewed, "at", 20, **SMALL_SAMPLE).collect()}
    values = sorted(r["at"] for r in skewed.collect())
    assert got == {b: values[-(-b * 3000 // 20) - 1] for b in range(1, 21)}


def test_one_value_may_end_several_buckets(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",), (None,)], "v string")
    got = sorted((r.bucket, r.endpoint) for r in profile.height_balanced_histogram(df, "v", 5).collect())
    assert got == [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "c")]


def test_making_the_rows_stays_parallel(spark):
    """However few the rows are, their scan and filter are not drawn into the task that orders them."""
    df = spark.range(0, 4000, 1, 8).where("id % 7 = 0").select("id", F.spark_partition_id().alias("made_by"))
    assert running_total(df, [], ["id"]).select("made_by").distinct().count() == 8


def test_usual_groups_take_one_shuffle(skewed):
    plan = running_total(skewed, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_group_beyond_the_bound_is_refused_before_it_is_gathered(skewed):
    small = skewed.where("k > 0 or k is null and id < 100")
    got = {r.k: r["items"] for r in nested.bounded_lists(small, ["k"], "id", 60).collect()}
    groups = defaultdict(list)
    for r in small.collect():
        groups[r.k].append(r.id)
    assert got == {k: sorted(v) for k, v in groups.items()} and None in got
    with pytest.raises(Exception, match="more than 60"):
        nested.bounded_lists(skewed, ["k"], "id", 60).collect()
    plan = nested.bounded_lists(skewed, ["k"], "id", 60)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("collect_list") < plan.index("raise_error") < plan.index("partial_count")
