"""Outer joins of more rows than the session's partitions should hold."""

from collections import Counter

import pytest

from tablespan.operators import relational as rel


@pytest.mark.parametrize("hot", ["none", "right", "left"])
def test_large_keep_empty_join(spark, hot):
    left = [(k, f"l{k}") for k in (1, 2, 2, 3, 4, None, None, 6)] + [(9, "x")] * (30 if hot == "left" else 1)
    right = [(k, k * 10) for k in (1, 1, 2, 9, 9)] + [(None, 5), (77, 7)] + [(4, 1)] * (40 if hot == "right" else 2)
    a, b = spark.createDataFrame(left, "k long, a string"), spark.createDataFrame(right, "p long, b long")
    expected = [(k, x, p, y) for k, x in left for p, y in right if k is not None and k == p]
    expected += [(k, x, None, None) for k, x in left if k is None or all(k != p for p, _ in right)]
    for task_rows in (3, 1 << 20):
        got = rel.keep_empty_join(a, "k", b, "p", task_rows=task_rows)
        assert got.columns == ["k", "a", "p", "b"] and Counter(map(tuple, got.collect())) == Counter(expected)


def test_more_rows_are_more_tasks(spark):
    parents, children = spark.range(2000).toDF("k"), spark.range(6000).selectExpr("id % 1500 as p", "id as b")
    plan = rel.keep_empty_join(parents, "k", children, "p", task_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(p" in plan and ", 80), REPARTITION_BY_NUM" in plan and "BroadcastHashJoin" not in plan
