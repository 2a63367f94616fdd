"""Running totals and ordinals that stay parallel when one group holds most of the rows.

A window sorts each group in one task. That is right for groups of up to RANGE_ROWS rows, and they take one shuffle.
Larger groups are found by counting keys, which is reduced before its shuffle; there are at most as many as the table
has times RANGE_ROWS rows. Their rows, and the whole table where a total has no keys, are dealt by (keys, order) into
ranges instead:

1.  the rows are written once by the tasks that made them; counting, sampling and dealing read what those have written;
2.  the ranges are written in order. A larger table has more ranges, not larger ones, and a large group lies in as many as
    it needs;
3.  each (range, group) is totalled, and where a group goes on in a later range the totals of its earlier ranges are
    carried in: one small row per range.

Totals are exact wherever the ranges begin.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablespan.scratch import written_table

RANGE_ROWS = 2_000_000
#: Ranges are not made smaller than this to occupy idle tasks.
LEAST_ROWS = 50_000

_WITHIN_RANGE = (1 << 33) - 1  # Spark's row ids count rows in their lower 33 bits


def ranged(df: DataFrame, keys: list[str], order: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows with `_range`, the number of their range in the order of (keys, order), and `_at`, their place in it
    from 0, written once: boundaries come from a sample and may differ when they are drawn again. There are as many
    ranges as shuffle partitions, fewer where they would get less than LEAST_ROWS rows, more where they would get more
    than `range_rows`. Rows with equal keys and order stay in one range."""
    rows = written_table(df, "unranged")
    n = rows.count()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(tasks, n // LEAST_ROWS), -(-n // range_rows))
    dealt = rows.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
    return written_table(dealt.withColumn("_range", F.spark_partition_id()).withColumn(
        "_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN_RANGE))), "ranges")


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _total_over_ranges(df: DataFrame, keys: list[str], order: list[str], name: str, weight: str | None,
                       range_rows: int) -> DataFrame:
    columns = df.columns
    rows = ranged(df, keys, order, range_rows)
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    parts = rows.groupBy(*keys, "_range").agg(amount.alias("_sum"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    part_keys = [f"_part_{k}" for k in keys]
    carried = written_table(
        parts.select(*keys, "_range", "_first", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
        .toDF(*part_keys, "_part", "_first", "_carried"), "carried")
    if weight:
        within = (Window.partitionBy("_range", *keys).orderBy(*order)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        rows = rows.withColumn("_local", F.sum(weight).over(within))
        local = F.col("_local")
    else:
        local = F.col("_at") - F.col("_first") + 1
    return (rows.join(carried, _same([*keys, "_range"], [*part_keys, "_part"]))
            .select(*columns, (local + F.col("_carried")).alias(name)))


def running_total(df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal",
                  weight: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add `name`: the sum of `weight` (1 per row if None) over the rows of the same `keys` up to
    and including this one in ascending `order`, NULLs first. `keys` may be empty, for one total
    over the whole table. `order` should identify a row within its group: rows with equal order
    stay in one range."""
    if not keys:
        return _total_over_ranges(df, keys, order, name, weight, range_rows)
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_group = lambda rows: rows.withColumn(name, F.sum(F.col(weight) if weight else F.lit(1).cast("long")).over(whole))
    large_keys = [f"_large_{k}" for k in keys]
    large = written_table(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > range_rows)
                          .select(*keys).toDF(*large_keys), "large-groups")
    if large.isEmpty():
        return in_group(df)
    in_large = _same(keys, large_keys)
    return in_group(df.join(large, in_large, "left_anti")).unionByName(
        _total_over_ranges(df.join(large, in_large, "left_semi"), keys, order, name, weight, range_rows))


def top_in_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                 name: str = "ordinal") -> DataFrame:
    """The first k rows of each group with their ordinal. Spark cuts each group to k rows before
    the shuffle (WindowGroupLimit), so a large group costs no more than a small one."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
