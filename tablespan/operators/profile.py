"""Selectivities, distinct counts and histograms, computed from the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablespan.functions.draws import draw
from tablespan.operators.ordinals import running_total
from tablespan.scratch import written_table

MAX_BUCKETS = 254  # declared upper bound of histogram buckets


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole)


def predicate_selectivity(df: DataFrame, predicate: Column) -> DataFrame:
    """(matched, total, percent) from one pass."""
    counts = df.agg(F.count_if(predicate).alias("matched"), F.count(F.lit(1)).alias("total"))
    return counts.withColumn("percent", F.round(_ratio(F.col("matched"), F.col("total")) * 100, 6))


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """(distinct_values, selectivity = 1 / distinct_values); the approximate form needs no shuffle
    of the values."""
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("distinct_values")).withColumn(
        "selectivity", F.round(_ratio(F.lit(1), F.col("distinct_values")), 10))


def weighted_selectivity(df: DataFrame, column: str) -> DataFrame:
    """Sum of squared group sizes over (non-NULL rows * all rows): the chance of a match when the
    values are not evenly spread. Two grouping steps; the second sees one row per value."""
    groups = df.groupBy(column).agg(F.count(column).alias("_n"), F.count(F.lit(1)).alias("_all"))
    n = F.col("_n").cast("double")
    return groups.agg(F.round(
        F.sum(n * n) / (F.sum(n) * F.sum(F.col("_all").cast("double"))), 10).alias("selectivity"))


def join_selectivity(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Share of non-NULL rows on each side over the larger distinct count, rounded to 10 places."""
    def facts(df: DataFrame, c: str) -> Column:
        return df.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count(c).alias("present"),
                               F.count_distinct(c).alias("ndv"))).scalar()

    one = left.sparkSession.range(1).select(facts(left, left_col).alias("l"), facts(right, right_col).alias("r"))
    share = (_ratio(F.col("l.present"), F.col("l.rows")) * _ratio(F.col("r.present"), F.col("r.rows")))
    return one.select(F.round(share / F.greatest("l.ndv", "r.ndv"), 10).alias("selectivity"))


def composite_distinct(df: DataFrame, combinations: list[list[str]]) -> DataFrame:
    """(columns, distinct_values) for keys of several columns, from one scan."""
    names = [",".join(c) for c in combinations]
    counts = df.agg(*[F.count_distinct(*c).alias(n) for c, n in zip(combinations, names)])
    return counts.unpivot([], names, "columns", "distinct_values")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value as text, n) for several columns from one scan. Rows are counted before
    the shuffle, so what is shuffled grows with the distinct values, not with the rows."""
    typed = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return (typed.unpivot([], columns, "column_name", "value")
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def column_profile(df: DataFrame, columns: list[str], buckets: int = MAX_BUCKETS) -> DataFrame:
    """Per column: rows, nulls, distinct values, density (1 / distinct), histogram kind and size.
    A column with no more values than buckets gets a frequency histogram, else a height-balanced."""
    present = F.col("value").isNotNull()
    ndv = F.count_if(present)
    profile = value_counts(df, columns).groupBy("column_name").agg(
        F.sum("n").alias("num_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("num_nulls"),
        ndv.alias("num_distinct"))
    few = F.col("num_distinct") <= buckets
    return (profile.withColumn("density", F.round(_ratio(F.lit(1), F.col("num_distinct")), 10))
            .withColumn("num_buckets", F.least(F.col("num_distinct"), F.lit(buckets)).cast("long"))
            .withColumn("histogram", F.when(few, F.lit("FREQUENCY")).otherwise(F.lit("HEIGHT BALANCED"))))


def _written_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), written once because the histograms read it several times."""
    return written_table(
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n")), "value-counts")


def frequency_histogram(df: DataFrame, column: str, **sampling) -> DataFrame:
    """(value, n, endpoint): rows per value and the running number of rows in value order."""
    return running_total(_written_counts(df, column), [], ["value"], "endpoint", weight="n", **sampling)


def height_balanced_histogram(df: DataFrame, column: str, buckets: int = MAX_BUCKETS,
                              **sampling) -> DataFrame:
    """(bucket, endpoint) for buckets 1..B: the smallest value up to which at least ceil(b*N/B)
    rows lie. Exact, for any ordered type, texts included."""
    counts = _written_counts(df, column)
    ranked = running_total(counts, [], ["value"], "endpoint", weight="n", **sampling)
    return (ranked.withColumn("_total", counts.agg(F.sum("n")).scalar())
            .withColumn("_from", F.expr(f"((endpoint - n) * {buckets}) div _total") + 1)
            .withColumn("_to", F.expr(f"(endpoint * {buckets}) div _total"))
            .where(F.col("_from") <= F.col("_to"))
            .select(F.explode(F.sequence("_from", "_to")).alias("bucket"), F.col("value").alias("endpoint")))


def sampled_profile(df: DataFrame, columns: list[str], fraction: float, seed: int, keys: list[str]) -> DataFrame:
    """Estimates from a share of the rows, chosen by a hash of their key columns, so that the same
    seed gives the same rows however the files are split. Counts are scaled up; the number of
    distinct values is that of the sample, a lower bound."""
    row_id = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    chosen = draw(row_id, "sample", seed, 0, 1_000_000) < round(fraction * 1_000_000)
    profile = column_profile(df.where(chosen), columns)
    scaled = lambda c: F.round(F.col(c) / fraction).cast("long")
    return profile.select(
        "column_name", F.col("num_rows").alias("sample_size"), scaled("num_rows").alias("num_rows_estimate"),
        scaled("num_nulls").alias("num_nulls_estimate"), F.col("num_distinct").alias("num_distinct_at_least"))


#: Values with more rows than this in a sample are counted as they are, for few like them were missed; the rarer ones tell of
#: those that were. The fewer they are, the better one distribution fits them.
RARE = 4


def estimated_distinct(df: DataFrame, columns: list[str], fraction: float, seed: int, keys: list[str]) -> DataFrame:
    """(column_name, sample_distinct, singletons, doubletons, num_distinct_estimate, at_least, at_most): distinct values of the
    whole table from a share of its rows, chosen as in `sampled_profile`.

    If a row of a rare value has Y more rows of that value in the table, the chance that the sample of share q holds none of
    those is g(1 - q), where g(z) is the mean of z**Y. The sample shows it, as singletons over rows, and its slope, as twice the
    doubletons over q times the rows. With Y negative binomial, those two give g, and the number of values is the number
    of rows times the integral of g from 0 to 1, the mean of 1 / (Y + 1). Even, unique and mixed columns come out within
    a tenth at q = 0.1, Zipf-like ones within an eighth. The bounds hold in expectation whatever the values: all
    singletons are single in the table, or each stands for 1 / q values."""
    row_id = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    chosen = draw(row_id, "sample", seed, 0, 1_000_000) < round(fraction * 1_000_000)
    counts = value_counts(df.where(chosen), columns).where(F.col("value").isNotNull())
    n = F.col("n")
    # the values are counted per number of rows first, so one column's values do not meet in one task
    by_number = counts.groupBy("column_name", n.alias("rows")).agg(F.count(F.lit(1)).alias("values"))
    rows, values = F.col("rows"), F.col("values")
    total = lambda condition, what: F.coalesce(F.sum(F.when(condition, what)), F.lit(0))
    found = by_number.groupBy("column_name").agg(
        F.sum(values).alias("sample_distinct"), total(rows == 1, values).alias("singletons"), total(rows == 2, values).alias("doubletons"),
        total(rows <= RARE, rows * values).cast("double").alias("_n"), total(rows > RARE, values).alias("_frequent"))
    q = fraction
    u = 1 - q
    one, two = F.col("singletons").cast("double"), F.col("doubletons").cast("double")
    # without singletons nothing is left to estimate, and slope and target are NULL
    slope = F.when(one > 0, F.greatest(F.try_divide(2 * two, q * one), F.lit(1e-9)))
    found = found.withColumn("_slope", slope).withColumn("_target", F.ln(F.try_divide(one, F.col("_n"))) / slope)

    def step(at, _):
        t = (at["low"] + at["high"]) / 2
        p = 1 - F.exp(t)
        ratio = F.when(F.abs(p) < 1e-9, F.lit(-q)).otherwise((1 - p * u) / p * (t - F.ln(1 - p * u)))
        above = ratio > F.col("_target")
        return F.struct(F.when(above, at["low"]).otherwise(t).alias("low"), F.when(above, t).otherwise(at["high"]).alias("high"))

    start = F.struct(F.lit(float(LOWEST)).alias("low"), F.lit(float(-LOWEST)).alias("high"))
    found = found.withColumn("_t", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["low"])
    t = F.col("_t")
    p = 1 - F.exp(t)
    found = found.withColumn("_r", F.col("_slope") * (1 - p * u) / p)
    r = F.col("_r")
    share = F.when(F.abs(r - 1) < 1e-9, F.exp(t) / p * -t).otherwise((F.exp(r * t) - F.exp(t)) / (p * (1 - r)))
    least, most = F.col("sample_distinct"), F.round(F.col("sample_distinct") - one + one / q).cast("long")
    seen = F.when(one == 0, least.cast("double")).when(one >= F.col("_n"), most.cast("double")).otherwise(
        F.col("_n") / q * share + F.col("_frequent"))
    return found.select("column_name", "sample_distinct", "singletons", "doubletons",
                        F.greatest(least, F.least(most, F.round(seen).cast("long"))).alias("num_distinct_estimate"),
                        least.alias("at_least"), most.alias("at_most"))


#: Halvings of the interval of ln(1 - p), which covers all there is between even and very uneven columns.
LOWEST, STEPS = -14, 50


def table_profile(tables: dict[str, DataFrame], analysed_at) -> DataFrame:
    """(table_name, num_rows, sample_size, last_analyzed) from full counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(name).alias("table_name"), "num_rows", F.col("num_rows").alias("sample_size"),
        F.lit(analysed_at).alias("last_analyzed")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
