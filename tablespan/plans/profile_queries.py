"""Selectivities and histograms of the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.functions.text import percent_text
from tablespan.operators import profile
from tablespan.operators.synth import drawn_without_repeats
from tablespan.plans.registry import Tables, query

RETURNED = "l_returnflag = 'R' AND l_quantity < 10"


@query("predicate_selectivity", f"""
    SELECT count(*) FILTER (WHERE {RETURNED}) AS matched, count(*) AS total,
      round(count(*) FILTER (WHERE {RETURNED}) * 1.0::DOUBLE / count(*) * 100, 6) AS percent FROM lineitem""")
def _(t: Tables):
    return profile.predicate_selectivity(t.lineitem, F.expr(RETURNED))


@query("selectivity_fmt", """
    SELECT o_orderpriority, printf('%010.6f', n * 1.0::DOUBLE / (SELECT count(*) FROM orders) * 100) AS percent
    FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)""")
def _(t: Tables):
    total = t.orders.agg(F.count("*")).scalar()
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return counts.select("o_orderpriority", percent_text(F.col("n").cast("double") / total).alias("percent"))


@query("ndv", """
    SELECT count(DISTINCT o_custkey) AS distinct_values, round(1.0::DOUBLE / count(DISTINCT o_custkey), 10) AS selectivity
    FROM orders""")
def _(t: Tables):
    return profile.distinct_count(t.orders, "o_custkey")


COMBINATIONS = [["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus", "l_linenumber"]]


@query("composite_ndv", " UNION ALL ".join(
    f"SELECT '{','.join(c)}' AS columns, count(*) AS distinct_values FROM (SELECT DISTINCT {', '.join(c)} FROM lineitem)"
    for c in COMBINATIONS))
def _(t: Tables):
    return profile.composite_distinct(t.lineitem, COMBINATIONS)


@query("skew_selectivity", """
    SELECT round(sum(n::DOUBLE * n) / (sum(n::DOUBLE) * sum(a::DOUBLE)), 10) AS selectivity
    FROM (SELECT count(c_mktsegment) AS n, count(*) AS a FROM customer GROUP BY c_mktsegment)""")
def _(t: Tables):
    return profile.weighted_selectivity(t.customer, "c_mktsegment")


@query("join_selectivity", """
    WITH o AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS k FROM orders),
    c AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS k FROM customer)
    SELECT round((SELECT count(k)::DOUBLE / count(*) FROM o) * (SELECT count(k)::DOUBLE / count(*) FROM c)
      / greatest((SELECT count(DISTINCT k) FROM o), (SELECT count(DISTINCT k) FROM c)), 10) AS selectivity""")
def _(t: Tables):
    o = t.orders.select(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("k"))
    c = t.customer.select(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("k"))
    return profile.join_selectivity(o, "k", c, "k")


PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "late_key"]
ORDERS = "(SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 300 END AS late_key FROM orders)"


@query("column_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS num_rows, count(*) - count({c}) AS num_nulls,
      count(DISTINCT {c}) AS num_distinct, round(1.0::DOUBLE / count(DISTINCT {c}), 10) AS density,
      least(count(DISTINCT {c}), 254) AS num_buckets,
      CASE WHEN count(DISTINCT {c}) <= 254 THEN 'FREQUENCY' ELSE 'HEIGHT BALANCED' END AS histogram
    FROM {ORDERS}""" for c in PROFILED))
def _(t: Tables):
    orders = t.orders.withColumn("late_key", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey") % 300))
    return profile.column_profile(orders, PROFILED)


@query("freq_histogram", """
    SELECT value, n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS endpoint
    FROM (SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type)""")
def _(t: Tables):
    return profile.frequency_histogram(t.events, "event_type")


def _height_balanced_sql(table: str, column: str) -> str:
    return f"""
    WITH cum AS (SELECT v, sum(n) OVER (ORDER BY v) AS c FROM (
      SELECT {column} AS v, count(*) AS n FROM {table} GROUP BY {column})),
    buckets AS (SELECT unnest(range(1, 255)) AS bucket)
    SELECT bucket, min(v) AS endpoint FROM buckets JOIN cum
      ON c >= ceil(bucket * (SELECT count(*) FROM {table}) / 254.0::DOUBLE) GROUP BY bucket"""


@query("equi_height_histogram", _height_balanced_sql("lineitem", "l_partkey"))
def _(t: Tables):
    return profile.height_balanced_histogram(t.lineitem, "l_partkey")


@query("equi_height_histogram_text", _height_balanced_sql("orders JOIN customer ON o_custkey = c_custkey", "c_name"))
def _(t: Tables):
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name")
    return profile.height_balanced_histogram(named, "c_name")


@query("sample_without_repl", """
    SELECT s_suppkey, p_partkey FROM
      (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS rn FROM supplier) s LEFT JOIN
      (SELECT p_partkey, row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR) || '|seed'), p_partkey) AS rn FROM part) p
      ON s.rn = p.rn""")
def _(t: Tables):
    return drawn_without_repeats(t.part, "p_partkey", t.supplier, "s_suppkey", "seed")
