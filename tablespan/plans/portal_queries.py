"""Queries for single operators of the portal and the generator: whole rows as records, fragments for
missing values, control characters, times, bounded collections, stamps, published batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablespan.functions.arrays import bounded
from tablespan.operators import changes, profile
from tablespan.operators.nested import bounded_lists
from tablespan.plans.registry import Tables, query
from tablespan.scratch import new_path

AT = dt.datetime(2024, 3, 1, 12, 0, 0)


@query("whole_rows", "SELECT * FROM supplier")
def _(t: Tables):
    return t.supplier.select(F.struct("*").alias("record")).select("record.*")


@query("fragment_when_present", """
    SELECT c_custkey, c_name || CASE WHEN last IS NULL THEN '' ELSE ' (last order ' || strftime(last, '%Y-%m-%d') || ')' END AS line
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
def _(t: Tables):
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    fragment = F.when(F.col("last").isNull(), "").otherwise(
        F.concat(F.lit(" (last order "), F.date_format("last", "yyyy-MM-dd"), F.lit(")")))
    return (t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", F.concat("c_name", fragment).alias("line")))


@query("max_where", "SELECT max(o_totalprice) AS dearest FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables):
    return t.orders.where("o_orderstatus = 'F'").agg(F.max("o_totalprice").alias("dearest"))


@query("hidden_order", "SELECT c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def _(t: Tables):
    # a top-20 report, ordered by columns it does not show
    return t.customer.orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_name")


@query("line_breaks", """
    SELECT s_suppkey, s_name || chr(13) || chr(10) || n_name AS label, length(s_name || chr(13) || chr(10) || n_name)::INTEGER AS chars
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def _(t: Tables):
    label = F.concat("s_name", F.chr(F.lit(13)), F.chr(F.lit(10)), "n_name")
    return (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", label.alias("label"), F.length(label).alias("chars")))


@query("seconds_of_events", """
    SELECT event_id, extract(second FROM ts)::INTEGER AS sec, extract(minute FROM ts)::INTEGER AS minute FROM events""")
def _(t: Tables):
    return t.events.select("event_id", F.floor(F.expr("extract(second FROM ts)")).cast("int").alias("sec"),
                           F.expr("extract(minute FROM ts)").alias("minute"))


@query("time_between_events", """
    SELECT user_id, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds
    FROM events GROUP BY user_id""")
def _(t: Tables):
    first, last = F.date_trunc("second", F.min("ts")), F.date_trunc("second", F.max("ts"))
    return t.events.groupBy("user_id").agg((last - first).alias("span")).select(
        "user_id", F.expr("extract(day FROM span) * 86400 + extract(hour FROM span) * 3600 + extract(minute FROM span) * 60"
                          " + cast(extract(second FROM span) AS bigint)").cast("long").alias("seconds"))


@query("bounded_lists", """
    SELECT l_orderkey, string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS lines, count(*)::INTEGER AS n FROM lineitem GROUP BY l_orderkey""")
def _(t: Tables):
    # an order has few lines; one with more than 50 would be an error, not a shorter list
    lines = bounded_lists(t.lineitem, ["l_orderkey"], "l_linenumber", 50, "all")
    kept = bounded(F.col("all"), 50)
    return lines.select("l_orderkey", F.array_join(kept.cast("array<string>"), ",").alias("lines"), F.size(kept).alias("n"))


@query("stamped_rows", """
    SELECT o_orderkey, TIMESTAMP '2024-03-01 12:00:00' AS o_orderdate FROM orders""")
def _(t: Tables):
    return changes.stamp(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", AT).select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


@query("published_batch", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables):
    """The first batch is complete and published; the second lacks a row and leaves no trace."""
    table = changes.SnapshotTable(t.spark, new_path(t.spark, "snapshots"))
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    table.publish(orders.where("o_orderstatus = 'F'"), AT)
    table.publish(orders.where("o_orderstatus = 'O'"), AT, expected_rows=-1)
    return table.current()


_PROFILED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query("table_profile", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS num_rows, count(*) AS sample_size, TIMESTAMP '2024-03-01 12:00:00' AS last_analyzed FROM {n}"
    for n in _PROFILED))
def _(t: Tables):
    found = profile.table_profile({n: getattr(t, n) for n in _PROFILED}, AT)
    return found.withColumn("last_analyzed", F.col("last_analyzed").cast("timestamp_ntz"))


@query("audit_two_columns", """
    SELECT l_orderkey, l_linenumber FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey
                      WHERE o_orderkey = l_orderkey AND c_nationkey % 5 = l_linenumber % 5)""")
def _(t: Tables):
    # a reference of two columns, each of which alone would often resolve
    from tablespan.operators import quality

    parents = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", (F.col("c_nationkey") % 5).alias("class"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") % 5).alias("class"))
    return quality.unresolved(lines, ["l_orderkey", "class"], parents, ["o_orderkey", "class"]).select("l_orderkey", "l_linenumber")
