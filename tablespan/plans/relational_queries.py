"""Joins, semi-joins, aggregates, windows and top-k on the star tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablespan.operators import relational as rel
from tablespan.operators.nested import slots
from tablespan.operators.ordinals import running_total
from tablespan.scratch import written_table
from tablespan.plans.registry import Tables, query
from tablespan.sources.tables import named_view


@query("books_per_category", """
    SELECT o.o_orderkey, COALESCE(v.n, 0) AS line_count
    FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) v
      ON o.o_orderkey = v.l_orderkey""")
def _(t: Tables):
    return rel.child_counts(t.orders.select("o_orderkey"), "o_orderkey", t.lineitem, "l_orderkey", "line_count")


@query("books_per_category_view", """
    SELECT o.o_orderkey AS order_id, o.o_orderpriority AS priority, COALESCE(v.n, 0) AS line_count
    FROM orders o LEFT JOIN (SELECT l_orderkey, count(l_orderkey) AS n FROM lineitem GROUP BY l_orderkey) v
      ON o.o_orderkey = v.l_orderkey""")
def _(t: Tables):
    named_view(t.lineitem.groupBy("l_orderkey").agg(F.count("l_orderkey")),
               "tablespan_line_counts", ["order_id", "line_count"])
    t.orders.createOrReplaceTempView("tablespan_orders")
    named_view(t.spark.sql("""
        SELECT o.o_orderkey, o.o_orderpriority, coalesce(v.line_count, 0)
        FROM tablespan_orders o LEFT JOIN tablespan_line_counts v ON o.o_orderkey = v.order_id"""),
        "tablespan_order_sizes", ["order_id", "priority", "line_count"])
    return t.spark.table("tablespan_order_sizes")


@query("left_join_sorted", """
    SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_custkey % 30 = n_nationkey
    ORDER BY c_name""")
def _(t: Tables):
    n = t.nation
    return (t.customer.join(n, F.col("c_custkey") % 30 == n.n_nationkey, "left")
            .select("c_custkey", "c_name", "n_name").orderBy("c_name"))


@query("inner_join_comma", """
    SELECT s.s_suppkey, s.s_name, n.n_name FROM supplier s, nation n WHERE s.s_nationkey = n.n_nationkey""")
def _(t: Tables):
    s, n = t.supplier.alias("s"), t.nation.alias("n")
    return (s.join(n, F.col("s.s_nationkey") == F.col("n.n_nationkey"))
            .select("s.s_suppkey", "s.s_name", "n.n_name"))


@query("outer_plus_keep_empty", """
    SELECT o_orderkey, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def _(t: Tables):
    return (rel.keep_empty_join(t.orders.select("o_orderkey"), "o_orderkey",
                                t.lineitem.select("l_orderkey", "l_partkey"), "l_orderkey")
            .select("o_orderkey", "l_partkey"))


@query("right_join_count", """
    SELECT n.n_name, count(*) AS n_rows, count(n.n_nationkey) AS n_matched
    FROM (SELECT * FROM nation WHERE n_regionkey <> 0) n RIGHT JOIN customer c ON n.n_nationkey = c.c_nationkey
    GROUP BY n.n_name""")
def _(t: Tables):
    n = t.nation.where("n_regionkey <> 0")
    return (n.join(t.customer, n.n_nationkey == F.col("c_nationkey"), "right").groupBy("n_name")
            .agg(F.count("*").alias("n_rows"), F.count("n_nationkey").alias("n_matched")))


@query("join_filter_count", """
    SELECT count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'MACHINERY' AND o_orderpriority = '2-HIGH'""")
def _(t: Tables):
    # the condition on the right side makes the outer join an inner one
    return (t.orders.where(F.col("o_orderpriority") == "2-HIGH")
            .join(t.customer.where(F.col("c_mktsegment") == "MACHINERY"), F.col("o_custkey") == F.col("c_custkey"))
            .agg(F.count("*").alias("n")))


@query("join_key_range", """
    SELECT count(*) AS n FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey <= 100""")
def _(t: Tables):
    # the range reaches both scans: it is inferred for the other side of the key
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .where(F.col("c_custkey") <= 100).agg(F.count("*").alias("n")))


@query("four_table_left", """
    SELECT c_custkey, o_orderkey, l_partkey, p_name
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey
    WHERE c_nationkey = 7""")
def _(t: Tables):
    # from the one nation outwards: its orders and their lines are few, so they are reduced first and each is read once
    customers = t.customer.where("c_nationkey = 7").select("c_custkey")
    orders = t.orders.select("o_custkey", "o_orderkey").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    orders = written_table(orders, "orders-of-nation")
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    part = t.part.select("p_partkey", "p_name")
    named = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return (customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(named, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("c_custkey", "o_orderkey", "l_partkey", "p_name"))


@query("nested_in_3", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_custkey IN (
      SELECT c_custkey FROM customer WHERE c_nationkey IN (
        SELECT n_nationkey FROM nation WHERE n_regionkey IN (
          SELECT r_regionkey FROM region WHERE r_name = 'ASIA')))""")
def _(t: Tables):
    return rel.semi_chain(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), [
        rel.Level("o_custkey", t.customer, "c_custkey", unique=True),
        rel.Level("c_nationkey", t.nation, "n_nationkey", unique=True),
        rel.Level("n_regionkey", t.region.where("r_name = 'ASIA'"), "r_regionkey", unique=True),
    ]).select("o_orderkey", "o_orderstatus")


@query("nested_in_4", """
    SELECT DISTINCT p_brand FROM part WHERE p_partkey IN (
      SELECT l_partkey FROM lineitem WHERE l_orderkey IN (
        SELECT o_orderkey FROM orders WHERE o_custkey IN (
          SELECT c_custkey FROM customer WHERE c_nationkey IN (
            SELECT n_nationkey FROM nation WHERE n_name = 'NATION_3'))))""")
def _(t: Tables):
    return rel.semi_chain(t.part.select("p_partkey", "p_brand"), [
        rel.Level("p_partkey", t.lineitem, "l_partkey"),
        rel.Level("l_orderkey", t.orders, "o_orderkey", unique=True),
        rel.Level("o_custkey", t.customer, "c_custkey", unique=True),
        rel.Level("c_nationkey", t.nation.where("n_name = 'NATION_3'"), "n_nationkey", unique=True),
    ]).select("p_brand").distinct()


@query("favourites_of_user", """
    SELECT p_partkey, p_name FROM part WHERE p_partkey IN (
      SELECT l_partkey FROM lineitem WHERE l_orderkey IN (
        SELECT o_orderkey FROM orders WHERE o_custkey = (
          SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000007')))""")
def _(t: Tables):
    # a scalar subquery: fails if the name is not unique
    user = t.customer.where("c_name = 'Customer#000000007'").select("c_custkey").scalar()
    return rel.semi_chain(t.part.select("p_partkey", "p_name"), [
        rel.Level("p_partkey", t.lineitem, "l_partkey"),
        rel.Level("l_orderkey", t.orders.where(F.col("o_custkey") == user), "o_orderkey", unique=True)])


@query("count_in_top3", """
    SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_partkey IN (
      SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 3)""")
def _(t: Tables):
    return (rel.rows_in_top_groups(t.lineitem.select("l_partkey", "l_returnflag"), "l_partkey", 3)
            .where("l_returnflag = 'R'").agg(F.count("*").alias("n")))


@query("join_hints_agree", "\nUNION ALL\n".join(f"""
    SELECT '{s}' AS strategy, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderpriority""" for s in rel.STRATEGIES))
def _(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderpriority")
    builders = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    parts = [rel.join_with(orders, builders, orders.o_custkey == builders.c_custkey, "inner", s)
             .groupBy("o_orderpriority").agg(F.count("*").alias("n"))
             .select(F.lit(s).alias("strategy"), "o_orderpriority", "n") for s in rel.STRATEGIES]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- filters


@query("filter_eq_conj", """
    SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def _(t: Tables):
    return (t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
            .agg(F.count("*").alias("n")))


@query("filter_prefix_date", """
    SELECT count(*) AS n FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '4%' AND o_orderdate >= TIMESTAMP '1999-01-01'""")
def _(t: Tables):
    return (t.orders.where((F.col("o_orderstatus") == "O") & F.col("o_orderpriority").startswith("4")
                           & (F.col("o_orderdate") >= F.expr("timestamp_ntz'1999-01-01'")))
            .agg(F.count("*").alias("n")))


@query("title_words", """
    SELECT p_partkey, title, CASE WHEN title LIKE '% %' THEN 'several' WHEN title NOT LIKE '% %' THEN 'one' END AS words
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS title FROM part)""")
def _(t: Tables):
    title = F.col("title")
    return (t.part.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.col("p_name"))
                          .otherwise(F.col("p_type")).alias("title"))
            .withColumn("words", F.when(title.like("% %"), "several").when(~title.like("% %"), "one")))


@query("search_title_ci", """
    SELECT p_partkey, p_name, COALESCE(n_name, 'Brak') AS category
    FROM part LEFT JOIN nation ON p_partkey % 30 = n_nationkey
    WHERE lower(p_name) LIKE lower('%RiNg%')""")
def _(t: Tables):
    n = t.nation
    return (rel.search_titles(t.part, "p_name", "RiNg").join(n, F.col("p_partkey") % 30 == n.n_nationkey, "left")
            .select("p_partkey", "p_name", F.coalesce("n_name", F.lit("Brak")).alias("category")))


@query("between_count", """
    SELECT c_custkey, c_name, n FROM customer JOIN (
      SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey
    WHERE n BETWEEN 8 AND 11""")
def _(t: Tables):
    return (rel.child_counts(t.customer.select("c_custkey", "c_name"), "c_custkey", t.orders, "o_custkey", "n")
            .where(F.col("n").between(8, 11)))


@query("born_between_years", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'""")
def _(t: Tables):
    return (rel.year_range(t.orders, "o_orderdate", 1996, 1998)
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))


@query("in_list", """
    SELECT o_orderpriority, count(*) AS n FROM orders
    WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '5-LOW' GROUP BY o_orderpriority""")
def _(t: Tables):
    return (t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
            .groupBy("o_orderpriority").agg(F.count("*").alias("n")))


@query("within_years_of_mean", """
    SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate BETWEEN
      (SELECT make_timestamp(CAST(floor(avg(year(o_orderdate))) AS BIGINT) - 1, 1, 1, 0, 0, 0) FROM orders)
      AND (SELECT make_timestamp(CAST(floor(avg(year(o_orderdate))) AS BIGINT) + 1, 1, 1, 0, 0, 0) FROM orders)""")
def _(t: Tables):
    return (rel.near_mean_year(t.orders, "o_orderdate", 1)
            .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name"))


# ---------------------------------------------------------------- aggregates, top-k, windows


@query("count_per_group", "SELECT o_custkey, count(o_custkey) AS n FROM orders GROUP BY o_custkey")
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.count("o_custkey").alias("n"))


@query("avg_per_group", "SELECT p_brand, round(avg(p_size), 6) AS mean_size FROM part GROUP BY p_brand")
def _(t: Tables):
    return t.part.groupBy("p_brand").agg(F.round(F.avg("p_size"), 6).alias("mean_size"))


@query("top_one", """
    SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 1""")
def _(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return rel.top_rows(counts, [F.desc("n"), F.asc("o_custkey")], 1)


@query("three_youngest", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, c_name
    FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 3""")
def _(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return (rel.top_rows(joined, [F.desc("o_orderdate"), F.asc("o_orderkey")], 3)
            .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "c_name"))


@query("text_histogram", """
    SELECT o_custkey, n, CAST(1 AS BIGINT) AS rows_per_mark, repeat('+', n) AS bar
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ORDER BY length(bar) DESC, o_custkey""")
def _(t: Tables):
    return rel.text_bars(t.orders, "o_custkey")


@query("ordinal_in_group", """
    SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ordinal
    FROM orders""")
def _(t: Tables):
    return (running_total(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"],
                          ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "ordinal"))


@query("running_count", """
    SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
      count(*) OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice
                     ROWS UNBOUNDED PRECEDING) AS lines_so_far
    FROM lineitem""")
def _(t: Tables):
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return running_total(t.lineitem.select("l_partkey", *order), ["l_partkey"], order, "lines_so_far")


@query("first_three_slots", """
    SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderkey END) AS order1,
      max(CASE WHEN rn = 2 THEN o_orderkey END) AS order2, max(CASE WHEN rn = 3 THEN o_orderkey END) AS order3
    FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
          FROM orders) GROUP BY o_custkey""")
def _(t: Tables):
    return slots(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"],
                 ["o_orderdate", "o_orderkey"], "o_orderkey", 3, "order")
