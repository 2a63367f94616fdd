"""Snapshot changes on customers, parts, orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.operators import changes
from tablespan.operators.relational import references_or_creates
from tablespan.plans.registry import Tables, query
from tablespan.scratch import new_path
from tablespan.sources.contracts import Contract, column, refers
from tablespan.sources.tables import append_rows, read_table
from tablespan.sources.tableset import Refused, TableSet


@query("assign_ids", """
    WITH src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS id FROM orders)
    SELECT o_orderkey, COALESCE(id, (SELECT max(id) FROM src)
      + row_number() OVER (PARTITION BY id IS NULL ORDER BY o_orderkey)) AS id FROM src""")
def _(t: Tables):
    key = F.col("o_orderkey")
    src = t.orders.select("o_orderkey", F.when(key % 7 != 0, key).alias("id"))
    return changes.assign_ids(src, "id", ["o_orderkey"])


PART = Contract("part", [
    column("p_partkey", "long"), column("p_name", "text", 30),
    column("p_brand", "text", 10, default="Brand#0"), column("p_size", "int", default=1)])


@query("insert_defaults", """
    SELECT p_partkey, p_name, p_brand, p_size FROM part
    UNION ALL
    SELECT p_partkey + (SELECT max(p_partkey) FROM part) + 1, p_name, 'Brand#0',
      CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END FROM part""")
def _(t: Tables):
    top = t.part.agg(F.max("p_partkey") + 1).scalar()
    # no brand column at all; a supplied NULL size stays NULL
    incoming = t.part.select((F.col("p_partkey") + top).alias("p_partkey"), "p_name",
                             F.when(F.col("p_partkey") % 3 != 0, F.col("p_size")).alias("p_size"))
    return changes.insert_rows(t.part, incoming, PART)


ACCOUNTS = """SELECT c_custkey, c_mktsegment,
      CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer"""


def _accounts(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment",
                             F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"))


@query("update_where", f"""
    SELECT c_custkey, CASE WHEN balance < 1000 THEN 'LOW' ELSE c_mktsegment END AS c_mktsegment,
      CASE WHEN balance < 1000 THEN 0 ELSE balance END AS balance FROM ({ACCOUNTS})""")
def _(t: Tables):
    return changes.update_where(_accounts(t), F.col("balance") < 1000,
                                {"c_mktsegment": F.lit("LOW"), "balance": F.lit(0.0)})


@query("delete_where", f"""
    SELECT * FROM ({ACCOUNTS})
    WHERE NOT COALESCE(c_mktsegment = 'BUILDING' OR balance <= 4000.0, false)""")
def _(t: Tables):
    return changes.delete_where(_accounts(t), "c_mktsegment = 'BUILDING' OR balance <= 4000.0")[0]


@query("delete_report", f"""
    SELECT count(*) FILTER (WHERE hit) AS removed, count(*) FILTER (WHERE NOT hit) AS kept
    FROM (SELECT COALESCE(c_mktsegment = 'BUILDING' OR balance <= 4000.0, false) AS hit FROM ({ACCOUNTS}))""")
def _(t: Tables):
    return changes.delete_where(_accounts(t), "c_mktsegment = 'BUILDING' OR balance <= 4000.0")[1]


@query("upsert_dim", """
    WITH src AS (SELECT c_custkey * 2 AS key, c_name, c_nationkey FROM customer)
    SELECT c.c_custkey, CASE WHEN s.key IS NULL THEN c.c_name ELSE upper(c.c_name) END AS c_name,
      COALESCE(s.c_nationkey, c.c_nationkey) AS c_nationkey
    FROM customer c LEFT JOIN src s ON c.c_custkey = s.key
    UNION ALL
    SELECT key, c_name, c_nationkey FROM src WHERE key NOT IN (SELECT c_custkey FROM customer)""")
def _(t: Tables):
    target = t.customer.select("c_custkey", "c_name", "c_nationkey")
    source = t.customer.select((F.col("c_custkey") * 2).alias("key"), "c_name", "c_nationkey")
    return changes.merge_rows(
        target, source, "c_custkey", "key",
        update={"c_name": F.upper("c_name"), "c_nationkey": F.col("src.c_nationkey")},
        insert={"c_custkey": F.col("src.key"), "c_name": F.col("src.c_name"), "c_nationkey": F.col("src.c_nationkey")})


@query("maintained_count", """
    SELECT c_custkey, COALESCE(n, c_custkey % 5) AS order_count FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
      ON c_custkey = o_custkey""")
def _(t: Tables):
    parents = t.customer.select("c_custkey", (F.col("c_custkey") % 5).alias("order_count"))
    return changes.maintained_counts(parents, "c_custkey", "order_count",
                                     t.orders.where("o_orderpriority = '1-URGENT'"), "o_custkey")


@query("expand_template", """
    SELECT s_suppkey, number, s_name || CAST(number AS VARCHAR) AS login,
      CAST(number AS VARCHAR) || lower(s_name) || '@mail.pl' AS email
    FROM (SELECT s_suppkey, s_name, unnest(range(1, s_suppkey % 9 + 1)) AS number FROM supplier)""")
def _(t: Tables):
    number = F.col("number").cast("string")
    return (changes.numbered_copies(t.supplier.select("s_suppkey", "s_name"), F.col("s_suppkey") % 9)
            .select("s_suppkey", "number", F.concat("s_name", number).alias("login"),
                    F.concat(number, F.lower("s_name"), F.lit("@mail.pl")).alias("email")))


@query("get_or_create_dim", """
    WITH facts AS (SELECT c_custkey, 'NATION_' || CAST(c_custkey % 40 AS VARCHAR) AS name FROM customer),
    fresh AS (SELECT DISTINCT name FROM facts WHERE name NOT IN (SELECT n_name FROM nation)),
    dim AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation
      UNION ALL SELECT (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY name), name FROM fresh)
    SELECT c_custkey, f.name, id FROM facts f JOIN dim d ON f.name = d.name""")
def _(t: Tables):
    facts = t.customer.select("c_custkey", F.concat(
        F.lit("NATION_"), (F.col("c_custkey") % 40).cast("string")).alias("name"))
    nations = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("dim_name"))
    return references_or_creates(facts, "name", nations, "id", "dim_name")[0].select("c_custkey", "name", "id")


@query("session_expiry", """
    SELECT user_id, strftime(max(ts) + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S.%f') AS valid_until
    FROM events GROUP BY user_id""")
def _(t: Tables):
    return (changes.session_expiry(t.events, "user_id", "ts", 7)
            .select("user_id", F.date_format("valid_until", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("valid_until")))


GROUP = [
    Contract("region", [column("r_regionkey", "long"), column("r_name", "text", 25)], key=("r_regionkey",)),
    Contract("nation", [column("n_nationkey", "long"), column("n_regionkey", "long")], key=("n_nationkey",),
             references=(refers("n_regionkey", "region", "r_regionkey"),)),
    Contract("customer", [column("c_custkey", "long"), column("c_nationkey", "long")], key=("c_custkey",),
             references=(refers("c_nationkey", "nation", "n_nationkey"),))]

_FEWER = "SELECT n_nationkey FROM nation WHERE n_regionkey < 2"


@query("reload_group", f"""
    SELECT 'region' AS table_name, count(*) AS first, count(*) AS after_refusal, count(*) FILTER (r_regionkey < 2) AS last FROM region
    UNION ALL SELECT 'nation', count(*), count(*), count(*) FILTER (n_regionkey < 2) FROM nation
    UNION ALL SELECT 'customer', count(*), count(*), count(*) FILTER (c_nationkey IN ({_FEWER})) FROM customer""")
def _(t: Tables):
    """Three related tables are loaded; a reload whose customers lack nations leaves all three as they were; a whole one
    switches all three."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    regions, nations = t.region.where("r_regionkey < 2"), t.nation.where("n_regionkey < 2")
    names = [c.name for c in GROUP]

    def counts(name):
        parts = [tables.read(n).agg(F.count(F.lit(1)).alias(name)).select(F.lit(n).alias("table_name"), name) for n in names]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    tables.reload({"customer": t.customer, "nation": t.nation, "region": t.region}, GROUP)
    first = counts("first")
    try:
        tables.reload({"region": regions, "nation": nations, "customer": t.customer}, GROUP)
    except Refused:
        pass
    kept = counts("after_refusal")
    some = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    tables.reload({"region": regions, "nation": nations, "customer": some}, GROUP)
    return first.join(kept, "table_name").join(counts("last"), "table_name")


@query("upsert_by_file", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
    UNION ALL
    SELECT o_orderkey + (SELECT max(o_orderkey) FROM orders) + 1, 'O', o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def _(t: Tables):
    """Part-filled orders are finished and followed by new ones; only the files that hold them are written again."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    tables.replace({"orders": t.orders.select(*columns)})
    tables.compact("orders", ["o_orderkey"], 16)
    part = t.orders.where("o_orderstatus = 'P'").select("o_orderkey", F.col("o_totalprice").alias("price"))
    top = t.orders.agg(F.max("o_orderkey") + 1).scalar()
    source = part.withColumn("follows", F.lit(False)).unionByName(
        part.select((F.col("o_orderkey") + top).alias("o_orderkey"), "price", F.lit(True).alias("follows")))
    tables.merge("orders", source.withColumnRenamed("o_orderkey", "key"), "o_orderkey", "key",
                 update={"o_orderstatus": F.lit("F"), "o_totalprice": F.col("src.price") + 1},
                 insert={"o_orderkey": F.col("src.key"), "o_orderstatus": F.lit("O"), "o_totalprice": F.col("src.price")})
    return tables.read("orders")


@query("change_by_file", f"""
    SELECT c_custkey, CASE WHEN balance < 1000 THEN 'LOW' ELSE c_mktsegment END AS c_mktsegment, balance FROM ({ACCOUNTS})
    WHERE NOT COALESCE(CASE WHEN balance < 1000 THEN 'LOW' ELSE c_mktsegment END = 'BUILDING' AND balance > 9000.0, false)""")
def _(t: Tables):
    """An update and a delete, each writing again only the files with rows they change."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    tables.replace({"accounts": _accounts(t).repartitionByRange(16, "balance")})
    tables.update("accounts", F.col("balance") < 1000, {"c_mktsegment": F.lit("LOW")})
    tables.delete("accounts", "c_mktsegment = 'BUILDING' AND balance > 9000.0")
    return tables.read("accounts")


@query("appended_rows", """
    SELECT p_partkey, p_name, p_brand, p_size FROM part
    UNION ALL SELECT s_suppkey + (SELECT max(p_partkey) FROM part) + 1, s_name, 'Brand#0', 1 FROM supplier""")
def _(t: Tables):
    """Rows that lack two columns are appended to a stored table, which gives them its defaults."""
    folder = new_path(t.spark, "stored")
    append_rows(t.part, PART, folder)
    top = t.part.agg(F.max("p_partkey") + 1).scalar()
    append_rows(t.supplier.select((F.col("s_suppkey") + top).alias("p_partkey"), F.col("s_name").alias("p_name")), PART, folder)
    return read_table(t.spark, folder, "part")


@query("events_until_now", """
    SELECT user_id, count(*) AS n, max(ts)::DATE <= current_date AS past FROM events WHERE ts <= now()::TIMESTAMP GROUP BY user_id""")
def _(t: Tables):
    now = F.current_timestamp().cast("timestamp_ntz")
    return (t.events.where(F.col("ts") <= now).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"), (F.max("ts").cast("date") <= F.current_date()).alias("past")))
