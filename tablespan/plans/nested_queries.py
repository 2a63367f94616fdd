"""Collections: children as arrays or maps, element access and collection updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.functions import arrays
from tablespan.operators import nested
from tablespan.plans.registry import Tables, query


def _texts(items: str, *fields: str):
    """The records of an array as one text."""
    return F.array_join(F.transform(
        items, lambda r: F.concat_ws(":", *[F.coalesce(r[f].cast("string"), F.lit("")) for f in fields])), ",")


@query("authors_nested", """
    SELECT l_orderkey, (pos - 1) // 50 AS chunk_no, count(*) AS n,
      string_agg(CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR), ',' ORDER BY pos) AS records
    FROM (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem)
    GROUP BY ALL""")
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (nested.nest(lines, ["l_orderkey"], ["l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
            .select("l_orderkey", "chunk_no", F.size("items").cast("long").alias("n"),
                    _texts("items", "l_partkey", "l_suppkey").alias("records")))


@query("titles_per_author", """
    SELECT c_custkey, (pos - 1) // 50 AS chunk_no, count(o_orderkey) AS n,
      COALESCE(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY pos), '') AS orders
    FROM (SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS pos
          FROM customer LEFT JOIN orders ON c_custkey * 2 = o_custkey)
    GROUP BY ALL""")
def _(t: Tables):
    # doubled keys: about half of the customers find no order and get one empty array
    customers = t.customer.select("c_custkey", (F.col("c_custkey") * 2).alias("_twice"))
    return (nested.nest_under(customers, "_twice", t.orders.select("o_custkey", "o_orderkey"), "o_custkey",
                              ["o_orderkey"], ["o_orderkey"])
            .select("c_custkey", "chunk_no", F.size("items").cast("long").alias("n"),
                    _texts("items", "o_orderkey").alias("orders")))


@query("count_map", """
    SELECT user_id, (pos - 1) // 50 AS chunk_no,
      string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts
    FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (
            PARTITION BY user_id ORDER BY event_type) AS pos FROM events GROUP BY user_id, event_type)
    GROUP BY ALL""")
def _(t: Tables):
    maps = nested.count_map(t.events.select("user_id", "event_type"), ["user_id"], "event_type")
    entries = F.transform(nested.sorted_entries(F.col("counts")),
                          lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return maps.select("user_id", "chunk_no", F.array_join(entries, ",").alias("counts"))


def _words():
    return F.split("p_name", " ")


@query("explode_elements", """
    SELECT p_partkey, unnest(range(1, len(words) + 1)) AS position, unnest(words) AS element
    FROM (SELECT p_partkey, list_append(string_split(p_name, ' '), p_type) AS words FROM part)""")
def _(t: Tables):
    return nested.elements(t.part, ["p_partkey"], F.array_append(_words(), F.col("p_type")))


@query("array_member", """
    SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 = 0 THEN false ELSE list_contains(string_split(p_name, ' '), 'ring') END
      AS INTEGER) AS has_ring FROM part""")
def _(t: Tables):
    # every fourth collection is emptied, every eighth is missing
    stored = (F.when(F.col("p_partkey") % 8 == 0, F.lit(None))
              .when(F.col("p_partkey") % 4 == 0, F.array().cast("array<string>")).otherwise(_words()))
    return t.part.select("p_partkey", arrays.has_element(stored, "ring").cast("int").alias("has_ring"))


A = "CASE WHEN p_partkey % 3 = 0 THEN array(w1, w2, w1) ELSE array(w1, w2) END"
B = "CASE WHEN p_partkey % 5 = 0 THEN array(w2, w1, w1) ELSE array(w2, w1) END"
PAIR = "SELECT p_partkey, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part"
PAIR_LISTS = f"""(SELECT p_partkey, w1, w2,
      CASE WHEN p_partkey % 3 = 0 THEN [w1, w2, w1] ELSE [w1, w2] END AS a,
      CASE WHEN p_partkey % 5 = 0 THEN [w2, w1, w1] ELSE [w2, w1] END AS b FROM ({PAIR}))"""


def _pairs(t: Tables):
    return t.part.select("p_partkey", F.get(_words(), 0).alias("w1"), F.get(_words(), 1).alias("w2")).selectExpr(
        "*", f"{A} AS a", f"{B} AS b")


@query("multiset_equal", f"""
    SELECT p_partkey, CAST(list_sort(a) = list_sort(b) AS INTEGER) AS same FROM {PAIR_LISTS}""")
def _(t: Tables):
    return _pairs(t).select("p_partkey", arrays.same_elements(F.col("a"), F.col("b")).cast("int").alias("same"))


@query("append_missing", f"""
    SELECT p_partkey, array_to_string(list_concat([w1], list_filter(b, lambda x: x <> w1)), ',') AS words
    FROM {PAIR_LISTS}""")
def _(t: Tables):
    return _pairs(t).select("p_partkey", F.array_join(
        arrays.append_missing(F.array("w1"), F.col("b")), ",").alias("words"))


@query("collection_update", f"""
    WITH pairs AS (SELECT * FROM {PAIR_LISTS})
    SELECT p.p_partkey, array_to_string(CASE
      WHEN c.p_partkey % 3 = 0 THEN list_concat(p.a, list_filter([c.w2, 'nowy', 'nowy'], lambda x: NOT list_contains(p.a, x)))
      WHEN c.p_partkey % 3 = 1 THEN [c.w2, 'nowy', 'nowy'] ELSE p.a END, ',') AS words
    FROM pairs p LEFT JOIN pairs c ON p.p_partkey = c.p_partkey * 2""")
def _(t: Tables):
    # a change table of doubled keys, so about half of the parts have a change: append, overwrite,
    # or an unknown mode
    pairs = _pairs(t)
    key = F.col("p_partkey")
    mode = (F.when(key % 3 == 0, arrays.APPEND_MODE).when(key % 3 == 1, arrays.OVERWRITE_MODE).otherwise("?"))
    changes = pairs.select((key * 2).alias("_key"), F.array("w2", F.lit("nowy"), F.lit("nowy")).alias("extra"),
                           mode.alias("mode"))
    return (pairs.join(changes, key == F.col("_key"), "left")
            .select("p_partkey", F.array_join(
                arrays.updated(F.col("a"), F.col("extra"), F.col("mode")), ",").alias("words")))
