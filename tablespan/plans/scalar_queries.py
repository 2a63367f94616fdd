"""Row-wise functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.functions import text
from tablespan.operators import pseudo
from tablespan.operators.ordinals import running_total
from tablespan.operators.relational import search_titles
from tablespan.plans.registry import Tables, query
from tablespan.scratch import new_path
from tablespan.sources.tables import write_report

SALT = "s0l"


@query("label_flags", """
    SELECT c_custkey, CASE WHEN flag = 1 THEN 'Administrator' ELSE 'Zwykly uzytkownik' END AS role,
      CASE WHEN sex = 'm' THEN 'Mezczyzna' ELSE 'Kobieta' END AS sex_label
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 2 END AS flag,
            CASE WHEN c_custkey % 3 = 0 THEN 'm' ELSE 'k' END AS sex FROM customer)""")
def _(t: Tables):
    key = F.col("c_custkey")
    flag = F.when(key % 7 == 0, F.lit(None)).otherwise(key % 2)
    sex = F.when(key % 3 == 0, F.lit("m")).otherwise(F.lit("k"))
    return t.customer.select(
        "c_custkey", F.when(flag == 1, "Administrator").otherwise("Zwykly uzytkownik").alias("role"),
        F.when(sex == "m", "Mezczyzna").otherwise("Kobieta").alias("sex_label"))


@query("decode_null", """
    SELECT c_custkey, CASE WHEN parent IS NULL THEN 'root' WHEN parent = 3 THEN 'third' ELSE 'child' END AS kind
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS parent FROM customer)""")
def _(t: Tables):
    return t.customer.selectExpr(
        "c_custkey",
        "decode(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END, NULL, 'root', 3, 'third', 'child') AS kind")


@query("report_lines", """
    SELECT 'Login: ' || c_name || ', Miasto: ' || COALESCE(n_name, '') || ' (' || CAST(c_custkey AS VARCHAR) || ')'
      AS line
    FROM customer LEFT JOIN nation ON c_custkey % 30 = n_nationkey""")
def _(t: Tables):
    n = t.nation
    joined = t.customer.join(n, F.col("c_custkey") % 30 == n.n_nationkey, "left")
    line = text.joined("Login: ", F.col("c_name"), ", Miasto: ", F.col("n_name"), " (", F.col("c_custkey"), ")")
    return write_report(joined, line, new_path(t.spark, "report"))


@query("search_report", """
    SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS VARCHAR) || '. Znaleziono: ' || p_name || ' z kategorii: '
      || COALESCE(n_name, 'Brak') AS line
    FROM part LEFT JOIN nation ON p_partkey % 30 = n_nationkey WHERE lower(p_name) LIKE '%ring%'""")
def _(t: Tables):
    n = t.nation
    found = search_titles(t.part.select("p_partkey", "p_name"), "p_name", "RING")
    numbered = running_total(found, [], ["p_partkey"], "number")
    return (numbered.join(n, F.col("p_partkey") % 30 == n.n_nationkey, "left")
            .select(text.joined(F.col("number"), ". Znaleziono: ", F.col("p_name"), " z kategorii: ",
                                F.coalesce("n_name", F.lit("Brak"))).alias("line")))


@query("age_years", "SELECT o_orderkey, 2026 - CAST(year(o_orderdate) AS BIGINT) AS age FROM orders")
def _(t: Tables):
    today = F.lit("2026-01-01").cast("date")
    return t.orders.select("o_orderkey", (F.year(today) - F.year("o_orderdate")).cast("long").alias("age"))


@query("nth_token", """
    SELECT doc_id, string_split(text, ' ')[-1] AS last_word,
      CASE WHEN len(string_split(text, ' ')) > 3
           THEN length(array_to_string(string_split(text, ' ')[1:3], ' ')) + 1 ELSE 0 END AS third_space,
      length(trim(text)) AS trimmed_length
    FROM documents""")
def _(t: Tables):
    c = F.col("text")
    return t.documents.select(
        "doc_id", text.last_token(c).alias("last_word"),
        text.nth_position(c, " ", 3).cast("long").alias("third_space"),
        F.length(F.trim(c)).cast("long").alias("trimmed_length"))


@query("proper_case", """
    SELECT p_partkey, upper(substr(a, 1, 1)) || substr(a, 2) || mark || upper(substr(b, 1, 1)) || substr(b, 2) AS name
    FROM (SELECT p_partkey, lower(split_part(p_name, ' ', 1)) AS a, lower(split_part(p_name, ' ', 2)) AS b,
            CASE WHEN p_partkey % 2 = 1 THEN '-' ELSE ' ' END AS mark FROM part)""")
def _(t: Tables):
    raw = F.when(F.col("p_partkey") % 2 == 1, F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))).otherwise(
        F.upper("p_name"))
    return t.part.select("p_partkey", text.proper_case(raw).alias("name"))


@query("hash_columns", f"""
    SELECT c_custkey, upper(md5(c_name)) AS md5_name, upper(md5(c_name || '{SALT}')) AS md5_salted,
      upper(sha1(c_name)) AS sha1_name, upper(sha1(c_name || '{SALT}')) AS sha1_salted
    FROM customer""")
def _(t: Tables):
    c = F.col("c_name")
    return t.customer.select(
        "c_custkey", pseudo.md5_upper(c).alias("md5_name"), pseudo.md5_upper(c, SALT).alias("md5_salted"),
        pseudo.sha1_upper(c).alias("sha1_name"), pseudo.sha1_upper(c, SALT).alias("sha1_salted"))
