"""Audits over customers, parts, orders and lines. The tables are clean, so the audited columns are
made dirty by formulas of the key that both engines compute alike (`PEOPLE`)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.functions import checks
from tablespan.operators import quality
from tablespan.operators.relational import resolved_by_code
from tablespan.plans.registry import Tables, query
from tablespan.sources.contracts import Contract, column, refers

_BODY = "lpad(CAST((c_custkey * 7919 + 123456789) % 1000000000 AS STRING), 9, '0')"
_SUM = " + ".join(f"{w} * CAST(substr({_BODY}, {i}, 1) AS INT)" for i, w in enumerate(checks.NIP_WEIGHTS, 1))

PEOPLE_COLUMNS = [
    "c_custkey",
    "CASE WHEN c_custkey % 31 = 0 THEN 'Al' WHEN c_custkey % 37 = 0 THEN NULL ELSE 'Jan' END AS first_name",
    "CASE WHEN c_custkey % 17 = 1 THEN 'user' || CAST(c_custkey - 1 AS STRING)"
    " ELSE 'user' || CAST(c_custkey AS STRING) END AS login",
    "CASE WHEN c_custkey % 13 = 0 THEN 'x' WHEN c_custkey % 7 = 0 THEN NULL"
    " WHEN c_custkey % 2 = 0 THEN 'k' ELSE 'm' END AS sex",
    "lower(replace(c_name, '#', '')) || CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '@' END || 'mail.pl' AS email",
    "lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || CASE WHEN c_custkey % 8 = 0 THEN '' ELSE '-' END"
    " || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') AS postcode",
    "CASE WHEN c_custkey % 10 = 3 THEN 'a' || lpad(CAST(c_custkey AS STRING), 10, '0')"
    " WHEN c_custkey % 10 = 4 THEN NULL ELSE lpad(CAST(c_custkey AS STRING), 11, '0') END AS pesel",
    f"{_BODY} || CAST((({_SUM}) % 11 + c_custkey % 2) % 10 AS STRING) AS nip",
    "CASE WHEN c_custkey % 17 = 0 THEN '1980/13/05' WHEN c_custkey % 19 = 0 THEN '2090/01/01'"
    " WHEN c_custkey % 23 = 0 THEN '1980-01-05' WHEN c_custkey % 29 = 0 THEN '1981/02/30'"
    " ELSE CAST(1950 + c_custkey % 50 AS STRING) || '/' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0')"
    " || '/' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0') END AS born",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN c_nationkey + 10"
    " ELSE c_nationkey END AS office",
]
PEOPLE = f"(SELECT {', '.join(PEOPLE_COLUMNS)} FROM customer)"
TODAY = "2020-01-01"

# rules in SQL of the checking engine
NIP_SUM = " + ".join(f"{w} * CAST(substr(nip, {i}, 1) AS INT)" for i, w in enumerate(checks.NIP_WEIGHTS, 1))
NIP_OK = f"(({NIP_SUM}) % 11 = CAST(substr(nip, 10, 1) AS INT))"
BORN_OK = (f"COALESCE(regexp_matches(born, '{checks.DATE_FORMAT}') AND try_strptime(born, '%Y/%m/%d') IS NOT NULL"
           f" AND try_strptime(born, '%Y/%m/%d') < DATE '{TODAY}', false)")


def people(t: Tables):
    return t.customer.selectExpr(*PEOPLE_COLUMNS)


@query("dup_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def _(t: Tables):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dup_unique", f"""
    SELECT sex, office, count(*) AS n FROM {PEOPLE} WHERE sex IS NOT NULL AND office IS NOT NULL
    GROUP BY sex, office HAVING count(*) > 1""")
def _(t: Tables):
    return quality.duplicate_keys(people(t), ["sex", "office"], skip_nulls=True)


LINES = Contract("lines", [
    column("l_orderkey", "long"), column("l_linenumber", "int"), column("part", "long"),
    column("l_returnflag", "text", 1), column("l_linestatus", "text", 1, nullable=True),
], key=("l_orderkey", "l_linenumber"), references=(refers("part", "part", "p_partkey"),),
    domains={"l_returnflag": ["A", "N"]})

DIRTY_LINES = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey + 5 END AS part,
      l_returnflag, l_linestatus || CASE WHEN l_suppkey % 5 = 0 THEN '?' ELSE '' END AS l_linestatus FROM lineitem)"""


@query("contract_audit", " UNION ALL ".join(
    f"SELECT 'lines' AS table_name, '{rule}' AS rule, ({count}) AS violations" for rule, count in {
        "key l_orderkey,l_linenumber": "SELECT count(*) FROM (SELECT 1 FROM lineitem"
                                       " GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
        "reference part": f"SELECT count(*) FROM {DIRTY_LINES} WHERE part IS NOT NULL"
                          " AND part NOT IN (SELECT p_partkey FROM part)",
        "required l_orderkey": f"SELECT count(*) FROM {DIRTY_LINES} WHERE l_orderkey IS NULL",
        "required l_linenumber": f"SELECT count(*) FROM {DIRTY_LINES} WHERE l_linenumber IS NULL",
        "required part": f"SELECT count(*) FROM {DIRTY_LINES} WHERE part IS NULL",
        "required l_returnflag": f"SELECT count(*) FROM {DIRTY_LINES} WHERE l_returnflag IS NULL",
        "domain l_returnflag": f"SELECT count(*) FROM {DIRTY_LINES} WHERE l_returnflag NOT IN ('A', 'N')",
        "length l_returnflag": f"SELECT count(*) FROM {DIRTY_LINES} WHERE length(l_returnflag) > 1",
        "length l_linestatus": f"SELECT count(*) FROM {DIRTY_LINES} WHERE length(l_linestatus) > 1",
    }.items()))
def _(t: Tables):
    lines = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey + 5 END AS part",
        "l_returnflag", "l_linestatus || CASE WHEN l_suppkey % 5 = 0 THEN '?' ELSE '' END AS l_linestatus")
    return quality.audit_contract({"lines": lines, "part": t.part}, LINES)


@query("fk_orphans", f"""
    SELECT c_custkey, office FROM {PEOPLE} WHERE office IS NOT NULL AND office NOT IN (SELECT n_nationkey FROM nation)""")
def _(t: Tables):
    return quality.unresolved(people(t), "office", t.nation, "n_nationkey").select("c_custkey", "office")


@query("fk_reject", """
    SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN -20009 END AS code
    FROM orders LEFT JOIN customer ON o_custkey + 100 = c_custkey""")
def _(t: Tables):
    incoming = t.orders.select("o_orderkey", (F.col("o_custkey") + 100).alias("ref"))
    flagged = quality.flag_resolved(incoming, "ref", t.customer, "c_custkey", "found")
    return quality.validated(flagged, [(-20009, F.col("found"))]).select("o_orderkey", "code")


@query("resolve_by_code", """
    SELECT o_orderkey, c_custkey AS customer_id, CASE WHEN c_custkey IS NULL THEN -20001 END AS code
    FROM orders LEFT JOIN customer ON 'Customer#' || lpad(CAST(o_custkey + 50 AS VARCHAR), 9, '0') = c_name""")
def _(t: Tables):
    # the other form of an insert: the parent is given by its unique code instead of its id
    name = F.concat(F.lit("Customer#"), F.lpad((F.col("o_custkey") + 50).cast("string"), 9, "0"))
    incoming = t.orders.select("o_orderkey", name.alias("ref"))
    found = resolved_by_code(incoming, "ref", t.customer, "c_name", "c_custkey", "customer_id")
    return (quality.validated(found, [(-20001, F.col("customer_id").isNotNull())])
            .select("o_orderkey", "customer_id", "code"))


@query("length_audit", """
    SELECT doc_id, 'text' AS column_name, length(text) AS length FROM documents WHERE length(text) < 40 OR length(text) > 4000
    UNION ALL
    SELECT doc_id, 'source', length(source) FROM documents WHERE length(source) < 4 OR length(source) > 6
    UNION ALL
    SELECT doc_id, 'lang', length(lang) FROM documents WHERE length(lang) > 2""")
def _(t: Tables):
    return quality.length_violations(t.documents, "doc_id", {"text": (40, 4000), "source": (4, 6), "lang": (0, 2)})


@query("domain_audit", f"SELECT c_custkey, sex FROM {PEOPLE} WHERE NOT (sex = 'k' OR sex = 'm')")
def _(t: Tables):
    return quality.outside_domain(people(t), "sex", ["k", "m"]).select("c_custkey", "sex")


@query("email_audit", f"""
    SELECT c_custkey, email FROM {PEOPLE} WHERE NOT regexp_matches(email, '{checks.EMAIL_FORMAT}')""")
def _(t: Tables):
    return quality.failing(people(t), checks.email_ok(F.col("email"))).select("c_custkey", "email")


@query("format_audit", f"""
    SELECT c_custkey, CAST(NOT regexp_matches(postcode, '{checks.POSTCODE_FORMAT}') AS INTEGER) AS bad_postcode,
      CAST(NOT regexp_matches(pesel, '{checks.PESEL_FORMAT}') AS INTEGER) AS bad_pesel,
      CAST(NOT regexp_matches(nip, '{checks.NIP_FORMAT}') AS INTEGER) AS bad_nip FROM {PEOPLE}""")
def _(t: Tables):
    def bad(c, pattern):
        return (~checks.format_ok(F.col(c), pattern)).cast("int").alias(f"bad_{c}")

    return people(t).select("c_custkey", bad("postcode", checks.POSTCODE_FORMAT),
                            bad("pesel", checks.PESEL_FORMAT), bad("nip", checks.NIP_FORMAT))


@query("date_audit", f"SELECT c_custkey, born FROM {PEOPLE} WHERE NOT {BORN_OK}")
def _(t: Tables):
    today = F.lit(TODAY).cast("date")
    return quality.failing(people(t), checks.birth_date_ok(F.col("born"), today)).select("c_custkey", "born")


@query("nip_valid", f"SELECT c_custkey, nip, CAST({NIP_OK} AS INTEGER) AS ok FROM {PEOPLE}")
def _(t: Tables):
    return people(t).select("c_custkey", "nip", checks.nip_ok(F.col("nip")).cast("int").alias("ok"))


@query("reject_existing", f"""
    SELECT c_custkey, login, CASE WHEN stored THEN 'existing' ELSE 'repeated' END AS reason
    FROM (SELECT c_custkey, login, login IN (SELECT 'user' || CAST(s_suppkey * 3 AS VARCHAR) FROM supplier) AS stored,
            row_number() OVER (PARTITION BY login ORDER BY c_custkey) AS rn FROM {PEOPLE})
    WHERE stored OR rn > 1""")
def _(t: Tables):
    stored = t.supplier.select(F.concat(F.lit("user"), (F.col("s_suppkey") * 3).cast("string")).alias("taken"))
    return quality.existing_or_repeated(people(t).select("c_custkey", "login"), "login", "c_custkey", stored, "taken")


# fixed values: error codes and their order
RULE_TEXTS = {
    -20001: "first name length", -20002: "login length", -20003: "sex", -20004: "birth date",
    -20005: "PESEL format", -20006: "NIP format", -20007: "postcode format", -20008: "e-mail format",
    -20009: "office does not exist",
}


def people_rules():
    c = F.col
    return [
        (-20001, checks.length_ok(c("first_name"), 50, 3)),
        (-20002, checks.length_ok(c("login"), 20, 6)),
        (-20003, checks.in_domain(c("sex"), ["k", "m"])),
        (-20004, checks.birth_date_ok(c("born"), F.lit(TODAY).cast("date"))),
        (-20005, checks.format_ok(c("pesel"), checks.PESEL_FORMAT)),
        (-20006, checks.nip_ok(c("nip"))),
        (-20007, checks.format_ok(c("postcode"), checks.POSTCODE_FORMAT)),
        (-20008, checks.email_ok(c("email"))),
        (-20009, c("office_found")),
    ]


def marked_people(t: Tables):
    flagged = quality.flag_resolved(people(t), "office", t.nation, "n_nationkey", "office_found")
    return quality.validated(flagged, people_rules())


MARKED = f"""(SELECT c_custkey, CASE
      WHEN length(first_name) < 3 OR length(first_name) > 50 THEN -20001
      WHEN length(login) < 6 OR length(login) > 20 THEN -20002
      WHEN sex <> 'k' AND sex <> 'm' THEN -20003
      WHEN NOT {BORN_OK} THEN -20004
      WHEN NOT regexp_matches(pesel, '{checks.PESEL_FORMAT}') THEN -20005
      WHEN NOT (regexp_matches(nip, '{checks.NIP_FORMAT}') AND {NIP_OK}) THEN -20006
      WHEN NOT regexp_matches(postcode, '{checks.POSTCODE_FORMAT}') THEN -20007
      WHEN NOT regexp_matches(email, '{checks.EMAIL_FORMAT}') THEN -20008
      WHEN n_nationkey IS NULL THEN -20009 END AS code
    FROM {PEOPLE} LEFT JOIN nation ON office = n_nationkey)"""


@query("validate_first_error", f"SELECT c_custkey, code FROM {MARKED}")
def _(t: Tables):
    return marked_people(t).select("c_custkey", "code")


@query("validate_report", "SELECT code, CASE code " + " ".join(
    f"WHEN {code} THEN '{text}'" for code, text in RULE_TEXTS.items())
    + f" END AS message, count(*) AS n FROM {MARKED} WHERE code IS NOT NULL GROUP BY code")
def _(t: Tables):
    return quality.reject_report(marked_people(t), RULE_TEXTS).select("code", "message", "n")


@query("null_audit", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM {PEOPLE}"
    for c in ("first_name", "sex", "pesel", "office", "nip")))
def _(t: Tables):
    return quality.missing_values(people(t), ["first_name", "sex", "pesel", "office", "nip"])
