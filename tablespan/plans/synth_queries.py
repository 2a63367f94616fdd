"""Synthetic rows sized by the given tables; the SQL makes the same rows from the same draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablespan.functions import checks
from tablespan.functions.draws import draw_sql
from tablespan.operators import changes, profile, synth
from tablespan.plans.registry import Tables, query

SEED = 7


def _people(t: Tables):
    """One person per order; as many offices as suppliers."""
    offices = t.supplier.agg(F.count("*")).scalar()
    rows = t.orders.select(F.col("o_orderkey").alias("row_no")).withColumn("_offices", offices)
    return synth.persons_for(rows, "row_no", F.col("_offices"), SEED)


def _from_pool(row: str, salt: str, pool: list[str]) -> str:
    names = ", ".join(f"'{x}'" for x in pool)
    return f"([{names}])[{draw_sql(row, salt, SEED, 0, len(pool))} + 1]"


def _flat(row: str, salt: str) -> str:
    return f"{draw_sql(row, salt + ' house', SEED, 1, 100)} || '/' || {draw_sql(row, salt + ' flat', SEED, 1, 100)}"


_WEIGHTED = " + ".join(f"{w} * (prefix // {10 ** (7 - i)} % 10)" for i, w in enumerate(checks.NIP_WEIGHTS[:8]))
_LAST = checks.NIP_WEIGHTS[8]
PERSONS = f"""
    (WITH a AS (SELECT o_orderkey AS r, (o_orderkey % {synth.NIP_PREFIXES} * {synth.NIP_STEP} + {synth.NIP_SHIFT})
          % {synth.NIP_PREFIXES} AS prefix, o_orderkey // {synth.NIP_PREFIXES} * 2 AS ninth FROM orders),
    b AS (SELECT r, prefix, {_WEIGHTED} AS s, ninth + CASE WHEN ({_WEIGHTED} + {_LAST} * ninth) % 11 = 10 THEN 1 ELSE 0 END AS ninth FROM a),
    c AS (SELECT *, CASE WHEN {draw_sql("r", "sex", SEED, 0, 2)} = 0 THEN 'm' ELSE 'k' END AS sex FROM b)
    SELECT r + 1 AS OSOK_1_ID,
      CASE WHEN sex = 'm' THEN {_from_pool("r", "male", synth.MALE_NAMES)} ELSE {_from_pool("r", "female", synth.FEMALE_NAMES)} END AS OSO_IMIE,
      {_from_pool("r", "surname", synth.SURNAMES)} AS OSO_NAZWISKO, sex AS OSO_PLEC,
      (DATE '{synth.FIRST_DAY}' + {draw_sql("r", "birth", SEED, 0, synth.DAYS)}::INTEGER)::DATE AS OSO_DATA_URODZENIA,
      NULL::VARCHAR AS OSO_PESEL,
      CASE WHEN r < {synth.NIP_CAPACITY} THEN lpad(prefix::VARCHAR, 8, '0') || ninth || ((s + {_LAST} * ninth) % 11) END AS OSO_NIP,
      {_from_pool("r", "street", synth.STREETS)} AS OSO_ULICA, {_flat("r", "person")} AS OSO_NR_LOKALU,
      {draw_sql("r", "office", SEED, 0, "(SELECT count(*) FROM supplier)")} + 1 AS ADR_ID
    FROM c)"""


@query("synth_offices", f"""
    SELECT r + 1 AS ADRK_1_ID, {_from_pool("r", "city", synth.CITIES)} AS ADR_MIASTO,
      lpad(code::VARCHAR, 5, '0')[1:2] || '-' || lpad(code::VARCHAR, 5, '0')[3:5] AS ADR_KOD_POCZTOWY,
      {_from_pool("r", "street", synth.STREETS)} AS ADR_ULICA, {_flat("r", "office")} AS ADR_NR_LOKALU
    FROM (SELECT r, (r * {synth.POSTCODE_STEP} + {synth.POSTCODE_SHIFT}) % {synth.POSTCODES} AS code
          FROM (SELECT row_number() OVER () - 1 AS r FROM supplier))""")
def _(t: Tables):
    # one office per supplier
    return synth.offices(t.spark, t.supplier.count(), SEED)


@query("synth_persons", f"SELECT * FROM {PERSONS}")
def _(t: Tables):
    return _people(t)


@query("synth_persons_audit", """
    SELECT count(*) AS persons, count(*) AS distinct_ids, count(*) AS distinct_nips, 0 AS bad_nips, 0 AS bad_offices,
      0 AS bad_names, 0 AS bad_dates FROM orders""")
def _(t: Tables):
    people = _people(t)
    offices = t.supplier.agg(F.count("*")).scalar()
    man = F.col("OSO_PLEC") == "m"
    wrong_name = (man & ~F.col("OSO_IMIE").isin(synth.MALE_NAMES)) | (~man & ~F.col("OSO_IMIE").isin(synth.FEMALE_NAMES))
    day = F.col("OSO_DATA_URODZENIA")
    # one row per number first, so that the distinct count is a plain count
    per_nip = people.withColumn("_offices", offices).groupBy("OSO_NIP").agg(
        F.count("*").alias("n"), F.count_distinct("OSOK_1_ID").alias("ids"),
        F.count_if(~checks.nip_ok(F.col("OSO_NIP"))).alias("bad_nips"),
        F.count_if(~F.col("ADR_ID").between(1, F.col("_offices"))).alias("bad_offices"),
        F.count_if(wrong_name).alias("bad_names"),
        F.count_if((day < "1900-01-01") | (day > "1994-12-31")).alias("bad_dates"))
    return per_nip.agg(
        F.sum("n").alias("persons"), F.sum("ids").alias("distinct_ids"), F.count("*").alias("distinct_nips"),
        *[F.sum(c).cast("int").alias(c) for c in ("bad_nips", "bad_offices", "bad_names", "bad_dates")])


@query("reassign_some", f"""
    WITH p AS (SELECT *, OSOK_1_ID AS r, count(*) OVER () AS total FROM {PERSONS}),
    m AS (SELECT * FROM p WHERE {draw_sql("r", "chosen", SEED, 0, "total")} < 1000)
    SELECT OSOK_1_ID, {_from_pool("r", "office", ["1", "2", "3"])}::BIGINT AS ADR_ID,
      CASE WHEN {draw_sql("r", "renamed", SEED, 0, 100)} = 0 AND OSO_PLEC = 'm' THEN 'Marek' ELSE OSO_IMIE END AS OSO_IMIE,
      ADR_ID AS old_office, OSO_IMIE AS old_name
    FROM m WHERE {_from_pool("r", "office", ["1", "2", "3"])}::BIGINT <> ADR_ID
      OR ({draw_sql("r", "renamed", SEED, 0, 100)} = 0 AND OSO_PLEC = 'm' AND OSO_IMIE <> 'Marek')""")
def _(t: Tables):
    before = _people(t)
    after = changes.reassign_some(before, "OSOK_1_ID", "ADR_ID", "OSO_IMIE", "OSO_PLEC", expected=1000,
                                  offices=[1, 2, 3], rename_to="Marek", seed=SEED)
    old = before.select("OSOK_1_ID", F.col("ADR_ID").alias("old_office"), F.col("OSO_IMIE").alias("old_name"))
    changed = (F.col("ADR_ID") != F.col("old_office")) | (F.col("OSO_IMIE") != F.col("old_name"))
    return after.join(old, "OSOK_1_ID").where(changed).select("OSOK_1_ID", "ADR_ID", "OSO_IMIE", "old_office", "old_name")


_SAMPLED = f"""FROM lineitem WHERE {draw_sql("l_orderkey || ',' || l_linenumber", "sample", SEED, 0, 1_000_000)} < 100000"""


@query("sampled_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS sample_size, round(count(*) / 0.1)::BIGINT AS num_rows_estimate,
      round((count(*) - count({c})) / 0.1)::BIGINT AS num_nulls_estimate, count(DISTINCT {c}) AS num_distinct_at_least
    {_SAMPLED}""" for c in ("l_partkey", "l_returnflag")))
def _(t: Tables):
    return profile.sampled_profile(t.lineitem, ["l_partkey", "l_returnflag"], 0.1, SEED, ["l_orderkey", "l_linenumber"])


_ESTIMATED = ("l_partkey", "l_orderkey", "l_extendedprice", "l_suppkey", "l_shipdate")


@query("estimated_distinct", f"""
    WITH RECURSIVE counts AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n {_SAMPLED} AND {c} IS NOT NULL GROUP BY {c}" for c in _ESTIMATED)}),
    facts AS (
      SELECT column_name, count(*) AS d, count(*) FILTER (n = 1) AS f1, count(*) FILTER (n = 2) AS f2,
        sum(n) FILTER (n <= 4)::DOUBLE AS n, count(*) FILTER (n > 4) AS frequent,
        greatest(2 * count(*) FILTER (n = 2) / (0.1::DOUBLE * nullif(count(*) FILTER (n = 1), 0)), 1e-9::DOUBLE) AS slope
      FROM counts GROUP BY column_name),
    halved AS (
      SELECT column_name, 0 AS i, -14::DOUBLE AS low, 14::DOUBLE AS high, CASE WHEN f1 > 0 THEN ln(f1 / n) / slope END AS target FROM facts
      UNION ALL
      SELECT column_name, i + 1, CASE WHEN above THEN low ELSE t END, CASE WHEN above THEN t ELSE high END, target FROM (
        SELECT *, COALESCE(CASE WHEN abs(1 - exp(t)) < 1e-9 THEN -0.1 ELSE (1 - (1 - exp(t)) * 0.9::DOUBLE) / (1 - exp(t)) * (t - ln(1 - (1 - exp(t)) * 0.9::DOUBLE)) END > target, false) AS above
        FROM (SELECT *, (low + high) / 2 AS t FROM halved WHERE i < 50))),
    fitted AS (SELECT f.*, low AS t, 1 - exp(low) AS p, slope * (1 - (1 - exp(low)) * 0.9::DOUBLE) / (1 - exp(low)) AS r FROM facts f JOIN halved h USING (column_name) WHERE i = 50),
    bounded AS (SELECT *, round(d - f1 + f1 / 0.1::DOUBLE)::BIGINT AS most FROM fitted)
    SELECT column_name, d AS sample_distinct, f1 AS singletons, f2 AS doubletons, d AS at_least, most AS at_most,
      greatest(d, least(most, CASE WHEN f1 = 0 THEN d WHEN f1 >= n THEN most ELSE round(n / 0.1::DOUBLE * (exp(r * t) - exp(t)) / (p * (1 - r)) + frequent) END))::BIGINT AS num_distinct_estimate
    FROM bounded""")
def _(t: Tables):
    return profile.estimated_distinct(t.lineitem, list(_ESTIMATED), 0.1, SEED, ["l_orderkey", "l_linenumber"])
