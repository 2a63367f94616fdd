"""Streams over the tables, run to the end of what has arrived; the SQL is the batch equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablespan.operators import changes
from tablespan.plans import quality_queries as q
from tablespan.plans.registry import Tables, query
from tablespan.scratch import new_path
from tablespan.sources.tableset import TableSet
from tablespan.streaming import jobs

DAY = "%Y-%m-%d %H:%M:%S.%f"
TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _stream(t: Tables, name: str) -> DataFrame:
    schema = getattr(t, name).schema
    return jobs.arriving(t.spark, t.folder, f"{name}.parquet", schema)


def _events(t: Tables) -> DataFrame:
    # a watermark needs a timestamp with time zone: the same reading of the clock in UTC, whatever the session's zone
    ts = F.col("ts")
    seconds = F.second(ts) + F.date_format(ts, "SSSSSS").cast("decimal(6,0)") / 1000000
    moment = F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), seconds, F.lit("UTC"))
    return _stream(t, "events").withColumn("ts", moment)


def _clock(moment: str):
    """A timestamp as text, in UTC."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), TEXT).alias(moment)


@query("stream_sessions", f"""
    WITH marked AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
    SELECT user_id, count(*) AS touches, strftime(min(ts), '{DAY}') AS started,
      strftime(max(ts) + INTERVAL 12 HOUR, '{DAY}') AS valid_until
    FROM numbered GROUP BY user_id, s HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def _(t: Tables):
    closed = jobs.run_to_table(jobs.sessions(_events(t), "user_id", "ts", "12 hours", "1 day"), "sessions")
    return closed.select("user_id", "touches", _clock("started"), _clock("valid_until"))


@query("stream_counter", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def _(t: Tables):
    return jobs.running_counts(_stream(t, "orders").select("o_custkey"), "o_custkey", "counter")


@query("stream_dedup", """
    SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def _(t: Tables):
    # a key holds one day, so its repeats all arrive within the time it is remembered
    rows = _events(t).withColumn("day", F.date_format(F.to_utc_timestamp("ts", F.current_timezone()), "yyyy-MM-dd"))
    first = jobs.first_arrivals(rows, ["user_id", "event_type", "day"], "ts", "2 days")
    return jobs.run_to_table(first.select("user_id", "event_type", "day"), "dedup")


@query("stream_validate", f"""
    SELECT COALESCE(code, 0) AS code, count(*) AS n FROM {q.MARKED} GROUP BY code""")
def _(t: Tables):
    # the office rule looks up the static side of a stream-static join
    arriving = _stream(t, "customer").selectExpr(*q.PEOPLE_COLUMNS)
    flagged = q.quality.flag_resolved(arriving, "office", t.nation, "n_nationkey", "office_found")
    good, rejected = jobs.validating(flagged, q.people_rules(), "validate")
    return (good.agg(F.count("*").alias("n")).select(F.lit(0).alias("code"), "n")
            .unionByName(rejected.groupBy("code").agg(F.count("*").alias("n"))))


@query("stream_upsert", """
    WITH last AS (SELECT o_custkey * 2 AS key, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, COALESCE(l.status, c_mktsegment) AS status FROM customer LEFT JOIN last l ON c_custkey = l.key
    UNION ALL SELECT key, status FROM last WHERE key NOT IN (SELECT c_custkey FROM customer)""")
def _(t: Tables):
    arriving = _stream(t, "orders").select((F.col("o_custkey") * 2).alias("key"), "o_orderdate", "o_orderkey", "o_orderstatus")
    latest = jobs.latest_changes(arriving, "key", [F.col("o_orderdate"), F.col("o_orderkey")], "upsert")
    target = t.customer.select("c_custkey", F.col("c_mktsegment").alias("status"))
    return changes.merge_rows(target, latest, "c_custkey", "key",
                              update={"status": F.col("src.o_orderstatus")},
                              insert={"c_custkey": F.col("src.key"), "status": F.col("src.o_orderstatus")})


def _in_batches(t: Tables, rows, name: str, batches: int):
    """A stream over `rows`, as a folder of that many files that arrive one by one."""
    folder = new_path(t.spark, "arrivals")
    rows.repartition(batches, *rows.columns).write.parquet(f"{folder}/{name}")
    return jobs.arriving(t.spark, folder, name, rows.schema, files_per_batch=1)


@query("stream_upsert_published", """
    WITH last AS (SELECT o_custkey * 2 AS key, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, max((o_orderdate, o_orderkey)) AS latest
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, COALESCE(l.status, c_mktsegment) AS status, latest[2] AS by_order, 1 AS n FROM customer LEFT JOIN last l ON c_custkey = l.key
    UNION ALL SELECT key, status, latest[2], 1 FROM last WHERE key NOT IN (SELECT c_custkey FROM customer)""")
def _(t: Tables):
    """Three batches land in the table as they arrive; the second comes twice, as after a restart."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    none = lambda kind: F.lit(None).cast(kind)
    orders = t.orders.select((F.col("o_custkey") * 2).alias("key"), "o_orderdate", "o_orderkey", "o_orderstatus")
    tables.replace({"customer": t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("status"), none(orders.schema["o_orderdate"].dataType).alias("at_date"), none("long").alias("by_order"))})
    newer = F.col("by_order").isNull() | (F.struct("src.o_orderdate", "src.o_orderkey") > F.struct("at_date", "by_order"))
    values = {"status": "o_orderstatus", "at_date": "o_orderdate", "by_order": "o_orderkey"}
    land = jobs.upserts(tables, "customer", "c_custkey", "key", [F.col("o_orderdate"), F.col("o_orderkey")],
                        update={c: F.when(newer, F.col(f"src.{v}")).otherwise(F.col(c)) for c, v in values.items()},
                        insert={"c_custkey": F.col("src.key"), **{c: F.col(f"src.{v}") for c, v in values.items()}}, stream="orders")

    def arrive(batch, number, path):
        for _ in range(2 if number == 1 else 1):
            land(batch, number)

    jobs.run_batches(_in_batches(t, orders, "orders", 3), "upserts", arrive)
    # with the number of versions that hold batches beyond the three: 1 says that the repeated one made none
    extra = tables.version().number - 3
    return tables.read("customer").select("c_custkey", "status", "by_order", F.lit(extra).alias("n"))


@query("stream_counter_folded", "SELECT o_custkey, count(*) FILTER (o_orderstatus <> 'F') AS n FROM orders GROUP BY o_custkey")
def _(t: Tables):
    """Orders arrive with +1; those that are finished leave again with -1, some before they have arrived."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    tables.replace({"counts": t.orders.select("o_custkey", F.lit(0).cast("long").alias("n")).limit(0)})
    came = t.orders.select("o_custkey", "o_orderkey", F.lit(1).alias("change"))
    left = t.orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", F.lit(-1).alias("change"))
    land = jobs.folded_counts(tables, "counts", "o_custkey", "o_custkey", "change", "n", "orders")
    jobs.run_batches(_in_batches(t, came.unionByName(left), "orders", 3), "counts", lambda batch, number, path: land(batch, number))
    return tables.read("counts")


@query("stream_refused_for_good", """
    SELECT user_id || '-' || event_type AS login, 1 AS accepted, count(*) - 1 AS refused FROM events GROUP BY user_id, event_type""")
def _(t: Tables):
    """The first row of a key that arrives is taken; every later one is refused, in its batch or in any that follows."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    login = F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("login")
    land = jobs.accepted_once(tables, "users", "refused", "login", "event_id", "events")
    jobs.run_batches(_in_batches(t, t.events.select(login, "event_id"), "events", 3), "refusals", lambda batch, number, path: land(batch, number))
    count = lambda name, column: tables.read(name).groupBy("login").agg(F.count(F.lit(1)).alias(column))
    return count("users", "accepted").join(count("refused", "refused"), "login", "left").select(
        "login", F.col("accepted").cast("int").alias("accepted"), F.coalesce("refused", F.lit(0).cast("long")).alias("refused"))


@query("stream_stored_expiry", """
    SELECT user_id, strftime(max(ts) + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S.%f') AS valid_until
    FROM events GROUP BY user_id""")
def _(t: Tables):
    """Touches arrive in any order; the stored row of a user is that of `session_expiry` over all of them."""
    tables = TableSet(t.spark, new_path(t.spark, "tables"))
    land = jobs.stored_expiry(tables, "sessions", "user_id", "ts", F.make_dt_interval(days=F.lit(7)), "events")
    jobs.run_batches(_in_batches(t, t.events.select("user_id", "ts"), "events", 3), "expiry", lambda batch, number, path: land(batch, number))
    return tables.read("sessions").select("user_id", F.date_format("valid_until", TEXT).alias("valid_until"))
