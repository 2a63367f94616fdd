"""Streams over several files, late rows, resuming, and equality with the batch result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablespan.functions import checks
from tablespan.scratch import new_path
from tablespan.streaming import jobs

START = dt.datetime(2024, 1, 1)


def hours(n):
    return START + dt.timedelta(hours=n)


def files(spark, schema, *batches):
    """One file per batch, with modification times in order."""
    import os
    import time

    folder, seen = new_path(spark, "arriving"), set()
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stamp = time.time() - 1000 + number * 10
        for name in set(os.listdir(folder)) - seen:
            os.utime(f"{folder}/{name}", (stamp, stamp))
        seen |= set(os.listdir(folder))
    return folder


def stream(spark, folder, schema):
    parent, name = folder.rsplit("/", 1)
    return jobs.arriving(spark, parent, name, schema, files_per_batch=1)


def test_sessions_with_a_late_row(spark):
    schema = "user long, ts timestamp"
    folder = files(spark, schema,
                   [(1, hours(0)), (1, hours(10)), (2, hours(1))],
                   [(1, hours(20)), (2, hours(60))],
                   [(2, hours(61)), (3, hours(200))],
                   [(1, hours(2))])  # later than allowed, and its session is closed
    closed = jobs.run_to_table(jobs.sessions(stream(spark, folder, schema), "user", "ts", "12 hours", "24 hours"), "s")
    assert sorted((r.user, r.touches, r.started, r.valid_until) for r in closed.collect()) == [
        (1, 3, hours(0), hours(32)), (2, 1, hours(1), hours(13)), (2, 2, hours(60), hours(73))]


def test_counts_resume(spark):
    schema = "k string"
    folder = files(spark, schema, [("a",), ("b",), ("a",)], [("a",)])
    path = new_path(spark, "counts")
    first = jobs.running_counts(stream(spark, folder, schema), "k", "c", path)
    assert {tuple(r) for r in first.collect()} == {("a", 3), ("b", 1)}
    spark.createDataFrame([("b",), ("c",)], schema).coalesce(1).write.mode("append").parquet(folder)
    again = jobs.running_counts(stream(spark, folder, schema), "k", "c", path)
    assert {tuple(r) for r in again.collect()} == {("a", 3), ("b", 2), ("c", 1)}


def test_repeats_are_refused_on_arrival(spark):
    schema = "login string, ts timestamp"
    folder = files(spark, schema, [("a", hours(0)), ("a", hours(1))], [("b", hours(2)), ("a", hours(3)), ("z", hours(3))])
    stored = spark.createDataFrame([("z",)], "login string")
    first = jobs.first_arrivals(stream(spark, folder, schema), ["login"], "ts", "1 day", stored)
    got = jobs.run_to_table(first, "d").collect()
    assert sorted(r.login for r in got) == ["a", "b"]


def test_validation_has_two_sinks(spark):
    schema = "id long, email string"
    folder = files(spark, schema, [(1, "a@b.pl"), (2, "nope")], [(3, None), (4, "x")])
    rules = [(-20005, checks.email_ok(F.col("email")))]
    good, bad = jobs.validating(stream(spark, folder, schema), rules, "v")
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert sorted((r.id, r.code) for r in bad.collect()) == [(2, -20005), (4, -20005)]


def test_last_change_wins_across_batches(spark):
    schema = "key long, at long, v string"
    folder = files(spark, schema, [(1, 1, "a"), (1, 3, "c"), (2, 1, "x")], [(1, 2, "b"), (2, 5, "y")])
    got = jobs.latest_changes(stream(spark, folder, schema), "key", [F.col("at")], "u")
    assert {tuple(r) for r in got.collect()} == {(1, 3, "c"), (2, 5, "y")}


def test_frequent_key_keeps_one_row(spark):
    schema = "login string, n long, ts timestamp"
    rows = [("hot", n, hours(0)) for n in range(200)] + [("cold", 1, hours(1))]
    folder = files(spark, schema, rows, [("hot", 999, hours(2)), ("new", 1, hours(2))])
    first = jobs.first_arrivals(stream(spark, folder, schema), ["login"], "ts", "1 day")
    assert sorted(r.login for r in jobs.run_to_table(first, "d").collect()) == ["cold", "hot", "new"]


@pytest.mark.parametrize("name", ["stream_sessions", "stream_counter", "stream_dedup", "stream_validate", "stream_upsert"])
def test_tables_of_several_files(spark, name):
    """Each table as a folder of part files, as large tables are, against the SQL on the single files."""
    import os

    import duckdb

    from compare import rows_of
    from tablespan.plans import JOBS, SQL

    source, folder = "/root/testdata/sf0.001", new_path(spark, "tables")
    con = duckdb.connect()
    for table in ("events", "orders", "customer", "nation"):
        spark.read.parquet(f"{source}/{table}.parquet").repartition(3).write.parquet(f"{folder}/{table}.parquet")
        assert len([f for f in os.listdir(f"{folder}/{table}.parquet") if f.endswith(".parquet")]) == 3
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{source}/{table}.parquet'")
    got = JOBS[name](spark, folder)
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_a_table_without_files_is_an_error(spark):
    import os

    folder = new_path(spark, "none")
    os.makedirs(f"{folder}/t.parquet")
    for name in ("t.parquet", "missing.parquet"):
        with pytest.raises(FileNotFoundError):
            jobs.arriving(spark, folder, name, "k string")
