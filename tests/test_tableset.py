"""Versions of several tables: all or nothing, file by file, and each batch once."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablespan.plans.change_queries import GROUP
from tablespan.scratch import new_path
from tablespan.sources.tableset import Conflict, Refused, TableSet
from tablespan.streaming import jobs

SCHEMA = "id long, name string"


@pytest.fixture
def tables(spark):
    return TableSet(spark, new_path(spark, "tables"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def numbered(spark, n, files):
    return spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name")).repartitionByRange(files, "id")


def test_a_set_begins_empty(tables):
    assert tables.version().number == 0 and tables.files("t") == []
    with pytest.raises(LookupError):
        tables.read("t")


def test_a_failing_child_leaves_every_table(spark, tables):
    region = spark.createDataFrame([(1, "a"), (2, "b")], "r_regionkey long, r_name string")
    nation = spark.createDataFrame([(1, 1), (2, 2)], "n_nationkey long, n_regionkey long")
    customer = spark.createDataFrame([(1, 1), (2, None)], "c_custkey long, c_nationkey long")
    first = tables.reload({"customer": customer, "nation": nation, "region": region}, GROUP)
    before = {n: rows(tables.read(n)) for n in ("region", "nation", "customer")}
    fewer = {"region": region.where("r_regionkey = 1"), "nation": nation.where("n_regionkey = 1")}
    broken = customer.withColumn("c_custkey", F.raise_error(F.lit("unreadable")).cast("long"))
    for bad, error in ((customer.withColumn("c_nationkey", F.lit(9).cast("long")), Refused), (customer.union(customer), Refused), (broken, Exception)):
        with pytest.raises(error):
            tables.reload({**fewer, "customer": bad}, GROUP)
        assert tables.version() == first and {n: rows(tables.read(n)) for n in before} == before
    # a parent alone, whose children stay as they are, is not looked at from below; a child alone is checked against the present parent
    with pytest.raises(Refused):
        tables.reload({"nation": nation.withColumn("n_regionkey", F.lit(7).cast("long"))}, GROUP)
    with pytest.raises(Refused):
        tables.reload({"other": region}, GROUP)
    tables.reload({**fewer, "customer": customer}, GROUP)
    assert tables.read("region").count() == 1 and rows(tables.read("customer")) == before["customer"]
    assert rows(tables.read("region", first)) == before["region"]          # readers of the old version keep it


def test_untouched_files_keep_their_names(spark, tables):
    tables.replace({"t": numbered(spark, 1000, 10), "other": numbered(spark, 5, 1)})
    before, other = set(tables.files("t")), tables.files("other")
    source = spark.createDataFrame([(3, "x"), (4, "y"), (5000, "new"), (None, "none")], "key long, label string")
    tables.merge("t", source, "id", "key", {"name": F.col("src.label")}, {"id": F.col("src.key"), "name": F.col("src.label")})
    after = set(tables.files("t"))
    assert len(before - after) == 1 and len(before & after) == 9 and tables.files("other") == other
    want = {i: f"n{i}" for i in range(1000)} | {3: "x", 4: "y", 5000: "new", None: "none"}
    assert rows(tables.read("t")) == sorted(want.items(), key=str)

    before = after
    tables.update("t", F.col("id").between(990, 999), {"name": F.lit("late")})
    assert len(before - set(tables.files("t"))) == 1 and tables.read("t").where("name = 'late'").count() == 10
    before = set(tables.files("t"))
    tables.delete("t", "id >= 500 AND id < 505")
    assert len(before - set(tables.files("t"))) == 1 and tables.read("t").count() == 997
    for text in ("", "_file = 'x'", "id IN (SELECT 1)"):
        with pytest.raises(Exception):
            tables.delete("t", text)


def test_changes_that_hit_nothing(spark, tables):
    tables.replace({"t": numbered(spark, 10, 2)})
    before = rows(tables.read("t"))
    tables.update("t", F.col("id") > 100, {"name": F.lit("x")})
    tables.delete("t", "id > 100")
    tables.merge("t", spark.createDataFrame([], "key long, label string"), "id", "key", {}, {})
    assert rows(tables.read("t")) == before
    tables.delete("t", "1=1")
    assert tables.read("t").columns == ["id", "name"] and tables.read("t").count() == 0
    tables.merge("t", spark.createDataFrame([(1, "a")], "key long, label string"), "id", "key", {}, {"id": F.col("src.key"), "name": F.col("src.label")})
    assert rows(tables.read("t")) == [(1, "a")]


def test_files_are_found_by_the_key_column_alone(spark, tables):
    tables.replace({"t": numbered(spark, 100, 4)})
    scan = tables.read("t").withColumn("_file", F.col("_metadata.file_name")).select("id", "_file")
    assert "ReadSchema: struct<id:bigint>" in scan._jdf.queryExecution().executedPlan().toString()


def test_a_second_change_of_one_version_is_refused(spark, tables):
    tables.replace({"t": numbered(spark, 10, 1)})
    base = tables.version()
    tables._publish(base, {"t": tables._staged(numbered(spark, 3, 1))}, None)
    with pytest.raises(Conflict):
        tables._publish(base, {"t": tables._staged(numbered(spark, 4, 1))}, None)
    assert tables.read("t").count() == 3


def test_a_number_taken_and_not_used_is_released(spark, tables):
    tables.replace({"t": numbered(spark, 10, 1)})
    path, files = tables._path("versions/2")
    files.create(path, False).close()
    assert tables.version().number == 1
    with pytest.raises(Conflict):
        tables.replace({"t": numbered(spark, 3, 1)})
    tables.release()
    assert tables.replace({"t": numbered(spark, 3, 1)}).number == 2 and tables.read("t").count() == 3


def test_a_repeated_batch_changes_nothing(spark, tables):
    tables.replace({"t": numbered(spark, 4, 1)})
    source = spark.createDataFrame([(1, "a")], "key long, label string")
    merge = lambda batch: tables.merge("t", source, "id", "key", {"name": F.concat("name", F.col("src.label"))}, {}, batch)
    assert merge(("s", 0)).number == 2 and merge(("s", 0)).number == 2 and merge(("other", 0)).number == 3
    assert tables.published(("s", 0)) and not tables.published(("s", 1))
    assert dict(rows(tables.read("t")))[1] == "n1aa"


def test_counts_survive_deletes_and_restarts(spark, tables):
    """Three batches; the stream ends after two and is started again on the same state."""
    draw = random.Random(3)
    folder, path = new_path(spark, "arrivals"), new_path(spark, "state")
    changes = [(draw.choice([7, 7, 7, 1, 2, 3, 40 + i % 9]), draw.choice([1, 1, -1])) for i in range(600)]
    tables.replace({"counts": spark.createDataFrame([(2, 10)], "k long, n long")})
    land = jobs.folded_counts(tables, "counts", "k", "k", "change", "n", "s")
    want = Counter({2: 10})
    for part in range(3):
        some = changes[part * 200:(part + 1) * 200]
        spark.createDataFrame(some, "k long, change int").coalesce(1).write.mode("append").parquet(f"{folder}/t")
        for k, change in some:
            want[k] += change
        seen = []
        stream = jobs.arriving(spark, folder, "t", "k long, change int", files_per_batch=1)
        jobs.run_batches(stream, "counts", lambda batch, number, _: (land(batch, number), land(batch, number), seen.append(number)), path=path)
        assert seen == [part] and dict(rows(tables.read("counts"))) == dict(want)
    assert tables.version().number == 4


def test_upserts_keep_what_is_newer(spark, tables):
    draw = random.Random(5)
    tables.replace({"t": spark.createDataFrame([(1, "old", 50)], "id long, v string, at long")})
    newer = F.col("src.at") > F.col("at")
    land = jobs.upserts(tables, "t", "id", "id", [F.col("at")], {"v": F.when(newer, F.col("src.v")).otherwise(F.col("v")), "at": F.greatest("at", "src.at")},
                        {c: F.col(f"src.{c}") for c in ("id", "v", "at")}, "s")
    want = {1: (50, "old")}
    for number in range(3):
        batch = [(draw.randint(1, 5), f"v{number}.{i}", at) for i, at in enumerate(draw.sample(range(100), 12))]
        for k, v, at in batch:
            want[k] = max(want.get(k, (-1, "")), (at, v))
        land(spark.createDataFrame(batch, "id long, v string, at long"), number)
    assert rows(tables.read("t")) == sorted(((k, v, at) for k, (at, v) in want.items()), key=str)


def test_a_key_is_refused_for_good(spark, tables):
    """In its own batch, in later ones, and when the stream is started anew; a repeated batch decides nothing again."""
    land = jobs.accepted_once(tables, "users", "refused", "login", "id", "s")
    batches = [[(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], [(6, "b"), (7, "c")], [(8, "a"), (9, "d"), (10, "d"), (11, "c")]]
    for number, batch in enumerate(batches):
        for _ in range(2):
            land(spark.createDataFrame(batch, "id long, login string"), number)
        land = jobs.accepted_once(tables, "users", "refused", "login", "id", "s")
    assert {r.id for r in tables.read("users").collect()} == {1, 2, 4, 5, 7, 9} and tables.read("users").count() == 6
    assert {(r.id, r.reason) for r in tables.read("refused").collect()} == {
        (3, "repeated"), (6, "existing"), (8, "existing"), (10, "repeated"), (11, "existing")}
    assert tables.version().number == 3


def test_a_late_touch_extends_the_stored_row(spark, tables):
    from tablespan.operators import changes

    day = lambda d: f"2024-03-{d:02d} 12:00:00"
    batches = [[(1, day(20)), (2, day(1))], [(1, day(10)), (2, day(25)), (3, None)], [(2, day(2)), (1, day(21)), (1, day(5))]]
    land = jobs.stored_expiry(tables, "sessions", "user", "ts", F.make_dt_interval(days=F.lit(7)), "touches")
    frame = lambda some: spark.createDataFrame(some, "user long, ts string").select("user", F.col("ts").cast("timestamp_ntz").alias("ts"))
    for number, batch in enumerate(batches):
        land(frame(batch), number)
        land(frame(batch), number)
        assert rows(tables.read("sessions")) == rows(changes.session_expiry(frame(sum(batches[:number + 1], [])), "user", "ts", 7))
