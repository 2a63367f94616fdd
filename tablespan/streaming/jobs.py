"""Streams over tables that keep arriving: sessions, counters, duplicate removal, validation, upsert.

Each job reads new files of one table, keeps its offsets and state in the shared folder and writes
Parquet there, so it resumes after losing executors or the driver. `availableNow` processes what
has arrived and ends. Results of keyed jobs are logs of changed rows per batch (a batch writes its
own folder, so a repeated batch replaces itself); the newest entry of a key is its current value."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablespan.operators.quality import Rule, existing_or_repeated, validated
from tablespan.scratch import new_path, table_or_empty, written_table
from tablespan.session import SETTINGS
from tablespan.sources.tableset import TableSet


def arriving(spark: SparkSession, folder: str, name: str, schema: T.StructType,
             files_per_batch: int | None = None) -> DataFrame:
    """New files of the table `name`: those in the folder `name` below `folder`, or the one file of
    that name. A table without any file is an error, for a stream over it would end without rows."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.isDirectory(path):
        if not any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(path)):
            raise FileNotFoundError(f"no files in {folder}/{name}")
        return reader.parquet(f"{folder}/{name}")
    if not files.exists(path):
        raise FileNotFoundError(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


@contextmanager
def _stream_settings(spark: SparkSession):
    """Settings a stream takes over when it starts: UTC, state off the heap, and sessions merged
    within each task before the shuffle, so that a busy key sends sessions, not rows. State is
    divided by the session's shuffle partitions for good: choose them for the table to come, not for
    what has arrived at the first start."""
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.streaming.stateStore.providerClass": SETTINGS["spark.sql.streaming.stateStore.providerClass"],
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _run(writer, path: str) -> None:
    query = (writer.option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start())
    query.awaitTermination()


def run_to_table(stream: DataFrame, label: str, mode: str = "append", path: str | None = None) -> DataFrame:
    """Run to the end of what has arrived; returns the result table. With `path` from an earlier
    run it resumes there."""
    spark = stream.sparkSession
    path = path or new_path(spark, label)
    with _stream_settings(spark):
        _run(stream.writeStream.format("parquet").outputMode(mode).option("path", f"{path}/out"), path)
    return table_or_empty(spark, f"{path}/out", stream.schema)


def run_batches(stream: DataFrame, label: str, handle: Callable[[DataFrame, int, str], None],
                mode: str = "append", path: str | None = None) -> str:
    """Run `handle(batch, batch_id, path)` for each batch; returns the path used."""
    spark = stream.sparkSession
    path = path or new_path(spark, label)
    with _stream_settings(spark):
        _run(stream.writeStream.outputMode(mode).foreachBatch(
            lambda df, batch: handle(df, batch, path)), path)
    return path


# ---------------------------------------------------------------- jobs

def sessions(touches: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """Sessions that end `gap` after their last touch, emitted once no touch can still arrive
    (touches more than `late` behind the newest are dropped). The end is computed from the last
    touch: a filter on the session column itself would be moved below the merging of sessions and
    cut them short."""
    return (touches.withWatermark(ts, late)
            .groupBy(F.session_window(ts, gap).alias("_session"), key)
            .agg(F.count(F.lit(1)).alias("touches"), F.min(ts).alias("started"), F.max(ts).alias("last_touch"))
            .select(key, "touches", "started",
                    (F.col("last_touch") + F.expr(f"interval {gap}")).alias("valid_until")))


def running_counts(rows: DataFrame, key: str, label: str, path: str | None = None) -> DataFrame:
    """Rows per key, maintained as they arrive; each batch logs the keys it changed."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))

    def log(batch: DataFrame, number: int, folder: str) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/log/batch={number}")

    path = run_batches(counts, label, log, "update", path)
    schema = T.StructType([*counts.schema.fields, T.StructField("batch", T.LongType())])
    entries = table_or_empty(rows.sparkSession, f"{path}/log", schema)
    return entries.groupBy(key).agg(F.max_by("n", "batch").alias("n"))


def first_arrivals(rows: DataFrame, keys: list[str], ts: str, within: str,
                   stored: DataFrame | None = None, shares: int | None = None) -> DataFrame:
    """The first row per key; later rows with the same key are refused for at least `within`, after
    which the key is forgotten, so that state does not grow without end. Keys in the table `stored`
    are refused from the start.

    Repeats are removed twice: first within hashed shares of each key, so that the rows of a very
    frequent key are spread over several tasks, then among the at most `shares` rows left per key
    (as many as there are shuffle partitions, if not given)."""
    shares = shares or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if stored is not None:
        rows = rows.join(stored.select(*keys).distinct(), keys, "left_anti")
    share = F.pmod(F.xxhash64(F.struct(*rows.columns)), F.lit(shares))
    return (rows.withColumn("_share", share).withWatermark(ts, within)
            .dropDuplicatesWithinWatermark([*keys, "_share"])
            .dropDuplicatesWithinWatermark(keys).drop("_share"))


def validating(rows: DataFrame, rules: list[Rule], label: str,
               path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows to one table, rejected rows with their code to another."""
    marked = validated(rows, rules)

    def split(batch: DataFrame, number: int, folder: str) -> None:
        # one write, divided by a partition column: the batch is computed once
        (batch.withColumn("sink", F.when(F.col("code").isNull(), "good").otherwise("rejected"))
         .write.mode("overwrite").partitionBy("sink").parquet(f"{folder}/log/batch={number}"))

    path = run_batches(marked, label, split, "append", path)
    schema = T.StructType([*marked.schema.fields, T.StructField("batch", T.LongType()),
                           T.StructField("sink", T.StringType())])
    entries = table_or_empty(rows.sparkSession, f"{path}/log", schema).drop("batch")
    good = entries.where(F.col("sink") == "good").drop("sink", "code")
    return good, entries.where(F.col("sink") == "rejected").drop("sink")


def latest_changes(rows: DataFrame, key: str, order: list[Column], label: str,
                   path: str | None = None) -> DataFrame:
    """One record per key: the last of its rows by `order`, reduced within each batch as it arrives
    and across batches when read. Ready as the source of a merge."""
    names = rows.columns
    newest = F.max_by(F.struct(*names), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))

    def log(batch: DataFrame, number: int, folder: str) -> None:
        (batch.groupBy(F.col(key).alias("_key")).agg(newest.alias("_row")).select("_row.*")
         .write.mode("overwrite").parquet(f"{folder}/log/batch={number}"))

    path = run_batches(rows, label, log, "append", path)
    schema = T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])
    entries = table_or_empty(rows.sparkSession, f"{path}/log", schema)
    return entries.groupBy(F.col(key).alias("_key")).agg(newest.alias("_row")).select("_row.*")


# ---------------------------------------------------------------- changes that land in a table

def upserts(tables: TableSet, table: str, key: str, source_key: str, order: list[Column], update: dict[str, Column],
            insert: dict[str, Column], stream: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: the last row of each key in the batch is merged into `table`, and the batch is published as one
    version. A batch that comes again, after a restart, is known by its number and changes nothing. `update` decides
    what happens where the table already holds something newer; source columns are read as `src.name`."""
    def land(batch: DataFrame, number: int) -> None:
        if tables.published((stream, number)):
            return
        newest = F.max_by(F.struct(*batch.columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
        last = batch.groupBy(F.col(source_key).alias("_key")).agg(newest.alias("_row")).select("_row.*")
        tables.merge(table, written_table(last, "arrived"), key, source_key, update, insert, (stream, number))

    return land


def folded_counts(tables: TableSet, table: str, key: str, source_key: str, sign: str, counter: str,
                  stream: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: rows that arrive with +1 and leave with -1 are summed per key and folded into the stored counter,
    so a counter survives deletes and no log has to be read again. Keys the table lacks are added with what arrived."""
    def land(batch: DataFrame, number: int) -> None:
        if tables.published((stream, number)):
            return
        deltas = batch.groupBy(source_key).agg(F.sum(sign).cast("long").alias("_delta"))
        tables.merge(table, written_table(deltas, "deltas"), key, source_key, {counter: F.col(counter) + F.col("src._delta")},
                     {key: F.col(f"src.{source_key}"), counter: F.col("src._delta")}, (stream, number))

    return land


def accepted_once(tables: TableSet, table: str, refused: str, key: str, row_id: str, stream: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: rows whose key is new go to `table`, the others to `refused` with the reason (existing, or repeated
    within the batch), published together. Keys are asked of the table itself, of which a batch reads the key column only, so
    a key is refused for good, whatever time has passed and however often the stream was started anew. Of several rows
    with a new key the one with the smallest `row_id` is taken; rows without a key are."""
    def land(batch: DataFrame, number: int) -> None:
        if tables.published((stream, number)):
            return
        arrived = written_table(batch, "arrived")
        stored = tables.read(table) if tables.files(table) else arrived.limit(0)
        rejected = written_table(existing_or_repeated(arrived, key, row_id, stored, key), "refused")
        fresh = arrived.join(rejected.select(F.col(row_id).alias("_refused")), F.col(row_id) == F.col("_refused"), "left_anti")
        tables.append({table: fresh, refused: rejected}, (stream, number))

    return land


def stored_expiry(tables: TableSet, table: str, key: str, ts: str, gap: Column, stream: str,
                  until: str = "valid_until") -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: one stored row per key, valid until its last touch plus `gap`. A touch extends it however late it
    arrives, for nothing is forgotten; one that is older than the last changes nothing. `sessions` closes sessions instead."""
    def land(batch: DataFrame, number: int) -> None:
        if tables.published((stream, number)):
            return
        last = written_table(batch.groupBy(key).agg((F.max(ts) + gap).alias("_until")), "touches")
        if not tables.files(table):
            tables.replace({table: last.select(key, F.col("_until").alias(until)).limit(0)})
        tables.merge(table, last, key, key, {until: F.greatest(until, "src._until")},
                     {key: F.col(f"src.{key}"), until: F.col("src._until")}, (stream, number))

    return land
