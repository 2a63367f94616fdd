"""Changes to a table as a new snapshot computed from the old one and a change set."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablespan.functions.draws import draw, draw_from
from tablespan.operators.ordinals import running_total
from tablespan.operators.relational import checked_predicate
from tablespan.scratch import table_or_empty
from tablespan.sources.contracts import Contract, aligned


def insert_rows(table: DataFrame, new_rows: DataFrame, contract: Contract) -> DataFrame:
    """Append rows; columns that `new_rows` lacks take their declared default."""
    return aligned(table, contract).unionByName(aligned(new_rows, contract))


def assign_ids(df: DataFrame, id_col: str, order: list[str], **sampling) -> DataFrame:
    """Fill missing ids with consecutive numbers after the largest given id, in `order`.
    Given ids are kept, so no new id can collide with one."""
    top = df.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    missing = running_total(df.where(F.col(id_col).isNull()), [], order, "_n", **sampling)
    filled = missing.withColumn(id_col, F.col("_n") + top).drop("_n")
    return df.where(F.col(id_col).isNotNull()).withColumn(
        id_col, F.col(id_col).cast("long")).unionByName(filled)


def stamp(df: DataFrame, column: str, at: dt.datetime) -> DataFrame:
    """Set the insert time of the batch, whatever was supplied."""
    return df.withColumn(column, F.lit(at))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the condition is true; rows where it is NULL stay as they are."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, text: str, allowed: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Delete by a predicate given as text. Returns (kept rows, one row with `removed` and `kept`).
    Rows where the predicate is NULL are kept."""
    hit = F.coalesce(checked_predicate(df, text, allowed or df.columns), F.lit(False))
    report = df.agg(F.count_if(hit).alias("removed"), F.count_if(~hit).alias("kept"))
    return df.where(~hit), report


def merge_rows(target: DataFrame, source: DataFrame, target_key: str, source_key: str,
               update: dict[str, Column], insert: dict[str, Column]) -> DataFrame:
    """Upsert. `update` gives new values for matched target rows, `insert` the columns of a new row
    for a source row without match (others NULL); source columns are read as `src.name`.

    A key that several source rows share is an error once a target row matches it; the source is
    brought to one record per key first, on the same shuffle the join needs."""
    per_key = (source.where(F.col(source_key).isNotNull())
               .groupBy(F.col(source_key).alias("_key"))
               .agg(F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*source.columns)).alias("src")))
    hit = F.col("_key").isNotNull()
    joined = target.join(per_key, F.col(target_key) == F.col("_key"), "left")
    # a filter, so that a query that uses none of the updated columns cannot go round the check
    several = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    updated = joined.where(F.when(F.col("_rows") > 1, several).otherwise(True)).select([
        F.when(hit, update[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        if f.name in update else F.col(f.name) for f in target.schema])
    known = target.select(F.col(target_key).alias("_known")).distinct()
    new = (source.select(F.struct(*source.columns).alias("src"))
           .join(known, F.col(f"src.{source_key}") == F.col("_known"), "left_anti"))
    inserted = new.select([
        insert.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema])
    return updated.unionByName(inserted)


def maintained_counts(parents: DataFrame, key: str, counter: str, links: DataFrame,
                      link_key: str) -> DataFrame:
    """Recompute a stored counter from the links. Parents without links keep their value."""
    counts = links.groupBy(F.col(link_key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return (parents.join(counts, F.col(key) == F.col("_key"), "left")
            .withColumn(counter, F.coalesce(F.col("_n"), F.col(counter).cast("long")))
            .select(*parents.columns))


BLOCK = 4096


def numbered_copies(templates: DataFrame, copies: Column, number: str = "number") -> DataFrame:
    """`copies` rows per template, numbered from 1. Numbers are made in blocks that are spread over
    all tasks before they unfold, so one template with very many copies is no bottleneck."""
    tasks = int(templates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (templates.withColumn("_copies", copies.cast("long")).where(F.col("_copies") > 0)
              .withColumn("_block", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / BLOCK))))
              .repartition(tasks, *templates.columns, "_block"))
    first = F.col("_block") * BLOCK + 1
    return (blocks.withColumn(number, F.explode(F.sequence(
                first, F.least(F.col("_copies"), first + (BLOCK - 1)))))
            .drop("_copies", "_block"))


def numbered_users(spark: SparkSession, template: dict[str, str], n: int) -> DataFrame:
    """Users from one template: the number follows the login, name and password, and precedes the
    e-mail address."""
    if n <= 0:
        raise ValueError("the number of users must be positive")
    number = F.col("id").cast("string")
    return spark.range(1, n + 1).select(
        F.concat(F.lit(template["login"]), number).alias("login"),
        F.concat(F.lit(template["password"]), number).alias("password"),
        F.concat(F.lit(template["name"]), number).alias("name"),
        F.concat(number, F.lit(template["email"])).alias("email"),
        *[F.lit(v).alias(k) for k, v in template.items()
          if k not in ("login", "password", "name", "email")])


def session_expiry(touches: DataFrame, key: str, ts: str, days: int = 7) -> DataFrame:
    """Every touch extends validity: last touch + `days` per key."""
    return touches.groupBy(key).agg(
        (F.max(ts) + F.make_dt_interval(days=F.lit(days))).alias("valid_until"))


def reassign_some(people: DataFrame, id_col: str, office_col: str, name_col: str, sex_col: str,
                  expected: int, offices: list[int], rename_to: str, seed: int) -> DataFrame:
    """Move about `expected` people, chosen by a hash of their id, to one of the given offices, and
    rename about one in a hundred of the men among them."""
    total = people.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).cast("long")).scalar()
    row_id = F.col(id_col)
    moved = people.withColumn("_total", total).withColumn(
        "_moved", draw(row_id, "chosen", seed, 0, F.col("_total")) < expected)
    office = draw_from(row_id, "office", seed, [str(o) for o in offices]).cast("long")
    renamed = F.col("_moved") & (draw(row_id, "renamed", seed, 0, 100) == 0) & (F.col(sex_col) == "m")
    return update_where(update_where(moved, renamed, {name_col: F.lit(rename_to)}),
                        F.col("_moved"), {office_col: office}).drop("_total", "_moved")


# ---------------------------------------------------------------- all-or-nothing batches

VERSIONS = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()), T.StructField("published_at", T.TimestampType())])


class SnapshotTable:
    """A table as a series of published snapshots. Readers see the newest published one; a batch
    that is not published leaves no trace for them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> DataFrame:
        return table_or_empty(self.spark, f"{self.folder}/published", VERSIONS).select(VERSIONS.names)

    def current(self) -> DataFrame | None:
        newest = self._versions().orderBy(F.desc("version")).first()
        return self.spark.read.parquet(newest["path"]) if newest else None

    def _claimed(self) -> int:
        """The next version number. It is claimed by making a file of that name, which only one of
        several publishers can."""
        version = self._versions().agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).first()["v"] + 1
        jvm = self.spark._jvm.org.apache.hadoop.fs
        while True:
            claim = jvm.Path(f"{self.folder}/claims/{version}")
            files = claim.getFileSystem(self.spark._jsc.hadoopConfiguration())
            try:
                if files.createNewFile(claim):
                    return version
            except Py4JJavaError:
                if not files.exists(claim):
                    raise
            version += 1

    def publish(self, batch: DataFrame, at: dt.datetime, expected_rows: int | None = None,
                rejected: DataFrame | None = None) -> bool:
        """Stage the batch and publish it only if it has the expected number of rows and nothing
        was rejected. Publishing is one small file appended after the data is complete."""
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        batch.write.parquet(path)
        rows = self.spark.read.parquet(path).count()
        if expected_rows is not None and rows != expected_rows:
            return False
        if rejected is not None and not rejected.isEmpty():
            return False
        version = self._claimed()
        # a folder of its own: two writers that append to one folder clear away each other's files
        (self.spark.createDataFrame([(version, path, rows, at)], VERSIONS)
         .coalesce(1).write.parquet(f"{self.folder}/published/claim={version}"))
        return True
