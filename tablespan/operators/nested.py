"""Children as arrays or maps of their parent, and back.

A parent may have any number of children, so an array per parent could outgrow one row. `nest`
therefore gives arrays of at most `chunk` elements and numbers them: a parent with few children
has the single chunk 0, a parent with very many has as many chunks as needed, and none is lost."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablespan.operators.ordinals import running_total, top_in_group
from tablespan.operators.relational import keep_empty_join
from tablespan.scratch import written_table

CHUNK = 50  # declared bound of a record collection


def nest(df: DataFrame, keys: list[str], children: list[str], order: list[str],
         name: str = "items", chunk: int = CHUNK, **sampling) -> DataFrame:
    """(keys, chunk_no, items): the child records of each parent in `order`."""
    numbered = running_total(df, keys, order, "_pos", **sampling)
    record = F.struct("_pos", *children)
    return (numbered.withColumn("chunk_no", F.floor((F.col("_pos") - 1) / chunk).cast("long"))
            .groupBy(*keys, "chunk_no")
            .agg(F.array_sort(F.collect_list(record)).alias("_items"))
            .select(*keys, "chunk_no", F.transform(
                "_items", lambda r: F.struct(*[r[c].alias(c) for c in children])).alias(name)))


def bounded_lists(df: DataFrame, keys: list[str], value: str, limit: int, name: str = "items") -> DataFrame:
    """(keys, items): the values of each group, ascending, as one array. A group of more than `limit` rows is an error: groups
    are counted first, which is reduced before its shuffle, and a large one ends the job before its rows are gathered."""
    known = [f"_key{i}" for i in range(len(keys))]
    too_many = F.raise_error(F.lit(f"more than {limit} elements")).cast("boolean")
    fitting = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).toDF(*known, "_n")
               .where(F.when(F.col("_n") > limit, too_many).otherwise(True)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(c)) for k, c in zip(keys, known)])
    return df.join(fitting, same, "left_semi").groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def nest_under(parents: DataFrame, parent_key: str, df: DataFrame, child_key: str,
               children: list[str], order: list[str], name: str = "items", chunk: int = CHUNK,
               **sampling) -> DataFrame:
    """Every parent with its child records. Children are nested before the join, which then moves
    one row per chunk; a parent without any gets chunk 0 with an empty array."""
    nested = nest(df, [child_key], children, order, name, chunk, **sampling)
    empty = F.array().cast(nested.schema[name].dataType)
    return (keep_empty_join(parents, parent_key, nested, child_key, right_keys=df)
            .select(*parents.columns, F.coalesce("chunk_no", F.lit(0)).alias("chunk_no"),
                    F.coalesce(name, empty).alias(name)))


def count_map(df: DataFrame, keys: list[str], entry: str, name: str = "counts",
              **sampling) -> DataFrame:
    """(keys, chunk_no, map of entry -> rows), at most CHUNK entries per map, keys ascending.
    Counting happens first, so only distinct entries are collected."""
    counted = (df.where(F.col(entry).isNotNull()).groupBy(*keys, entry)
               .agg(F.count(F.lit(1)).alias("_n")))
    counted = written_table(counted, "entry-counts")  # read several times below
    nested = nest(counted, keys, [entry, "_n"], [entry], "_entries", **sampling)
    return nested.select(*keys, "chunk_no", F.map_from_entries("_entries").alias(name))


def sorted_entries(m: Column) -> Column:
    """Map entries in ascending key order (a map has no order of its own)."""
    return F.array_sort(F.map_entries(m))


def slots(df: DataFrame, keys: list[str], order: list[str], value: str, count: int,
          prefix: str) -> DataFrame:
    """The first `count` children of each parent in columns prefix1, prefix2, ..."""
    first = top_in_group(df, keys, [F.col(c) for c in order], count, "_slot")
    return first.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_slot") == i, F.col(value))).alias(f"{prefix}{i}")
        for i in range(1, count + 1)])


def elements(df: DataFrame, keys: list[str], array: Column) -> DataFrame:
    """One row per element with its 1-based position."""
    return (df.select(*keys, F.posexplode(array).alias("_pos", "element"))
            .select(*keys, (F.col("_pos") + 1).cast("long").alias("position"), "element"))
