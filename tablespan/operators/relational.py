"""Filters, joins, aggregates and top-k reports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablespan.functions.text import contains_ci
from tablespan.scratch import written_table

# ---------------------------------------------------------------- filters


def year_range(df: DataFrame, date_col: str, first_year: int, last_year: int) -> DataFrame:
    """Rows from 1 January of the first year up to midnight at the start of 31 December of the
    last, so later hours of that day are outside."""
    return df.where(F.col(date_col).between(
        F.make_timestamp_ntz(F.lit(first_year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
        F.make_timestamp_ntz(F.lit(last_year), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))))


def near_mean_year(df: DataFrame, date_col: str, years: int) -> DataFrame:
    """Rows between 1 January of (mean year - years) and of (mean year + years). The two bounds
    are scalar subqueries that Spark merges into one aggregate."""
    mean = F.floor(F.avg(F.year(date_col)))

    def new_year(shift: int) -> Column:
        return df.agg(F.make_timestamp_ntz((mean + shift).cast("int"), F.lit(1), F.lit(1),
                                           F.lit(0), F.lit(0), F.lit(0))).scalar()

    return df.where(F.col(date_col).between(new_year(-years), new_year(years)))


def search_titles(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(contains_ci(F.col(column), needle))


def checked_predicate(df: DataFrame, text: str, allowed: list[str]) -> Column:
    """A predicate given as text. Empty text, subqueries and columns outside `allowed` are refused."""
    if not text or not text.strip():
        raise ValueError("empty predicate; use 1=1 to select every row")
    only_allowed = df.sparkSession.createDataFrame([], df.select(*allowed).schema)
    plan = only_allowed.where(text)._jdf.queryExecution().analyzed()  # analysis fails on any other column
    if not plan.subqueriesAll().isEmpty():
        raise ValueError("a predicate may not contain a query")
    return F.expr(text)


# ---------------------------------------------------------------- joins


def child_counts(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str,
                 name: str) -> DataFrame:
    """Every parent with its number of children, 0 for none. Children are counted before the
    join, so a parent with very many of them arrives as one row."""
    counts = children.groupBy(F.col(child_key).alias("_parent")).agg(F.count(F.lit(1)).alias("_n"))
    return (parents.join(counts, F.col(parent_key) == F.col("_parent"), "left")
            .select(*parents.columns, F.coalesce("_n", F.lit(0)).alias(name)))


#: Rows, of both sides, that one task of a large join sorts.
TASK_ROWS = 1 << 20
KEY_SLOTS = 1 << 16


def keep_empty_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                    right_keys: DataFrame | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Left outer join for a right side that may repeat one key very often.

    Spark splits a skewed partition only on the preserved side of an outer join, but on both sides
    of an inner one. So: the inner join, plus the left rows without partner padded with NULLs; the
    second part needs only the distinct right keys, which are reduced before their shuffle. They can
    be given as `right_keys` where they are cheaper to get than from `right`.

    That leaves the rows of a task to the session's number of partitions. From four times `task_rows`
    rows on, both sides are counted and dealt by key into as many tasks as keep each near `task_rows`."""
    source = right if right_keys is None else right_keys
    n = left.count() + source.count()
    if n > 4 * task_rows:
        return _large_keep_empty_join(left, left_key, right, right_key, source, -(-n // task_rows), task_rows)
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = source.select(F.col(right_key).alias("_key")).distinct()
    alone = left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")
    return matched.unionByName(_padded(alone, left, right))


def _padded(rows: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    return rows.select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema])


def _large_keep_empty_join(left: DataFrame, left_key: str, right: DataFrame, right_key: str, source: DataFrame,
                           tasks: int, task_rows: int) -> DataFrame:
    """Keys with more than `task_rows` rows on one side are frequent; their rows there stay where they are and meet a copy
    of the other side's, each row of which stands for more than `task_rows` rows of the result. All other rows are dealt
    by key. NULL keys have no partner and are not shuffled."""
    spark = left.sparkSession
    tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    right_hot = _frequent(source, right_key, task_rows)
    left_hot = written_table(_frequent(left, left_key, task_rows).join(right_hot, "_key", "left_anti"), "frequent-keys")
    those = lambda rows, key, keys, how: rows.join(F.broadcast(keys), rows[key] == keys["_key"], how)
    parts = [_padded(left.where(F.col(left_key).isNull()), left, right)]
    rows, others = left.where(F.col(left_key).isNotNull()), right.where(F.col(right_key).isNotNull())
    for hot, copied in ((right_hot, "left"), (left_hot, "right")):
        if not hot.isEmpty():
            a, b = those(rows, left_key, hot, "left_semi"), those(others, right_key, hot, "left_semi")
            on = a[left_key] == b[right_key]
            parts.append(F.broadcast(a).join(b, on, "inner") if copied == "left" else a.join(F.broadcast(b), on, "left"))
            rows, others = those(rows, left_key, hot, "left_anti"), those(others, right_key, hot, "left_anti")
    rows, others = rows.repartition(tasks, left_key), others.repartition(tasks, right_key)
    joined = rows.join(others.hint("merge"), rows[left_key] == others[right_key], "left")
    for part in parts:
        joined = joined.unionByName(part)
    return joined


def _frequent(rows: DataFrame, key: str, more_than: int) -> DataFrame:
    """`_key`: the keys of more than so many rows. Slots of hashed keys are counted first, which needs little memory where
    most keys are different; exact counts are made in full slots only."""
    keys = rows.select(F.col(key).alias("_key")).where("_key is not null").withColumn("_slot", F.pmod(F.xxhash64("_key"), F.lit(KEY_SLOTS)))
    count = F.count(F.lit(1)).alias("_n")
    full = written_table(keys.groupBy("_slot").agg(count).where(F.col("_n") > more_than).select("_slot"), "full-slots")
    if full.isEmpty():
        return full.select(F.lit(None).cast(rows.schema[key].dataType).alias("_key"))
    found = keys.join(F.broadcast(full), "_slot", "left_semi").groupBy("_key").agg(count)
    return written_table(found.where(F.col("_n") > more_than).select("_key"), "frequent-keys")


class Level(NamedTuple):
    """One IN of a nested query: rows whose `outer` is among the `key` values of `table`. Say
    `unique` when `key` identifies the rows of `table`."""

    outer: str
    table: DataFrame
    key: str
    unique: bool = False


def semi_chain(target: DataFrame, levels: list[Level]) -> DataFrame:
    """Nested IN queries, outermost first; the `outer` of a level is a column of the table before
    it. Keys that may repeat are made distinct first: the same shuffle serves both steps, and a
    frequent key shrinks to one row per task before it."""
    first, rest = levels[0], levels[1:]
    inner = semi_chain(first.table, rest) if rest else first.table
    keys = inner.select(F.col(first.key).alias("_in"))
    keys = keys if first.unique else keys.distinct()
    return target.join(keys, F.col(first.outer) == F.col("_in"), "left_semi")


def resolved_by_code(df: DataFrame, code_col: str, parent: DataFrame, parent_code: str,
                     parent_id: str, name: str) -> DataFrame:
    """Add the id of the parent that has the given unique code, NULL when there is none."""
    codes = parent.select(F.col(parent_code).alias("_code"), F.col(parent_id).alias(name))
    return df.join(codes, F.col(code_col) == F.col("_code"), "left").drop("_code")


def byte_size(df: DataFrame) -> Column:
    """Aggregate: an upper estimate of the bytes of all rows."""
    total = F.lit(0).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(f.name).cast("long"), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))).cast("long"), F.lit(0)) + 16
        else:
            total = total + 16
    return F.coalesce(F.sum(total), F.lit(0))


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> tuple[DataFrame, bool]:
    """Mark `df` for broadcast only after measuring that it is small."""
    size = df.agg(byte_size(df).alias("bytes")).first()["bytes"]
    return (F.broadcast(df), True) if size <= max_bytes else (df, False)


STRATEGIES = ("hash", "merge", "lookup", "written_order")


def join_with(left: DataFrame, right: DataFrame, on: Column, how: str, strategy: str) -> DataFrame:
    """Equi-join by a chosen physical strategy; the rows are the same under each.

    hash: build a hash table per partition. merge: sort both sides. lookup: look up each left row
    in a complete copy of the right side, if that is measured to be small, else merge.
    written_order: as written, the planner free to choose (joins are not reordered by default)."""
    if strategy == "hash":
        return left.join(right.hint("shuffle_hash"), on, how)
    if strategy == "merge":
        return left.join(right.hint("merge"), on, how)
    if strategy == "lookup":
        right, small = broadcast_if_small(right)
        return left.join(right if small else right.hint("merge"), on, how)
    if strategy == "written_order":
        return left.join(right, on, how)
    raise ValueError(f"unknown strategy {strategy!r}; one of {STRATEGIES}")


def references_or_creates(facts: DataFrame, name_col: str, dim: DataFrame, dim_id: str,
                          dim_name: str) -> tuple[DataFrame, DataFrame]:
    """Resolve names to dimension ids, creating members for new names. Returns (facts with
    `dim_id`, extended dimension). New ids continue from the largest, in name order."""
    from tablespan.operators.ordinals import running_total

    names = facts.select(F.col(name_col).alias(dim_name)).where(F.col(dim_name).isNotNull()).distinct()
    new = written_table(names.join(dim.select(dim_name), dim_name, "left_anti"), "new-names")
    top = dim.agg(F.coalesce(F.max(dim_id), F.lit(0)).cast("long")).scalar()
    created = (running_total(new, [], [dim_name], "_n")
               .select((F.col("_n") + top).alias(dim_id), dim_name))
    extended = dim.select(F.col(dim_id).cast("long").alias(dim_id), dim_name).unionByName(created)
    resolved = facts.join(
        extended.select(F.col(dim_id), F.col(dim_name).alias("_name")),
        F.col(name_col) == F.col("_name"), "left").drop("_name")
    return resolved, extended


# ---------------------------------------------------------------- aggregates and top-k


def top_rows(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows of an order (k is small: each task keeps k rows). Sorting happens before
    the cut; the last order column should be a key so that ties are settled."""
    return df.orderBy(*order).limit(k)


def rows_in_top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose `key` is among the k most frequent ones (smaller key first on a tie)."""
    best = (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(key)).limit(k).select(F.col(key).alias("_best")))
    return df.join(best, F.col(key) == F.col("_best"), "left_semi")


def text_bars(df: DataFrame, key: str, rows_per_mark: int = 1) -> DataFrame:
    """A bar of `+` per group, one mark for each begun `rows_per_mark` rows; `n` is the exact count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return (counts.withColumn("rows_per_mark", F.lit(rows_per_mark).cast("long"))
            .withColumn("bar", F.expr("repeat('+', int(ceil(n / rows_per_mark)))"))
            .orderBy(F.desc("n"), F.asc(key)))
