"""Audits of declared constraints, and validation with error codes.

An audit returns the violations; `validated` adds the code of the first failed rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablespan.sources.contracts import Contract


def duplicate_keys(df: DataFrame, keys: list[str], skip_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with their number. For a unique column NULLs are
    exempt; for a primary key a missing part is reported by `missing_values`."""
    rows = df.dropna(subset=keys) if skip_nulls else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unresolved(df: DataFrame, column: str | list[str], parent: DataFrame, parent_key: str | list[str]) -> DataFrame:
    """Rows whose reference, of one or several columns, finds no parent. References with a NULL are
    exempt."""
    columns, keys = ([x] if isinstance(x, str) else list(x) for x in (column, parent_key))
    found = parent.select([F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_key{i}") for i, c in enumerate(columns)])
    return df.dropna(subset=columns).join(found, same, "left_anti")


def length_violations(df: DataFrame, key: str, limits: dict[str, tuple[int, int | None]]) -> DataFrame:
    """One row per text outside its (minimum, maximum) length, in one pass over the table."""
    found = []
    for name, (low, high) in limits.items():
        n = F.length(name)
        bad = (n < low) if high is None else (n < low) | (n > high)
        found.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), n.cast("long").alias("length"))))
    return (df.select(key, F.explode(F.array_compact(F.array(*found))).alias("_v"))
            .select(key, "_v.column_name", "_v.length"))


def contract_limits(contract: Contract) -> dict[str, tuple[int, int | None]]:
    return {c.name: (0, c.metadata["max_len"]) for c in contract.columns
            if "max_len" in c.metadata and c.dataType.typeName() == "string"}


def outside_domain(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows with a value that is not allowed; NULL passes."""
    return df.where(~F.col(column).isin(values))


def failing(df: DataFrame, check: Column) -> DataFrame:
    """Rows whose check is false; NULL passes."""
    return df.where(~check)


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, missing) for all columns from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "missing")


def existing_or_repeated(incoming: DataFrame, key: str, row_id: str, stored: DataFrame,
                         stored_key: str) -> DataFrame:
    """Incoming rows whose key is already stored (`reason` = existing) or was taken by an earlier
    row of the batch (`reason` = repeated). The first row of a key is found by a reduced minimum
    rather than by ordering each key's rows, so a very frequent key is no bottleneck."""
    first = incoming.groupBy(F.col(key).alias("_key")).agg(F.min(row_id).alias("_first"))
    known = stored.select(F.col(stored_key).alias("_known")).distinct()
    marked = (first.join(known, F.col("_key") == F.col("_known"), "left")
              .select("_key", "_first", F.col("_known").isNotNull().alias("_stored")))
    reason = (F.when(F.col("_stored"), F.lit("existing"))
              .when(F.col(row_id) > F.col("_first"), F.lit("repeated")))
    return (incoming.join(marked, F.col(key) == F.col("_key"), "left")
            .withColumn("reason", reason).where(F.col("reason").isNotNull())
            .drop("_key", "_first", "_stored"))


def flag_resolved(df: DataFrame, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Add whether the reference finds a parent, for use inside a rule."""
    keys = parent.select(F.col(parent_key).alias("_key")).distinct()
    return (df.join(keys, F.col(column) == F.col("_key"), "left")
            .withColumn(name, F.col("_key").isNotNull()).drop("_key"))


Rule = tuple[int, Column]  # (error code, check that must not be false)


def validated(df: DataFrame, rules: list[Rule], code: str = "code") -> DataFrame:
    """Add the code of the first failed rule, NULL for a good row."""
    return df.withColumn(code, F.coalesce(*[F.when(~check, F.lit(number)) for number, check in rules]))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    marked = validated(df, rules)
    return marked.where(F.col("code").isNull()).drop("code"), marked.where(F.col("code").isNotNull())


def reject_report(marked: DataFrame, texts: dict[int, str] | None = None) -> DataFrame:
    """Rejected rows per code, with the text of the code where one is given."""
    report = marked.where(F.col("code").isNotNull()).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    if texts:
        text = reduce(lambda c, item: c.when(F.col("code") == item[0], F.lit(item[1])),
                      list(texts.items())[1:], F.when(F.col("code") == list(texts)[0], F.lit(list(texts.values())[0])))
        report = report.withColumn("message", text)
    return report


def audit_contract(tables: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """(table_name, rule, violations) for the key, unique columns, references, required columns,
    domains and lengths of one table. Rules that need no grouping share a single pass."""
    df = tables[contract.name]
    reports = []

    def add(rule: str, violations: DataFrame) -> None:
        reports.append(violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(contract.name).alias("table_name"), F.lit(rule).alias("rule"), "violations"))

    if contract.key:
        add("key " + ",".join(contract.key), duplicate_keys(df, list(contract.key)))
    for name in contract.unique:
        add(f"unique {name}", duplicate_keys(df, [name], skip_nulls=True))
    for r in contract.references:
        if r.table in tables:
            add("reference " + ",".join(r.columns), unresolved(df, list(r.columns), tables[r.table], list(r.keys)))
    row_rules = {f"required {c.name}": F.col(c.name).isNull() for c in contract.columns if not c.nullable}
    row_rules |= {f"domain {c}": ~F.col(c).isin(v) for c, v in contract.domains.items()}
    row_rules |= {f"length {c}": F.length(c) > high for c, (_, high) in contract_limits(contract).items()}
    if row_rules:
        counts = df.agg(*[F.count_if(bad).alias(rule) for rule, bad in row_rules.items()])
        reports.append(counts.unpivot([], list(row_rules), "rule", "violations").select(
            F.lit(contract.name).alias("table_name"), "rule", "violations"))
    if not reports:
        return df.sparkSession.createDataFrame([], "table_name string, rule string, violations long")
    return reduce(DataFrame.unionByName, reports)
