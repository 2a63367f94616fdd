"""Reading and writing tables: Parquet scans, append, ordered reload, views, text reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablespan.sources.contracts import Contract, aligned, load_order


def read_table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def append_rows(df: DataFrame, contract: Contract, folder: str) -> None:
    aligned(df, contract).write.mode("append").parquet(f"{folder}/{contract.name}.parquet")


def reload_tables(frames: dict[str, DataFrame], contracts: Iterable[Contract], folder: str) -> list[str]:
    """Replace related tables as a whole, parents before children. Returns the order used."""
    by_name = {c.name: c for c in contracts}
    order = [name for name in load_order(by_name.values()) if name in frames]
    for name in order:
        aligned(frames[name], by_name[name]).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return order


def named_view(df: DataFrame, view: str, columns: list[str]) -> DataFrame:
    """Register a query under a name with its own column names, and return it."""
    renamed = df.toDF(*columns)
    renamed.createOrReplaceTempView(view)
    return df.sparkSession.table(view)


def write_report(df: DataFrame, line: Column, path: str) -> DataFrame:
    """One text line per row, written in parallel; returns the lines read back."""
    df.select(line.alias("line")).write.text(path)
    return df.sparkSession.read.text(path).withColumnRenamed("value", "line")
