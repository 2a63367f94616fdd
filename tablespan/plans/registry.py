"""Registered queries: a Spark job over the given tables and, where possible, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablespan.sources.tables import read_table

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes. A schema is looked up in the files once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schemas = {}

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, self.folder, name, self.schemas.get(name))
        self.schemas[name] = table.schema
        return table


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        JOBS[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
