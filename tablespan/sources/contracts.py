"""Table contracts: declared columns with length, default, key and reference rules.

Parquet files enforce none of these, so the rules drive audit and change jobs instead."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "text": T.StringType(),
    "ts": T.TimestampType(), "ntz": T.TimestampNTZType(), "date": T.DateType(),
    "double": T.DoubleType(), "binary": T.BinaryType(),
    "texts": T.ArrayType(T.StringType()), "decimal(10,1)": T.DecimalType(10, 1),
}


def column(name: str, kind: str, max_len: int | None = None, nullable: bool = False,
           default=None) -> T.StructField:
    notes = {}
    if max_len is not None:
        notes["max_len"] = max_len
    if default is not None:
        notes["default"] = default
    return T.StructField(name, TYPES[kind], nullable, notes)


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: list[T.StructField]
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    domains: dict[str, list] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(self.columns)

    def load_schema(self) -> T.StructType:
        """The same columns, all nullable: rows are checked by audits, not by the reader."""
        return T.StructType([T.StructField(c.name, c.dataType, True, c.metadata) for c in self.columns])

    def max_len(self, name: str) -> int | None:
        return self.schema[name].metadata.get("max_len")

    def default(self, name: str):
        return self.schema[name].metadata.get("default")


def refers(columns: str, table: str, keys: str) -> Reference:
    return Reference(tuple(columns.split()), table, tuple(keys.split()))


def load_order(contracts: Iterable[Contract]) -> list[str]:
    """Parents before children; a table that refers to itself comes once."""
    sorter = TopologicalSorter()
    for c in contracts:
        sorter.add(c.name, *sorted({r.table for r in c.references} - {c.name}))
    return list(sorter.static_order())


def rows_frame(spark: SparkSession, contract: Contract, rows: list[dict]) -> DataFrame:
    """Literal rows; omitted columns take the declared default, else NULL."""
    full = [tuple(row[c.name] if c.name in row else contract.default(c.name)
                  for c in contract.columns) for row in rows]
    return spark.createDataFrame(full, contract.load_schema())


def aligned(df: DataFrame, contract: Contract) -> DataFrame:
    """Bring rows to the declared columns and types. An absent column takes its default; a NULL
    that was supplied stays NULL."""
    return df.select([
        (F.col(c.name) if c.name in df.columns else F.lit(contract.default(c.name)))
        .cast(c.dataType).alias(c.name) for c in contract.columns])
