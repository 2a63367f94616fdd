"""Small column and Arrow helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.scratch import new_path, note_written, written_alone, written_table

#: Bytes of text worked on at a time inside a task. Only whole texts are worked on, so one long text may exceed it.
BLOCK_BYTES = 1 << 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is computed once per row however often `body` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about BLOCK_BYTES, so that arrays over the bytes of a slice stay small."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            n = min(batch.num_rows - start, 4096)
            while n > 1 and batch.slice(start, n).nbytes > BLOCK_BYTES:
                n //= 2
            yield batch.slice(start, n)
            start += n


#: Size of a bit table whose values are not counted: 8 MB. A larger one has 8 bits or more a value, 128 MB at most.
BITS = 1 << 26
MOST_BITS = 1 << 30
#: Words of a bit table that come to the driver at once.
SLICE = 1 << 22


def bits_for(values: int) -> int:
    """The bits of a table for so many values."""
    return min(MOST_BITS, max(BITS, 1 << (8 * values - 1).bit_length()))


def bit_table(hashes: DataFrame, bits: int | None = None) -> np.ndarray:
    """A table of BITS bits, or so many (a power of two), as 64-bit words, with the bit of every value of the only column
    (long) set. It tells which rows cannot match; the more values, the fewer it spares."""
    bits, value = bits or BITS, F.col(hashes.columns[0])
    words = hashes.select(F.shiftright(value.bitwiseAND(F.lit(bits - 1)), 6).alias("word"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    table = np.zeros(bits >> 6, np.uint64)
    for start in range(0, len(table), SLICE):
        some = words if len(table) <= SLICE else words.filter(F.col("word").between(start, start + SLICE - 1))
        found = some.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        table[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return table


def has_bit(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes.astype(np.uint64) & np.uint64(64 * len(table) - 1))
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def may_be_in(table: np.ndarray, hashes: Column, spark: SparkSession) -> Column:
    """Whether the bit of a row's hash (long) is set in the table."""
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(has_bit(shared.value, values.to_numpy(np.int64)))

    return test(hashes)


def free_finished(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more. It does so when the driver collects
    its garbage, which a large heap may put off for half an hour; an operator of many steps would pile them up. Spark
    itself refers to its last job, so a job of one row takes that place first."""
    spark.range(1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """`df` written once in the shared folder and read back; what earlier steps shuffled is dropped."""
    free_finished(df.sparkSession)
    return written_table(df, label)


def stage_alone(spark: SparkSession, steps: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `steps` returns as a staged table, and of all the tables staged on the way to it none."""
    def last() -> DataFrame:
        df = steps()
        free_finished(spark)
        return df

    return written_alone(spark, last, label)


def bucketed_table(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """`df` written once in the shared folder, in as many buckets by `keys` as the session has shuffle partitions:
    grouping by the keys needs no shuffle afterwards, and a join by them shuffles the other side only."""
    spark = df.sparkSession
    free_finished(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, label)
    name = f"{label}_{path.rsplit('-', 1)[-1]}"
    note_written(path, name)
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    return spark.table(name)
