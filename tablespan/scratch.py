"""Intermediate tables and stream state live in the folder the cluster shares between executors.

The folder is the session's `spark.checkpoint.dir`. Only a session on one machine (master `local`)
may leave it unset: a temporary folder is made then, and removed when the process ends. Elsewhere
that is an error, for executors would write to disks that the others cannot read. `drop_written`
removes everything this library has written below the folder; `written_alone` removes what was written on the way to a
table as soon as that one is written. Nothing here depends on one executor
staying alive: a written table is read back from shared storage whatever happens to the tasks that
wrote it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Paths, and the catalog's names for some, of the tables written inside the innermost `written_alone`.
_on_the_way: ContextVar[dict[str, str | None] | None] = ContextVar("on_the_way", default=None)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tablespan-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder and not on_one_machine(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return (folder or _own_folder()).rstrip("/")


def on_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_folder(spark)}/tablespan/{label}-{uuid.uuid4().hex}"


def drop_written(spark: SparkSession) -> None:
    """Remove all tables and stream state that this library has written below the shared folder.
    DataFrames that read them cannot be used afterwards."""
    _remove(spark, f"{shared_folder(spark)}/tablespan")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def note_written(path: str, name: str | None = None) -> None:
    """A table was written that lasts no longer than the `written_alone` around it, if there is one."""
    noted = _on_the_way.get()
    if noted is not None:
        noted[path] = name


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back: cuts the lineage, and gives the planner true sizes, so
    that a small table is broadcast and a large one is not."""
    path = new_path(df.sparkSession, label)
    note_written(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _noting() -> Iterator[dict[str, str | None]]:
    noted: dict[str, str | None] = {}
    outer = _on_the_way.set(noted)
    try:
        yield noted
    finally:
        _on_the_way.reset(outer)


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """The tables written inside are removed at the end, so nothing that reads them may be used afterwards."""
    with _noting() as noted:
        yield
    _remove_noted(spark, noted)


def written_alone(spark: SparkSession, steps: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `steps` returns, written and read back as by `written_table`. The tables that `steps` wrote are removed then,
    so nothing else that reads them may leave `steps`."""
    with _noting() as noted:
        df = steps()
    table = written_table(df, label)
    _remove_noted(spark, noted)
    return table


def _remove_noted(spark: SparkSession, noted: dict[str, str | None]) -> None:
    for path, name in noted.items():
        if name:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        _remove(spark, path)


def table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at `path`, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
