"""Tables that change together, file by file.

A version of a table set is a manifest: the Parquet files of every table. A change stages new files, writes the manifest of
the next version, and publishes it by creating the one small file that bears its number. Until then readers see the old
version of every table; a change that fails leaves nothing they could see. So several tables can be reloaded as a group, and
a small change to a large table rewrites only the files that hold changed rows, while all others are carried over by name.

The files to rewrite are found by scanning the key or condition columns alone. A version remembers the last batch of each
stream that was published into it, so a batch that a restarted stream repeats changes nothing.

Creating a file that must not exist is exclusive on file systems that offer it (HDFS and most shared ones; object stores
with conditional writes); a local disk checks first and creates then, which is enough for one publisher. Two changes made
from the same version do not both succeed: the second raises `Conflict` and may be made again. A publisher that dies
between creating the version's file and filling it leaves an empty one, which `release` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablespan.operators.changes import merge_rows, update_where
from tablespan.operators.quality import duplicate_keys, unresolved
from tablespan.operators.relational import checked_predicate
from tablespan.sources.contracts import Contract, aligned, load_order


class Conflict(RuntimeError):
    """Another change was published since this one read its version."""


class Refused(ValueError):
    """A load whose rows break a rule; nothing was published."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    manifest: str | None = None
    batches: dict[str, int] = field(default_factory=dict)   # the last batch of each stream


MANIFEST = "table_name string, path string"


class TableSet:
    """The tables below `folder`, which all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    # ------------------------------------------------------------ versions

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _content(self, number: int) -> str:
        path, files = self._path(f"versions/{number}")
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def version(self, number: int | None = None) -> Version:
        """The newest published version, or the one of that number; version 0 has no tables."""
        path, files = self._path("versions")
        if not files.exists(path):
            return Version()
        known = sorted((int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit()), reverse=True)
        for n in known if number is None else [n for n in known if n == number]:
            content = self._content(n)
            if content:                 # else it is being published this moment
                return Version(n, **json.loads(content))
        if number:
            raise LookupError(f"no version {number}")
        return Version()

    def release(self) -> None:
        """Remove the number that a publisher took and died before using."""
        number = self.version().number + 1
        path, files = self._path(f"versions/{number}")
        if files.exists(path) and not self._content(number):
            files.delete(path, False)

    def files(self, table: str, version: Version | None = None) -> list[str]:
        """The paths of a table's files, below the folder. There are as many as Spark itself lists to read the table."""
        version = version or self.version()
        if version.manifest is None:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/{version.manifest}").where(F.col("table_name") == table)
        return [r.path for r in rows.select("path").collect()]

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        paths = self.files(table, version)
        if not paths:
            raise LookupError(f"no table {table}")
        return self._at(paths)

    def _at(self, paths: Iterable[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{p}" for p in paths])

    def _staged(self, rows: DataFrame) -> list[str]:
        """Write rows to new files. Their names hold the write's own id, so no two files of a set share one."""
        place = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{place}")
        return [f"{place}/{p.rsplit('/', 1)[-1]}" for p in self.spark.read.parquet(f"{self.folder}/{place}").inputFiles()]

    def _publish(self, base: Version, changed: dict[str, list[str]], batch: tuple[str, int] | None) -> Version:
        """The version after `base`, in which the changed tables have the given files."""
        rows = self.spark.createDataFrame([(t, p) for t, paths in changed.items() for p in paths], MANIFEST)
        if base.manifest is not None:
            kept = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/{base.manifest}")
            rows = rows.unionByName(kept.where(~F.col("table_name").isin(*changed)))
        manifest = f"manifests/{uuid.uuid4().hex}"
        rows.repartition(1).write.parquet(f"{self.folder}/{manifest}")
        batches = {**base.batches, **({batch[0]: batch[1]} if batch else {})}
        path, files = self._path(f"versions/{base.number + 1}")
        try:
            stream = files.create(path, False)
        except Py4JJavaError as error:
            if not files.exists(path):
                raise
            raise Conflict(f"version {base.number + 1} was published by another change") from error
        stream.writeBytes(json.dumps({"manifest": manifest, "batches": batches}))
        stream.close()
        return Version(base.number + 1, manifest, batches)

    @staticmethod
    def _seen(base: Version, batch: tuple[str, int] | None) -> bool:
        return batch is not None and base.batches.get(batch[0], -1) >= batch[1]

    def published(self, batch: tuple[str, int]) -> bool:
        """Whether a batch (stream, number) is part of the newest version."""
        return self._seen(self.version(), batch)

    # ------------------------------------------------------------ whole tables

    def replace(self, frames: dict[str, DataFrame], batch: tuple[str, int] | None = None) -> Version:
        """New contents for some tables, published together."""
        base = self.version()
        if self._seen(base, batch):
            return base
        return self._publish(base, {name: self._staged(rows) for name, rows in frames.items()}, batch)

    def append(self, frames: dict[str, DataFrame], batch: tuple[str, int] | None = None) -> Version:
        """More rows for some tables, published together; present files stay, and a table that is not there is made."""
        base = self.version()
        if self._seen(base, batch):
            return base
        return self._publish(base, {name: self.files(name, base) + self._staged(rows) for name, rows in frames.items()}, batch)

    def reload(self, frames: dict[str, DataFrame], contracts: Iterable[Contract], batch: tuple[str, int] | None = None) -> Version:
        """Replace related tables as a group, parents before children. Each is brought to its contract, staged, and checked:
        a repeated key, or a reference that the staged parent (or, if that is not reloaded, the present one) does not have,
        refuses the whole group."""
        base = self.version()
        if self._seen(base, batch):
            return base
        by_name = {c.name: c for c in contracts}
        if not set(frames) <= set(by_name):
            raise Refused(f"no contract for {sorted(set(frames) - set(by_name))}")
        staged: dict[str, list[str]] = {}
        for name in load_order(by_name.values()):
            if name not in frames:
                continue
            contract = by_name[name]
            staged[name] = self._staged(aligned(frames[name], contract))
            rows = self._at(staged[name])
            if contract.key and not duplicate_keys(rows, list(contract.key)).isEmpty():
                raise Refused(f"{name}: repeated key")
            for reference in contract.references:
                parents = staged.get(reference.table) or self.files(reference.table, base)
                if not parents:
                    raise Refused(f"{name}: no table {reference.table}")
                if not unresolved(rows, list(reference.columns), self._at(parents), list(reference.keys)).isEmpty():
                    raise Refused(f"{name}: rows without {reference.table}")
        return self._publish(base, staged, batch)

    # ------------------------------------------------------------ rows

    def _rewrite(self, table: str, batch: tuple[str, int] | None, hit: Callable[[DataFrame], DataFrame],
                 change: Callable[[DataFrame], DataFrame]) -> Version:
        """Rewrite the files of the rows that `hit` selects by `change`, and carry the others over."""
        base = self.version()
        if self._seen(base, batch):
            return base
        paths = self.files(table, base)
        rows = self._at(paths).withColumn("_file", F.col("_metadata.file_name"))
        touched = {r["_file"] for r in hit(rows).select("_file").distinct().collect()}
        old = [p for p in paths if p.rsplit("/", 1)[-1] in touched]
        new = change(self._at(old) if old else self._at(paths[:1]).limit(0))
        return self._publish(base, {table: [p for p in paths if p not in set(old)] + self._staged(new)}, batch)

    def merge(self, table: str, source: DataFrame, key: str, source_key: str, update: dict[str, Column], insert: dict[str, Column],
              batch: tuple[str, int] | None = None) -> Version:
        """`merge_rows` into a large table. Files are found by reading the key column alone; all matches lie in those files,
        so a source row that finds none there is new."""
        keys = source.select(F.col(source_key).alias("_wanted")).where("_wanted is not null").distinct()
        return self._rewrite(table, batch, lambda rows: rows.select(key, "_file").join(keys, F.col(key) == F.col("_wanted"), "left_semi"),
                             lambda rows: merge_rows(rows, source, key, source_key, update, insert))

    def update(self, table: str, condition: Column, values: dict[str, Column], batch: tuple[str, int] | None = None) -> Version:
        """Set columns where the condition is true."""
        return self._rewrite(table, batch, lambda rows: rows.where(condition), lambda rows: update_where(rows, condition, values))

    def delete(self, table: str, text: str, batch: tuple[str, int] | None = None) -> Version:
        """Delete by a predicate given as text; rows where it is NULL stay."""
        hit = lambda rows: F.coalesce(checked_predicate(rows, text, [c for c in rows.columns if c != "_file"]), F.lit(False))
        return self._rewrite(table, batch, lambda rows: rows.where(hit(rows)), lambda rows: rows.where(~hit(rows)))

    def compact(self, table: str, order: list[str], files: int) -> Version:
        """The same rows in `files` files by ranges of `order`, so that changes to near keys touch few of them."""
        base = self.version()
        return self._publish(base, {table: self._staged(self.read(table, base).repartitionByRange(files, *order))}, None)
