"""Session settings shared by tests, the bench and stand-alone use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    # plan re-optimisation at run time: partition coalescing, skewed-join splitting, broadcast switch
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # all timestamps are read and printed as UTC
    "spark.sql.session.timeZone": "UTC",
    # stream state on local disk with copies in the checkpoint folder, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tablespan", **extra: str) -> SparkSession:
    """A session with the settings above. On a cluster leave `master` and `shuffle_partitions`
    unset: spark-submit gives the first, and about 128 MB of shuffle data per partition the second."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _package_file() -> str:
    """The package as a zip file in the driver's temporary folder."""
    root = Path(__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="tablespan-")) / "tablespan.zip"
    with zipfile.ZipFile(file, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    atexit.register(shutil.rmtree, file.parent, ignore_errors=True)
    return str(file)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the session's Python workers, which may start in another folder or on another
    machine, as `spark-submit --py-files` would."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_package_file())
        _shipped.add(application)
