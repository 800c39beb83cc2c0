"""Session helpers: a builder with the settings the library is tuned for, and the shared
folder every intermediate table or checkpoint goes to."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "archivetables", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()
_noted = threading.local()  # lists of scratch folders, of the open blocks of each thread


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, where it is not installed there."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).parent
        name = Path(tempfile.mkdtemp(prefix="archivetables-")) / package.name
        packed = shutil.make_archive(str(name), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(packed)  # Spark carries it from the driver to all tasks
        _shipped.add(application)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, gets a temporary
    folder when none is named; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="archivetables-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in getattr(_noted, "lists", ()):
        made.append(path)
    return path


@contextmanager
def scratch_folders() -> Iterator[list[str]]:
    """The list of the scratch folders that this thread names within the block."""
    lists = _noted.__dict__.setdefault("lists", [])
    made: list[str] = []
    lists.append(made)
    try:
        yield made
    finally:
        lists[:] = [other for other in lists if other is not made]


def delete_scratch(spark: SparkSession, folders: list[str]) -> None:
    """Delete these scratch folders, of which nothing is read any more; missing ones don't matter."""
    conf = spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, whatever follows."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession, n_bytes: int = 0, bytes_per_task: int = 1 << 30) -> int:
    """Partitions for stages whose input rows are tiny but whose work, ``n_bytes``, is not.

    Such shuffles name their partition number, since adaptive execution would otherwise
    judge them by the few bytes of the rows and merge them into one task.
    """
    usual = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
    return max(usual, -(-n_bytes // bytes_per_task))
