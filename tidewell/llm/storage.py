"""Tables written once to the folder all executors share, and code sent to them."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
#: Paths of the tables stored inside ``dropped_after``; queries of other threads have their own.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where none is set and one machine does all."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidewell-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back.

    The lineage ends here: a lost executor costs no more than the tasks it ran, and values
    that depend on how rows were dealt out stay as they were written.
    """
    path = new_path(df.sparkSession, name)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def dropped_after(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were stored inside, but for the last one."""
    written: list[str] = []
    outer = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(outer)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in written[:-1]:
        at = files.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def some_rows(df: DataFrame, n: int, *key: str | Column) -> DataFrame:
    """At most ``n`` rows, those whose ``key`` has the least hashes; all rows where there are fewer.

    Rows whose hash cannot be among the least are left out before the sort, so that tasks
    pass on about ``n`` rows together and not ``n`` each.
    """
    total = df.count()
    pick = F.pmod(F.xxhash64(*key), F.lit(2**31))
    if total > 4 * n:
        df = df.where(pick < F.lit(2**31 * 2 * n // total))
    return df.orderBy(pick, *key).limit(n)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tidewell-code-")
    copy = os.path.join(folder, "code", os.path.basename(package))
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(
        os.path.join(folder, "tidewell"), "zip", os.path.join(folder, "code")
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
