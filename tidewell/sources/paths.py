"""File system calls on whatever storage a path belongs to."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _resolve(spark, path)
    return fs.exists(hadoop)


def move_new(spark: SparkSession, folder: str, target: str) -> bool:
    """Move the one data file in ``folder`` to ``target``; False if there is one already.

    The storage decides, so of several callers one succeeds.
    """
    jvm, java = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, to = _resolve(spark, target)
    fs.mkdirs(to.getParent())
    [found] = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    options = java.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(found.getPath(), fs.makeQualified(to), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder in ascending order; none if there is no such folder."""
    fs, hadoop = _resolve(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _resolve(spark, path)
    fs.delete(hadoop, True)
