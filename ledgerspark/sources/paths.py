"""File-system questions, asked of the file system that holds the path."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no such folder."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def require(spark: SparkSession, path: str, label: str) -> None:
    if not exists(spark, path):
        raise FileNotFoundError(f"There is no {label} at {path}")


def publish(spark: SparkSession, folder: str, target: str) -> bool:
    """Give a finished folder its final name in one step; false if the name is taken.

    Renaming a folder is atomic on HDFS-like file systems; on stores without it the files
    are copied one by one.
    """
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop
    old, new = hadoop.fs.Path(folder), hadoop.fs.Path(target)
    context = hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(old, new, how)
    except Py4JJavaError as e:
        if exists(spark, target) and exists(spark, folder):
            return False
        raise e
    return True
