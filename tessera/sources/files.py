"""Folder listings, deletions and renames through Spark's own file systems."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _filesystem(spark: SparkSession, pattern: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob pattern, in order; none is no error."""
    path, fs = _filesystem(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(path) or []))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _filesystem(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give ``source`` the name ``target`` unless that exists; whether it was given.

    The file system decides who comes first where its rename does (HDFS); a
    caller on another one checks afterwards whose content is there.
    """
    src, fs = _filesystem(spark, source)
    dst, _ = _filesystem(spark, target)
    src, dst = fs.makeQualified(src), fs.makeQualified(dst)
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(src.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(src, dst, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def replace_folders(spark: SparkSession, pattern: str, write: Callable[[], None]) -> list[str]:
    """Run ``write``, which writes folders that match ``pattern``, and delete
    those of an earlier attempt that it did not write; returns its folders.

    The earlier attempt stays whole until the new one is committed.
    """
    before = set(paths(spark, f"{pattern}/*"))
    write()
    after = paths(spark, f"{pattern}/*")
    fresh = {p.rsplit("/", 1)[0] for p in after if p not in before}
    for folder in {p.rsplit("/", 1)[0] for p in after} - fresh:
        delete(spark, folder)
    return sorted(fresh)
