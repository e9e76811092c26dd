"""Folders written batch by batch, ``at=<batch>`` below a root: which writes are whole, and removing old ones."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def finished(spark: SparkSession, root: str) -> dict[int, set[str]]:
    """Names in the folder of each write that ended, by batch; one without ``_SUCCESS`` does not count."""
    where, fs = _hadoop(spark, f"{root}/at=*/*")
    found: dict[int, set[str]] = {}
    for status in fs.globStatus(where) or []:
        path = status.getPath()
        found.setdefault(int(path.getParent().getName()[3:]), set()).add(path.getName())
    return {at: names for at, names in found.items() if "_SUCCESS" in names}


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        where, fs = _hadoop(spark, path)
        fs.delete(where, True)
