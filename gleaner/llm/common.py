"""What the operators share: reading tables, writing intermediate tables to the shared folder, row keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import shared_dir

#: Words of letters and digits: everything that is not ASCII punctuation, blank or control.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


Batches = Iterator[pa.RecordBatch]
T = TypeVar("T")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, unless it was submitted as an archive already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    if not os.path.isdir(root) or any(os.path.basename(f) == "gleaner-package.zip" for f in sc.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="gleaner-package-"), "gleaner-package.zip")  # the driver serves it from there
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("gleaner", os.path.relpath(full, root)))
    sc.addPyFile(path)


#: What this worker process keeps from task to task, by its key.
_KEPT: dict[str, object] = {}


def kept(key: str, make: Callable[[], T]) -> T:
    """What ``make`` gave in this worker process. It stays over all tasks that keep ``key``; the first other task lets go of it."""
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def let_go(but: str | None = None) -> None:
    """Drop all that earlier tasks kept, except what goes by the key ``but``."""
    for key in [k for k in _KEPT if k != but]:
        del _KEPT[key]


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` with the package at hand on every executor.

    Workers are used again and wait without the memory of their last task's batches. A task starts without what tasks of
    other calls kept; ``keeps`` is the key of what the tasks of this one share.
    """
    ship(df.sparkSession)

    def released(batches: Batches) -> Batches:
        let_go(keeps)
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The folder is deleted when the driver's session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/gleaner-{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def text_key(col: str = "text") -> Column:
    """A 128-bit key of a text, the same for null and empty: decisions that depend on the text alone join by it."""
    return F.md5(as_text(col))


def as_text(col: str) -> Column:
    """The column, with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
