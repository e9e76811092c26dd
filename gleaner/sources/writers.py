"""Result tables out: JSON rows, JSON lines, a store snapshot, remembered keys."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """JSON rows, one folder for each partition value."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line; null fields are kept so every line has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A whole new snapshot; never the path being read. Readers switch paths once it is complete."""
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_state(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
