"""Sinks: Parquet tables, chunked NDJSON, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    sort_by: list[str] | None = None,
) -> None:
    """Full refresh (or append) of a Parquet table.

    ``sort_by`` range-partitions and sorts the rows, so that the min/max statistics of the files let a reader skip
    most of them when it looks for a key or a key range.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_days(df: DataFrame, path: str, day: str) -> None:
    """Write a table that is partitioned by day: the days that df holds are replaced, all others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.partitionBy(day).parquet(path)


def write_ndjson_chunks(df: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """NDJSON files of at most ``records_per_file`` records; every task writes its own files."""
    df.write.mode("overwrite").option("maxRecordsPerFile", records_per_file).json(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, mode: str = "overwrite"
) -> None:
    """Load a database table. ``truncate`` empties it in place, so its keys and indexes survive a refresh."""
    options = {"truncate": "true", "batchsize": "10000", **(properties or {})}
    df.write.jdbc(url, table, mode=mode, properties=options)
