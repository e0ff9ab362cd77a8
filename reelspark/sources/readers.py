"""Scans of raw files and of the lake's Parquet tables."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Comma-separated text with a header. A quote mark inside quotes is doubled (RFC 4180)."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_tsv(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Tab-separated text with ``\\N`` for NULL. Quoting is off: a title may start with an unclosed quote mark."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", "\t")
        .option("nullValue", "\\N")
        .option("quote", "")
        .csv(path)
    )


def read_ndjson(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved HTML files as (url, html), one row per file; the file path stands for the address."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def read_day(spark: SparkSession, path: str, day: str, date: str | None = None) -> DataFrame:
    """Rows of one day of a table that is partitioned by day: the given one, else the newest.

    The newest day is a subquery that Spark runs before it lists what to read, so other days' files are pruned."""
    df = spark.read.parquet(path)
    if date is not None:
        return df.where(F.col(day) == F.lit(date).cast(df.schema[day].dataType))
    return df.where(F.col(day) == spark.read.parquet(path).agg(F.max(day)).scalar())


def input_folder(spark: SparkSession, base: str, date: str | None = None) -> str:
    """Folder of one delivery: the given date, else the newest child folder by name that holds files, ``_*`` left aside.

    Paths of files come from Spark's own listing, so object stores work; no file is opened.
    """
    if date:
        return f"{base.rstrip('/')}/{date}"
    plain = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", base).rstrip("/")
    inside = F.substring_index("path", f"{plain}/", -1)
    try:
        files = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/*/*").select(F.substring_index(inside, "/", 1).alias("name"))
        newest = files.where(~F.col("name").startswith("_")).agg(F.max("name")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        raise FileNotFoundError(f"no delivery folder under {base}")
    return f"{base.rstrip('/')}/{newest}"


def read_present(spark: SparkSession, paths: Iterable[str]) -> dict[str, DataFrame]:
    """Those of the Parquet tables that exist. A missing path is skipped; any other failure is raised."""
    found = {}
    for path in paths:
        try:
            found[path] = spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        raise FileNotFoundError("none of the sources is present")
    return found


def run_date(date: str | datetime.date | None) -> Column:
    """Audit date as a column: fixed when given, else today."""
    return F.current_date() if date is None else F.lit(str(date)).cast("date")


def calendar(spark: SparkSession, start: str = "1950-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day, column ``date``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
    )
