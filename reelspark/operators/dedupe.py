"""First row and first n rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows of each key in the given order, with their rank.

    Spark applies the ``row_number <= n`` filter on both sides of the shuffle (WindowGroupLimit), so each map
    task forwards at most n rows of a key and a hot key never travels whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in the given order, ties settled by all other columns."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return top_n_per_group(df, keys, [*(order or []), *rest], 1, "_first").drop("_first")
