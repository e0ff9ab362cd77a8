"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_sparse(left: DataFrame, right: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Left join on a key that is NULL for many left rows.

    A NULL key matches nothing, yet a plain left join sends all those rows to one shuffle partition. Here each
    such row gets its own stand-in key, drawn from ``spread_by``, that no right row can have.
    """
    stand_in = F.concat(F.lit("\u0000"), F.xxhash64(*spread_by).cast("string"))
    keyed = left.withColumn("_join_key", F.coalesce(F.col(key).cast("string"), stand_in))
    lookup = right.where(F.col(key).isNotNull()).withColumn("_join_key", F.col(key).cast("string")).drop(key)
    return keyed.join(lookup, "_join_key", "left").drop("_join_key")


def prefixed(df: DataFrame, columns: list[str], prefix: str = "r_") -> DataFrame:
    """Rename the given columns, so that both sides of a self join keep distinct names."""
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def same_key(columns: list[str], prefix: str = "r_"):
    """Null-safe equality of columns with their prefixed counterparts."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
