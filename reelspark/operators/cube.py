"""Slice, dice, drill-down and roll-up over a star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def olap_slice(df: DataFrame, dimension: str, value) -> DataFrame:
    """Fix one dimension to one value."""
    return df.where(F.col(dimension) == value)


def olap_dice(df: DataFrame, conditions: dict[str, tuple | list]) -> DataFrame:
    """Keep a sub-cube: a list names allowed values, a (low, high) tuple an inclusive range."""
    for dimension, allowed in conditions.items():
        c = F.col(dimension)
        df = df.where(c.between(*allowed) if isinstance(allowed, tuple) else c.isin(allowed))
    return df


def cube_query(df: DataFrame, dims: list[str], measures: dict[str, Column], filters: Column | None = None) -> DataFrame:
    """Measures at one level of detail; adding a dimension drills down, leaving one out rolls up."""
    kept = df if filters is None else df.where(filters)
    return kept.groupBy(*dims).agg(*[c.alias(name) for name, c in measures.items()])


def rollup_query(df: DataFrame, hierarchy: list[str], measures: dict[str, Column]) -> DataFrame:
    """Measures at every level of a hierarchy (for example year, month, day) at once; ``level`` counts the
    dimensions in use, so 0 is the grand total."""
    shift = [F.grouping(c) for c in hierarchy]
    level = F.lit(len(hierarchy))
    for g in shift:
        level = level - g.cast("int")
    return df.rollup(*hierarchy).agg(level.alias("level"), *[c.alias(name) for name, c in measures.items()])
