"""Rows that travel through an operator whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame, *apart: str) -> DataFrame:
    """Columns `apart` as they are, and all others in one struct `row`, so that no name can clash with a working column."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in apart))
    return docs.select(others.alias("row"), *(F.col(f"`{c}`") for c in apart))


def unpacked(rows: DataFrame, docs: DataFrame, *apart: str) -> DataFrame:
    """The columns of docs from rows of packed(docs, *apart)."""
    return rows.select(*(F.col(f"`{c}`") if c in apart else F.col("row").getField(c).alias(c) for c in docs.columns))
