"""Substring search by an index of three-character sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def grams_of(text: Column) -> Column:
    """Distinct lower-case sequences of GRAM characters; none for a NULL or shorter text."""
    low = F.lower(text)
    places = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - (GRAM - 1)))
    return F.array_distinct(F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda i: F.substring(low, i, GRAM)))


def postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """gram, key: one row for each sequence of each text. Stored sorted by both, a sequence's rows are a run of the files, and a frequent one
    spans several."""
    return df.select(F.explode(grams_of(F.col(text))).alias("gram"), key)


def literal(pattern: str) -> str:
    """Text as a LIKE pattern that stands for itself."""
    return "".join("\\" + c if c in "\\%_" else c for c in pattern)


def containing(df: DataFrame, index: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """Rows of df whose text holds `part`, whatever its case; `%` and `_` stand for themselves.

    Only postings of the part's own sequences are read. A text that holds the part has all of them, so keys are counted (map side
    first), and those with every sequence are verified. A part of fewer than GRAM characters has no sequence: df is scanned."""
    holds = F.col(text).ilike(f"%{literal(part)}%")
    low = part.lower()
    grams = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    if not grams:
        return df.where(holds)
    found = index.where(F.col("gram").isin(*grams)).groupBy(key).agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams))
    return df.join(found.select(key), key, "left_semi").where(holds)
