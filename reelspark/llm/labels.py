"""Labelled training samples that leave the held-out third of the documents alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1. A row without id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_ids(labels: DataFrame, label: str, most: tuple[int, int]) -> DataFrame:
    """doc_id, y of at most most[y] documents of each class y that aren't held out, in an order by hash that says nothing
    about a document. Contradictory labels of one document are left out; so are NULLs."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").drop("z")
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(n) for y, n in enumerate(most)]
    return parts[0].union(parts[1])
