"""Data-quality checks of star tables. Every check is an aggregate or an anti join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.operators.joins import prefixed


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of the child whose key is missing in the parent (a NULL key counts as missing)."""
    keys = parent.select(F.col(parent_key or child_key).alias(child_key))
    return child.join(keys, child_key, "left_anti").select(*child.columns)


def range_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Number of rows that break each rule, from one pass. A rule that is NULL for a row is not broken."""
    counts = df.agg(*[F.count_if(~rule).alias(f"_rule{i}") for i, rule in enumerate(rules.values())])
    lines = [F.struct(F.lit(name).alias("rule"), F.col(f"_rule{i}").alias("violations")) for i, name in enumerate(rules)]
    return counts.select(F.explode(F.array(*lines)).alias("e")).select("e.rule", "e.violations")


def without_any(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all the given columns are NULL."""
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull())


def check_row(table: str, check: str, violations: DataFrame) -> DataFrame:
    """One report line: how many rows a violation query returns."""
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations"
    )


LOADED = "loaded"
_LANES = 64  # a key's conflicting rows are compared in so many parts first


def judge_rows(
    df: DataFrame, key: list[str], parents: list[tuple[str, DataFrame, str]] = (), stored: DataFrame | None = None, fits: Column | None = None
) -> DataFrame:
    """Every row with its ``reason`` and ``copies``, in one pass over df: ``loaded``, or why it is rejected.

    In this order: a value that doesn't fit (``does_not_fit``, where ``fits`` is false), a NULL key part (``null_key``), a reference without a
    parent (``orphan``; a NULL reference has none), a key of ``stored`` rows (``already_loaded``), or a key that another row has taken
    (``duplicate_key``: the least by the other columns is loaded). Identical rows are folded into one with their number first. The rows of a key are ranked in lanes by
    hash, then the lanes' first rows: no key needs one task for all its rows. Joins and both rankings stand in stages of their own, so that no
    task holds the sorted rows of all of them.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in key]
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    reason = F.when(~(F.lit(True) if fits is None else fits), "does_not_fit").when(~has_key, "null_key")
    for i, (column, parent, parent_key) in enumerate(parents):
        known = parent.select(F.col(parent_key).alias(f"_parent{i}")).distinct()
        rows = rows.join(known, F.col(column) == F.col(f"_parent{i}"), "left").withColumn(f"_parent{i}", F.col(f"_parent{i}").isNotNull())
        reason = reason.when(~F.col(f"_parent{i}"), "orphan")
    if stored is not None:
        taken = prefixed(stored.select(*key), key, "_stored_").distinct()
        rows = rows.join(taken, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_stored_{k}") for k in key]), "left")
        reason = reason.when(F.col(f"_stored_{key[0]}").isNotNull(), "already_loaded")
    mark = F.xxhash64(*df.columns)
    rows = rows.select(*df.columns, "copies", reason.alias("_reason"))
    is_open = F.col("_reason").isNull()
    rows = rows.withColumn("_lane", F.when(is_open, F.pmod(mark, F.lit(_LANES))).otherwise(mark))
    rows = rows.repartition(*key, "_lane")  # else the ranking stays in the tasks of a join by part of the key, with all rows of that part
    rows = rows.withColumn("_first", is_open & (F.row_number().over(Window.partitionBy(*key, "_lane").orderBy(*(rest or key))) == 1))
    rows = rows.withColumn("_lane", F.when(F.col("_first"), F.lit(_LANES)).otherwise(mark))
    loaded = F.col("_first") & (F.row_number().over(Window.partitionBy(*key, "_lane").orderBy(*(rest or key))) == 1)
    line = lambda why, n: F.struct(why.alias("reason"), n.cast("bigint").alias("copies"))
    spare = line(F.lit("duplicate_key"), F.col("copies") - 1)
    rows = rows.withColumn("_loaded", loaded)
    lines = (
        F.when(F.col("_loaded") & (F.col("copies") > 1), F.array(line(F.lit(LOADED), F.lit(1)), spare))
        .when(F.col("_loaded"), F.array(line(F.lit(LOADED), F.lit(1))))
        .otherwise(F.array(line(F.coalesce("_reason", F.lit("duplicate_key")), F.col("copies"))))
    )
    return rows.select(*df.columns, F.explode(lines).alias("_line")).select(*df.columns, "_line.reason", "_line.copies")


def split_quarantine(df: DataFrame, key: list[str], parents: list[tuple[str, DataFrame, str]] = ()) -> tuple[DataFrame, DataFrame]:
    """``judge_rows`` as two frames: the loadable rows, and the rejected ones with reason and copies."""
    judged = judge_rows(df, key, parents)
    return judged.where(F.col("reason") == LOADED).select(*df.columns), judged.where(F.col("reason") != LOADED)
