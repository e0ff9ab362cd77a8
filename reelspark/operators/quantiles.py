"""Exact interpolated percentiles of groups of any size."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from reelspark.operators.joins import prefixed, same_key

# Slices per factor e of magnitude; a slice is about 0.02 % wide.
_SLICES = 4096
# Larger than any |ln(double)| * _SLICES, so the sign keeps the order of slices.
_SPAN = 1 << 22
# Bits of a value's place in its slice that tell its cell. A slice holds some 2^40 doubles, so a cell holds about 2^20 and a slice 2^20 cells.
_DIGIT = 20
_NO_VALUE = -(1 << 40)
# Infinity and NaN (the greatest value, as in PostgreSQL) have slices of their own.
_INFINITE, _NAN = 1 << 30, 1 << 31


def _slice_of(value: Column) -> Column:
    """Order-preserving slice number of a double: values of a lower slice are all smaller."""
    size = F.floor(F.ln(F.abs(value)) * _SLICES)
    return (
        F.when(F.isnan(value), F.lit(_NAN))
        .when(F.abs(value) == float("inf"), F.signum(value) * _INFINITE)
        .when(value > 0, size + _SPAN)
        .when(value < 0, -(size + _SPAN))
        .when(value == 0, F.lit(0))
        .otherwise(F.lit(_NO_VALUE))
        .cast("bigint")
    )


def _place_in_slice(value: Column) -> Column:
    """Order-preserving cell of a double in its slice, a number of _DIGIT bits."""
    low = F.exp(F.floor(F.ln(F.abs(value)) * _SLICES) / _SLICES)
    share = F.try_divide(F.abs(value) - low, low * (math.exp(1 / _SLICES) - 1))
    most = (1 << _DIGIT) - 1
    place = F.greatest(F.least(F.floor(share * (most + 1)), F.lit(most)), F.lit(0))
    regular = ~F.isnan(value) & (F.abs(value) != float("inf")) & (value != 0)
    return F.coalesce(F.when(regular, F.when(value > 0, place).otherwise(most - place)), F.lit(0)).cast("bigint")


def _total(name: str, whole: bool, over: WindowSpec | None = None) -> Column:
    """Sum of a column; a decimal keeps its type, as Spark would otherwise widen it at each step."""
    total = F.sum(name) if over is None else F.sum(name).over(over)
    return (total.cast("decimal(38,0)") if whole else total).alias(name)


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    row_count: str = "row_count",
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Per group: number of rows, sums, and percentiles interpolated like SQL ``percentile_cont``.

    The built-in ``percentile`` keeps a whole group in one task. Here rows are folded by group and value first
    (combined map side, so one value of a hot group is one row a task). A histogram of narrow slices over the folded rows
    shows which slice holds each wanted rank. Radix selection goes on inside: a histogram of the next 20 bits of the values' place in their
    slice narrows it to one cell, so that values with a large offset, which share a slice, are parted too. Only the different values of
    that cell are ranked; neither it nor a histogram of cells can hold many more than a million rows. All rounds read the same folded rows. NULL values count as rows only; NaN is the greatest value. Sums of whole numbers are
    decimal, so they don't overflow. The slice list (two rows for each group and percentile at most) is broadcast
    if Spark finds it small.
    """
    sums = sums or {}
    typed = df.withColumns({"_v": F.col(value).cast("double"), **{f"_s_{k}": c for k, c in sums.items()}})
    whole = {k for k in sums if typed.schema[f"_s_{k}"].dataType.typeName() in ("long", "integer", "short", "byte")}
    addend = {k: F.col(f"_s_{k}").cast("decimal(38,0)") if k in whole else F.col(f"_s_{k}") for k in sums}
    folded = typed.groupBy(*keys, "_v").agg(F.count("*").alias("_rows"), *[F.sum(c).alias(k) for k, c in addend.items()])
    sliced = folded.withColumn("_slice", _slice_of(F.col("_v")))
    histogram = sliced.groupBy(*keys, "_slice").agg(
        F.sum("_rows").alias("_rows"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_rows")).otherwise(0)).alias("_filled"),
        *[_total(name, name in whole) for name in sums],
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = histogram.select(
        *keys,
        "_slice",
        F.sum("_rows").over(group).alias(row_count),
        F.sum("_filled").over(group).alias("_n"),
        (F.sum("_filled").over(upto) - F.col("_filled")).alias("_below"),
        F.sum("_filled").over(upto).alias("_upto"),
        *[_total(name, name in whole, group) for name in sums],
    )

    def position(p: float) -> Column:
        return F.lit(p) * (F.col("_n") - 1)

    def ranks(p: float) -> tuple[Column, Column]:
        return F.floor(position(p)), F.ceil(position(p))

    wanted = [r for p in probabilities.values() for r in ranks(p)]
    holds_a_rank = reduce(lambda a, b: a | b, [(F.col("_below") <= r) & (r < F.col("_upto")) for r in wanted]) | (F.col("_n") == 0)
    carried = ["_n", "_below", row_count, *sums]
    targets = placed.where(holds_a_rank).select(*keys, "_slice", *carried)

    place = [*keys, "_slice"]
    picked = (
        sliced.select(*place, "_v", F.when(F.col("_v").isNotNull(), F.col("_rows")).otherwise(0).alias("_copies"))
        .join(prefixed(targets, place), same_key(place))
        .select(*place, "_v", "_copies", *carried)
    )
    picked = picked.withColumn("_cell", _place_in_slice(F.col("_v")))
    cells = picked.groupBy(*place, "_cell").agg(F.sum("_copies").alias("_filled"), F.max("_below").alias("_before"), F.max("_n").alias("_n"))
    running = Window.partitionBy(*place).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("_upto", F.col("_before") + F.sum("_filled").over(running))
    cells = cells.withColumn("_below", F.col("_upto") - F.col("_filled")).where(holds_a_rank)
    place = [*place, "_cell"]
    found = prefixed(cells.select(*place, F.col("_below").alias("_from")), place)
    picked = picked.drop("_below").join(found, same_key(place)).withColumnRenamed("_from", "_below").drop(*(f"r_{c}" for c in place))
    in_slice = (
        Window.partitionBy(*place).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = picked.withColumn("_end", F.col("_below") + F.sum("_copies").over(in_slice)).withColumn(
        "_start", F.col("_end") - F.col("_copies")
    )

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    ends = []
    for i, p in enumerate(probabilities.values()):
        low, high = ranks(p)
        ends += [value_at(low).alias(f"_low{i}"), value_at(high).alias(f"_high{i}")]
    per_group = ranked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ["_n", row_count, *sums]], *ends
    )
    return per_group.select(
        *keys,
        row_count,
        *sums,
        *[
            F.when(F.col(f"_low{i}") == F.col(f"_high{i}"), F.col(f"_low{i}"))
            .otherwise(
                F.col(f"_low{i}")
                + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (position(p) - F.floor(position(p)))
            ).alias(name)
            for i, (name, p) in enumerate(probabilities.items())
        ],
    )
