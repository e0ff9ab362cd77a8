"""Surrogate keys 1..n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.session import cut_lineage

SAMPLED = 32  # sampled keys for each range
# monotonically_increasing_id() packs (partition index, row in partition) as index * 2^33 + row.
_PARTITION_SHIFT = 33


def serial_key(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows 1..n in the given order without a single-task sort.

    Rows are range-partitioned and sorted in place, so each partition holds a contiguous stretch of the order.
    The packed id then holds each row's place, and one running sum over the partition sizes (one row per
    partition) turns it into the global number. ``order`` has to be total over the rows. The id is stored
    before it is read twice, as partition boundaries come from a sample.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_packed", F.monotonically_increasing_id())
    )
    part = F.shiftright("_packed", _PARTITION_SHIFT)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this window and the broadcast are bounded by the partition count.
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    in_part = F.col("_packed") - F.shiftleft(F.col("_part"), _PARTITION_SHIFT)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + in_part + 1).cast("bigint").alias(name), *df.columns)
    )


def _splitters(df: DataFrame, order: list[Column], ranges: int) -> Column:
    """Sorted order keys that part the rows into about equal ranges, as a subquery of one row.

    They are quantiles of the keys with the smallest hashes: a sample that depends on the keys alone, so that every reader of
    the plan, and every retry, cuts at the same keys."""
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    keys = df.select(key.alias("key"))
    sample = keys.orderBy(F.xxhash64("key"), "key").limit(ranges * SAMPLED).agg(F.sort_array(F.collect_list("key")).alias("keys"))
    step = F.greatest(F.floor(F.size("keys") / ranges), F.lit(1)).cast("int")
    return sample.select(F.filter("keys", lambda k, i: (i % step == 0) & (i > 0)).alias("splitters")).scalar()


def _range_of(key: Column, splitters: Column, ranges: int) -> Column:
    """How many splitters are smaller than or equal to the key: a binary search."""
    start = F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        smaller = F.get(splitters, middle) <= key
        return F.when(s["low"] >= s["high"], s).otherwise(
            F.struct(F.when(smaller, middle + 1).otherwise(s["low"]).alias("low"), F.when(smaller, s["high"]).otherwise(middle).alias("high"))
        )

    rounds = F.sequence(F.lit(0), F.lit((ranges * SAMPLED).bit_length()))
    return F.aggregate(rounds, start, halve)["low"]


def lazy_serial_key(df: DataFrame, order: list[Column], name: str, ranges: int | None = None) -> DataFrame:
    """As ``serial_key``, in ascending order of plain columns (NULL first) and without a job while the plan is built.

    Splitters from a sample of the order keys cut the rows into ranges (as many as Spark has shuffle partitions by default). The sizes of the
    smaller ranges, one running sum over the ranges, are added to a row's place in its range. ``order`` has to be total over the rows, so
    no range can be hot. df is computed three times, for the sample and the sizes with the order columns alone: right for
    a stored table, while a costly plan is better stored once, as ``serial_key`` does.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    splitters = _splitters(df, order, ranges)
    key = F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order)))
    placed = df.select("*", key.alias("_key"), splitters.alias("_splitters"))
    placed = placed.withColumn("_range", _range_of(F.col("_key"), F.col("_splitters"), ranges)).drop("_splitters")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, so this window and the broadcast are bounded by their number.
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return (
        placed.withColumn("_place", in_range)
        .join(F.broadcast(offsets), "_range")
        .select((F.col("_offset") + F.col("_place")).cast("bigint").alias(name), *df.columns)
    )


def dense_key_of_names(names: DataFrame, column: str, key: str) -> DataFrame:
    """Number the distinct non-blank values of a small vocabulary by name, starting at 1."""
    distinct = names.where(F.col(column) != "").select(column).distinct()
    return distinct.select(F.row_number().over(Window.orderBy(column)).alias(key), column)
