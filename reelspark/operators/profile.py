"""Completeness of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def completeness_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, filled values and their percentage for each column, from one pass over the data."""
    columns = columns or df.columns
    counts = df.agg(F.count("*").alias("_total"), *[F.count(c).alias(c) for c in columns])
    entries = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])
    ).alias("e")
    return counts.select("_total", entries).select(
        "e.column_name",
        F.col("_total").alias("total"),
        "e.filled",
        F.round(F.try_divide(F.col("e.filled") * 100, F.col("_total")), 2).alias("filled_pct"),
    )


LOG_BUCKETS = 12  # of a distinct sketch: a standard error of about 1.6 per cent
QUANTILE_K = 200  # of a quantile sketch: ranks are right within about 1.7 per cent
QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def delivery_sketches(df: DataFrame, delivery: str, columns: list[str] | None = None) -> DataFrame:
    """A row for each delivery and column, from one pass: rows, filled, and mergeable sketches of the distinct and of the numeric values.

    To be stored beside a delivery. A sketch has a few KB whatever the rows, and merging those of several deliveries gives the sketch of all
    their rows, so a profile over days reads no row again. NaN and infinity are left out of the quantiles."""
    columns = columns or [c for c in df.columns if c != delivery]
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}
    aggregates, lines = [F.count("*").alias("_rows")], []
    for i, c in enumerate(columns):
        aggregates += [F.count(c).alias(f"_filled{i}"), F.hll_sketch_agg(F.col(c).cast("string"), LOG_BUCKETS).alias(f"_distinct{i}")]
        values = F.lit(None).cast("binary")
        if c in numeric:
            value = F.col(c).cast("double")
            finite = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
            aggregates.append(F.kll_sketch_agg_double(finite, QUANTILE_K).alias(f"_values{i}"))
            values = F.col(f"_values{i}")
        parts = {"column_name": F.lit(c), "total": F.col("_rows"), "filled": F.col(f"_filled{i}"), "distinct_sketch": F.col(f"_distinct{i}"), "value_sketch": values}
        lines.append(F.struct(*(v.alias(k) for k, v in parts.items())))
    return df.groupBy(delivery).agg(*aggregates).select(delivery, F.inline(F.array(*lines)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """column_name, total, filled, distinct_values, and QUANTILES of numeric columns, over all given deliveries. Counts are exact, the
    others are estimates (see LOG_BUCKETS and QUANTILE_K)."""
    filled = F.filter(F.collect_list("value_sketch"), lambda s: F.kll_sketch_get_n_double(s) > 0)
    merged = sketches.groupBy("column_name").agg(
        F.sum("total").alias("total"),
        F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        filled.alias("_sketches"),  # one for each delivery
    )
    one = F.aggregate(F.slice("_sketches", 2, 1 << 30), F.get("_sketches", F.lit(0)), lambda a, s: F.kll_sketch_merge_double(a, s))
    merged = merged.withColumn("_values", F.when(F.size("_sketches") > 0, one))
    quantiles = [F.when(F.col("_values").isNotNull(), F.kll_sketch_get_quantile_double("_values", F.lit(p))).alias(name) for name, p in QUANTILES.items()]
    return merged.select("column_name", "total", "filled", "distinct_values", *quantiles)
