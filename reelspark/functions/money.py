"""Money text and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnitude suffixes.
MAGNITUDES = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}


def parse_box_office(text: Column, exact: bool = True) -> Column:
    """'$1.2B' -> 1200000000; NULL when blank or not a number; fractions of a dollar are cut off.

    ``exact=False`` multiplies in binary floating point, which loses a dollar on some inputs ('$8.2M').
    """
    bare = F.trim(F.regexp_replace(F.upper(text), "[$,]", ""))
    suffix = F.right(bare, F.lit(1))
    digits = F.regexp_replace(bare, "[KMB]$", "")
    factor = F.lit(1)
    for letter, size in MAGNITUDES.items():
        factor = F.when(suffix == letter, F.lit(size)).otherwise(factor)
    if exact:
        whole = digits.try_cast("decimal(28,9)")
        amount = F.when(suffix.isin(list(MAGNITUDES)), whole * factor.cast("decimal(10,0)")).otherwise(whole)
    else:
        amount = digits.try_cast("double") * factor.cast("double")
    return amount.try_cast("bigint")


def revenue_multiple(revenue: Column, budget: Column) -> Column:
    """Revenue per unit of budget, NULL for a zero budget."""
    return revenue.cast("double") / F.nullif(budget, F.lit(0)).cast("double")


def round_half_up(x: Column, scale: int) -> Column:
    """Round through decimal, so that 1.005 is seen as 1.005 and not as its binary neighbour."""
    return F.round(x.cast("decimal(38,10)"), scale).cast("double")


def mean_of_whole_numbers(x: Column) -> Column:
    """Average of an integer column from an exact integer sum: independent of row order and partitioning."""
    return F.sum(x.cast("bigint")).cast("double") / F.count(x)


def exact_sum(x: Column) -> Column:
    """Sum of a floating column in decimal: the same under any order of addition and any partitioning."""
    return F.sum(x.cast("decimal(20,10)"))


def stable_avg(x: Column, scale: int = 6) -> Column:
    """Average of a floating column from an exact sum, so that neither a rank nor a re-run can flip a digit."""
    return round_half_up(exact_sum(x).cast("double") / F.count(x), scale)
