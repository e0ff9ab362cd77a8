"""Small reshapings of analytic results for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.plans import finance, genres, overview, people, ratings, temporal
from reelspark.plans.star import Star


def genre_shares(star: Star, top: int = 8, names: list[str] | None = None) -> DataFrame:
    """Share of each leading genre in a decade, in percent of the leading genres together, in long form.

    Leading are the ``top`` genres by films in total, or the named ones.
    """
    counts = genres.genre_share_by_decade(star)
    if names is None:
        totals = counts.groupBy("genre_name").agg(F.sum("count").alias("total"))
        leading = totals.orderBy(F.desc("total"), "genre_name").limit(top).select("genre_name")
        kept = counts.join(leading, "genre_name")
    else:
        kept = counts.where(F.col("genre_name").isin(names))
    of_decade = F.sum("count").over(Window.partitionBy("decade"))
    return kept.select("decade", "genre_name", (F.col("count") / of_decade * 100).alias("share"))


def genre_share_pivot(star: Star, top: int = 8) -> DataFrame:
    """One row per decade with, for the genres of rank 1 to ``top`` in the data, the name and its share of all films
    in leading genres (0 where absent), and ``other_films``: the films of the genres left out.

    Columns are named by rank, so neither the plan nor the schema depends on a look at the data.
    """
    counts = genres.genre_share_by_decade(star)
    totals = counts.groupBy("genre_name").agg(F.sum("count").alias("total"))
    order = [F.desc("total"), F.col("genre_name")]
    # ``top`` rows, so this window is no gathering of the data.
    leading = totals.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    ranked = counts.join(leading, "genre_name", "left")
    cell = {i: F.sum(F.when(F.col("rank") == i, F.col("count"))) for i in range(1, top + 1)}
    of_leading = F.sum(F.when(F.col("rank").isNotNull(), F.col("count")))
    wide = ranked.groupBy("decade").agg(
        *[F.coalesce(cell[i] / of_leading * 100, F.lit(0.0)).alias(f"share_{i}") for i in cell],
        F.coalesce(F.sum(F.when(F.col("rank").isNull(), F.col("count"))), F.lit(0)).alias("other_films"),
        *[F.max(F.when(F.col("rank") == i, F.col("genre_name"))).alias(f"genre_{i}") for i in cell],
    )
    # One row per decade, so this window is bounded; it gives decades without a genre its name as well.
    names = [F.max(f"genre_{i}").over(Window.partitionBy()).alias(f"genre_{i}") for i in cell]
    return wide.select("decade", *names, *[f"share_{i}" for i in cell], "other_films")


def overview_kpis(star: Star, titles: DataFrame | None = None, start_year: int = 1950, end_year: int = 2025) -> DataFrame:
    """Films, busiest year (the earliest on a tie), mean of the rating bins, number of languages."""
    per_year = overview.movies_per_year(star, start_year, end_year)
    years = per_year.agg(
        F.sum("count").alias("total_movies"),
        F.max_by("year", F.struct(F.col("count"), -F.col("year"))).alias("peak_year"),
    )
    bins = ratings.rating_distribution(star).agg(
        (F.sum(F.col("bin") * F.col("count")) / F.sum("count")).alias("avg_rating")
    )
    languages = overview.language_distribution(star.dim_movie if titles is None else titles)
    count = languages.agg(F.count("*").alias("total_languages"))
    # Three one-row results, folded into one row.
    stacked = years.unionByName(bins, allowMissingColumns=True).unionByName(count, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def platform_normalized(star: Star, start_year: int = 1990, end_year: int = 2025, tmdb_factor: float = 1.0) -> DataFrame:
    """Platform means on a common ten-point scale: MovieLens is doubled; TMDB has ten points already."""
    means = ratings.platform_comparison(star, start_year, end_year)
    return means.select(
        "year",
        "imdb_avg",
        (F.col("tmdb_avg") * tmdb_factor).alias("tmdb_avg"),
        (F.col("ml_avg") * 2).alias("ml_avg"),
    )


def genre_cooccurrence_matrix(star: Star, more_than: int = 50) -> DataFrame:
    """Symmetric long form of the pair counts with axis positions and an opacity from 0.15 to 1.

    The windows run over genre pairs, whose number the genre vocabulary bounds.
    """
    pairs = genres.genre_cooccurrence(star, more_than).select("genre1", "genre2", "count")
    both = pairs.unionByName(
        pairs.select(F.col("genre2").alias("genre1"), F.col("genre1").alias("genre2"), F.col("count"))
    )

    def axis(name: str) -> Column:
        return F.dense_rank().over(Window.orderBy(name)) - 1

    largest = F.greatest(F.max("count").over(Window.partitionBy()), F.lit(1))
    return both.select(
        axis("genre1").alias("x"),
        axis("genre2").alias("y"),
        "genre1",
        "genre2",
        "count",
        (F.col("count") / largest * 0.85 + 0.15).alias("opacity"),
    )


def genre_rating_top(star: Star, n: int = 15, more_than: int = 100) -> DataFrame:
    return genres.genre_average_rating(star, more_than).orderBy(F.desc("avg_rating"), "genre_name").limit(n)


def genre_roi_iqr(star: Star, **options) -> DataFrame:
    """Genre profitability with the distances of the quartiles from the median."""
    return finance.genre_profitability(star, **options).select(
        "*",
        F.round(F.col("median_roi") - F.col("p25_roi"), 2).alias("below_median"),
        F.round(F.col("p75_roi") - F.col("median_roi"), 2).alias("above_median"),
    )


def roi_tier(star: Star, **options) -> DataFrame:
    """ROI leaderboard with a tier by multiple."""
    m = F.col("revenue_multiple")
    tier = F.when(m >= 10, "10x and more").when(m >= 5, "5x").when(m >= 2, "2x").otherwise("below 2x")
    return finance.roi_leaderboard(star, **options).withColumn("tier", tier)


def value_tier(star: Star, **options) -> DataFrame:
    """Value frontier (at most 100 rows) with a tier by share of the best score."""
    best = F.greatest(F.max("value_score").over(Window.partitionBy()), F.lit(1.0))
    share = F.col("value_score") / best
    tier = F.when(share > 0.7, "high").when(share > 0.4, "medium").otherwise("low")
    return finance.value_frontier(star, **options).withColumn("tier", tier)


def actor_pairs_labelled(star: Star, min_collaborations: int = 3, limit: int = 100) -> DataFrame:
    pairs = people.actor_network(star, min_collaborations, limit)
    return pairs.withColumn("pair", F.concat_ws(" & ", "actor1", "actor2")).orderBy(F.desc("collaborations"), "pair")


def mpaa_top(star: Star, n: int = 5) -> DataFrame:
    return temporal.mpaa_distribution(star).limit(n)
