"""Trends over time and by certification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.money import exact_sum, mean_of_whole_numbers, round_half_up, stable_avg
from reelspark.plans.genres import decade
from reelspark.plans.star import Star


def runtime_trend(star: Star, start_year: int = 1950, end_year: int = 2025) -> DataFrame:
    kept = star.dim_movie.where(F.col("runtime").between(30, 300) & F.col("year").between(start_year, end_year))
    return (
        kept.groupBy("year")
        .agg(mean_of_whole_numbers(F.col("runtime")).alias("avg_runtime"), F.count("*").alias("movie_count"))
        .orderBy("year")
    )


def quality_by_month(star: Star) -> DataFrame:
    """Mean rating by calendar month of the fact's day. Facts are folded by day first, the calendar joins those."""
    per_day = (
        star.fact_movie_metrics.where(F.col("imdb_rating").isNotNull())
        .groupBy("time_id")
        .agg(exact_sum(F.col("imdb_rating")).alias("rating_sum"), F.count("*").alias("movie_count"))
    )
    return (
        per_day.join(star.dim_time.where(F.col("month").isNotNull()).select("time_id", "month"), "time_id")
        .groupBy("month")
        .agg(
            round_half_up(F.sum("rating_sum").cast("double") / F.sum("movie_count"), 6).alias("avg_rating"),
            F.sum("movie_count").alias("movie_count"),
        )
        .orderBy("month")
    )


def quality_by_release_month(star: Star, releases: DataFrame) -> DataFrame:
    """As above, by the month of release: ``releases`` maps movie_id to a release_date text (yyyy-MM-dd)."""
    month = F.month(F.try_to_date("release_date", "yyyy-MM-dd"))
    dated = releases.select("movie_id", month.alias("month")).where(F.col("month").isNotNull())
    return (
        star.fact_movie_metrics.where(F.col("imdb_rating").isNotNull())
        .join(dated, "movie_id")
        .groupBy("month")
        .agg(stable_avg(F.col("imdb_rating")).alias("avg_rating"), F.count("*").alias("movie_count"))
        .orderBy("month")
    )


def mpaa_distribution(star: Star) -> DataFrame:
    """Films and mean rating per certification."""
    return (
        star.films("left")
        .where(F.col("mpaa_rating").isNotNull())
        .groupBy("mpaa_rating")
        .agg(F.count("*").alias("count"), stable_avg(F.col("imdb_rating")).alias("avg_rating"))
        .orderBy(F.desc("count"), "mpaa_rating")
    )


def mpaa_trend(star: Star, start_year: int = 1960) -> DataFrame:
    kept = star.dim_movie.where(F.col("mpaa_rating").isNotNull() & (F.col("year") >= start_year))
    return (
        kept.groupBy(decade().alias("decade"), "mpaa_rating")
        .agg(F.count("*").alias("count"))
        .orderBy("decade", F.desc("count"), "mpaa_rating")
    )
