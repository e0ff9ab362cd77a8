"""Ratings and reception."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.money import stable_avg
from reelspark.operators.sampling import sample_exactly
from reelspark.plans.finance import RATING_COLUMNS
from reelspark.plans.star import Star


def rating_distribution(star: Star, source: str = "imdb") -> DataFrame:
    """Histogram of ratings in bins of width one."""
    rating = F.col(RATING_COLUMNS.get(source, RATING_COLUMNS["imdb"]))
    return (
        star.fact_movie_metrics.where(rating.isNotNull())
        .groupBy(F.floor(rating).cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
        .orderBy("bin")
    )


def platform_comparison(star: Star, start_year: int = 1990, end_year: int = 2025) -> DataFrame:
    """Mean rating per platform and year."""
    return (
        star.films()
        .where(F.col("year").between(start_year, end_year))
        .groupBy("year")
        .agg(
            stable_avg(F.col("imdb_rating")).alias("imdb_avg"),
            stable_avg(F.col("tmdb_rating")).alias("tmdb_avg"),
            stable_avg(F.col("ml_avg_rating")).alias("ml_avg"),
        )
        .orderBy("year")
    )


def cult_classics(star: Star, min_rating: float = 8.0, max_votes: int = 10_000, limit: int = 50) -> DataFrame:
    """High rating, few votes (but more than 1000)."""
    votes = F.col("imdb_votes")
    return (
        star.films()
        .where((F.col("imdb_rating") >= min_rating) & (votes <= max_votes) & (votes > 1000))
        .select("movie_id", "title", "year", "poster_url", "imdb_rating", "imdb_votes", "tmdb_rating")
        .orderBy(F.desc("imdb_rating"), F.asc("imdb_votes"), "movie_id")
        .limit(limit)
    )


def runtime_vs_rating(star: Star, sample_size: int = 1000, seed: int = 0) -> DataFrame:
    """Random films with runtime and rating, for a scatter plot."""
    films = star.films().where(F.col("runtime").between(30, 300) & F.col("imdb_rating").isNotNull())
    rows = films.select("movie_id", "runtime", F.col("imdb_rating").alias("rating"))
    return sample_exactly(rows, sample_size, F.col("movie_id"), seed).drop("movie_id")


def divisive_movies(star: Star, limit: int = 10) -> DataFrame:
    """Films on which critics and audience disagree most."""
    return (
        star.films()
        .where(F.col("divisive_score").isNotNull())
        .select("movie_id", "title", "year", "tomatometer_score", "audience_score", "divisive_score")
        .orderBy(F.desc("divisive_score"), "movie_id")
        .limit(limit)
    )
