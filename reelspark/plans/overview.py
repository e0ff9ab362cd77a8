"""Catalogue overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.text import title_language
from reelspark.plans.star import Star

POPULARITY_METRICS = ("imdb_votes", "tmdb_popularity", "tmdb_votes")


def movies_per_year(star: Star, start_year: int = 1900, end_year: int = 2030) -> DataFrame:
    kept = star.dim_movie.where(F.col("year").between(start_year, end_year))
    return kept.groupBy("year").agg(F.count("*").alias("count")).orderBy("year")


def top_popular(star: Star, limit: int = 10, metric: str = "imdb_votes") -> DataFrame:
    """Most popular films; an unknown metric falls back to IMDb votes."""
    metric = metric if metric in POPULARITY_METRICS else POPULARITY_METRICS[0]
    return (
        star.films()
        .where(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), "movie_id")
        .limit(limit)
        .select(
            F.col("movie_id").cast("string").alias("movie_id"),
            "title",
            "year",
            "poster_url",
            "imdb_votes",
            "tmdb_popularity",
            "imdb_rating",
            "budget",
            "revenue",
        )
    )


def language_distribution(dim_movie: DataFrame) -> DataFrame:
    """Films per language guessed from the original title."""
    titled = dim_movie.where(F.col("original_title").isNotNull())
    return (
        titled.groupBy(title_language(F.col("original_title")).alias("language"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "language")
    )
