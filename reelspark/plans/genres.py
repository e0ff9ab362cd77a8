"""Genre analytics. Facts are aggregated by genre id first; names are joined to the few aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.money import stable_avg
from reelspark.operators.dedupe import top_n_per_group
from reelspark.operators.pairs import vocabulary_pair_counts
from reelspark.plans.star import Star


def decade(year: str = "year") -> Column:
    return F.expr(f"({year} div 10) * 10").cast("int")


def genre_share_by_decade(star: Star, start_year: int = 1920, end_year: int = 2024) -> DataFrame:
    films = star.dim_movie.where(F.col("year").between(start_year, end_year)).select("movie_id", decade().alias("decade"))
    counts = star.bridge_movie_genres.join(films, "movie_id").groupBy("decade", "genre_id").agg(F.count("*").alias("count"))
    return (
        counts.join(star.dim_genre, "genre_id")
        .groupBy("decade", "genre_name")
        .agg(F.sum("count").alias("count"))
        .orderBy("decade", F.desc("count"), "genre_name")
    )


def genre_average_rating(star: Star, more_than: int = 100) -> DataFrame:
    """Mean rating of genres with more than ``more_than`` rated films."""
    rated = star.fact_movie_metrics.where(F.col("imdb_rating").isNotNull()).select("movie_id", "imdb_rating")
    stats = (
        star.bridge_movie_genres.join(rated, "movie_id")
        .groupBy("genre_id")
        .agg(stable_avg(F.col("imdb_rating")).alias("avg_rating"), F.count("*").alias("movie_count"))
        .where(F.col("movie_count") > more_than)
    )
    return (
        stats.join(star.dim_genre, "genre_id")
        .select("genre_name", "avg_rating", "movie_count")
        .orderBy(F.desc("avg_rating"), "genre_name")
    )


def genre_cooccurrence(star: Star, more_than: int = 50, limit: int | None = None) -> DataFrame:
    """Genre pairs that share more than ``more_than`` films."""
    pairs = vocabulary_pair_counts(star.bridge_movie_genres, "movie_id", "genre_id").where(F.col("count") > more_than)
    first = star.dim_genre.select(F.col("genre_id").alias("item1"), F.col("genre_name").alias("genre1"))
    second = star.dim_genre.select(F.col("genre_id").alias("item2"), F.col("genre_name").alias("genre2"))
    named = pairs.join(first, "item1").join(second, "item2").select("genre1", "genre2", "count")
    ranked = named.orderBy(F.desc("count"), "genre1", "genre2")
    return ranked if limit is None else ranked.limit(limit)


def genre_list(star: Star) -> DataFrame:
    """All genres with their number of films, also those without any."""
    counts = star.bridge_movie_genres.groupBy("genre_id").agg(F.count("movie_id").alias("movie_count"))
    return (
        star.dim_genre.join(counts, "genre_id", "left")
        .select("genre_id", "genre_name", F.coalesce("movie_count", F.lit(0)).alias("movie_count"))
        .orderBy(F.desc("movie_count"), "genre_id")
    )


def top_by_genre(star: Star, n: int = 5, metric: str = "revenue") -> DataFrame:
    """The n best films of each genre by a metric."""
    scored = star.fact_movie_metrics.where(F.col(metric).isNotNull()).select("movie_id", metric)
    rows = star.bridge_movie_genres.join(scored, "movie_id")
    best = top_n_per_group(rows, ["genre_id"], [F.desc(metric), F.asc("movie_id")], n)
    return (
        best.join(star.dim_movie.select("movie_id", "title", "year"), "movie_id")
        .join(star.dim_genre, "genre_id")
        .select("genre_name", "rank", "movie_id", "title", "year", metric)
        .orderBy("genre_name", "rank")
    )
