"""People analytics. Credits are aggregated by person id before names are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.functions.money import stable_avg
from reelspark.operators.pairs import named_pair_counts
from reelspark.plans.star import Star


def _credits(star: Star, category: str) -> DataFrame:
    return star.bridge_movie_cast.where(F.col("category") == category).select("movie_id", "person_id")


def top_prolific(star: Star, category: str = "actor", limit: int = 20) -> DataFrame:
    """People by number of different films."""
    counts = _credits(star, category).groupBy("person_id").agg(F.countDistinct("movie_id").alias("movie_count"))
    return (
        counts.join(star.dim_person.select("person_id", "name"), "person_id")
        .select("person_id", "name", "movie_count")
        .orderBy(F.desc("movie_count"), "person_id")
        .limit(limit)
    )


def top_rated(star: Star, category: str = "actor", min_films: int = 5, limit: int = 20) -> DataFrame:
    """People by mean rating over their credits; a second credit in a film counts again in the mean only."""
    rated = star.fact_movie_metrics.where(F.col("imdb_rating").isNotNull()).select("movie_id", "imdb_rating")
    stats = (
        _credits(star, category)
        .join(rated, "movie_id")
        .groupBy("person_id")
        .agg(stable_avg(F.col("imdb_rating")).alias("avg_rating"), F.countDistinct("movie_id").alias("movie_count"))
        .where(F.col("movie_count") >= min_films)
    )
    return (
        stats.join(star.dim_person.select("person_id", "name"), "person_id")
        .select("person_id", "name", "avg_rating", "movie_count")
        .orderBy(F.desc("avg_rating"), "person_id")
        .limit(limit)
    )


def rating_history(star: Star, person_id=None) -> DataFrame:
    """Mean rating and credits per year of one person, or of every person when none is named."""
    credits = star.bridge_movie_cast.select("movie_id", "person_id")
    if person_id is not None:
        credits = credits.where(F.col("person_id") == person_id)
    films = star.films().where(F.col("imdb_rating").isNotNull()).select("movie_id", "year", "imdb_rating")
    history = (
        credits.join(films, "movie_id")
        .groupBy("person_id", "year")
        .agg(stable_avg(F.col("imdb_rating")).alias("avg_rating"), F.count("*").alias("movie_count"))
    )
    if person_id is not None:
        return history.drop("person_id").orderBy("year")
    return history


def actor_network(star: Star, min_collaborations: int = 3, limit: int = 100, crowd: int = 256) -> DataFrame:
    """Pairs of actors by the number of credits they share. ``crowd``: see ``named_pair_counts``; results don't depend on it."""
    members = (
        _credits(star, "actor")
        .groupBy("movie_id", "person_id")
        .agg(F.count("*").alias("n"))
        .join(star.dim_person.select("person_id", "name"), "person_id")
        .where(F.col("name").isNotNull())
    )
    return (
        named_pair_counts(members, min_collaborations, crowd)
        .select(F.col("name1").alias("actor1"), F.col("name2").alias("actor2"), F.col("count").alias("collaborations"))
        .orderBy(F.desc("collaborations"), "actor1", "actor2")
        .limit(limit)
    )


def filmography(star: Star, person_id=None) -> DataFrame:
    """Credits of one person (or of every person), one row each, latest year first, unknown years on top.

    Rows and not a nested list: a person's credits are never gathered into one value.
    """
    credits = star.bridge_movie_cast.select("movie_id", "person_id", "category", "characters")
    if person_id is not None:
        credits = credits.where(F.col("person_id") == person_id)
    rows = credits.join(star.films("left").select("movie_id", "title", "year", "imdb_rating"), "movie_id")
    ordered = ["person_id", "movie_id", "title", "year", "category", "characters", "imdb_rating"]
    if person_id is None:
        return rows.select(*ordered)
    return rows.select(*ordered).orderBy(F.desc_nulls_first("year"), "movie_id", "category")


def person_detail(star: Star, person_id=None) -> DataFrame:
    """Filmography rows with the person's own data in front; a person without credits keeps one row."""
    people = star.dim_person if person_id is None else star.dim_person.where(F.col("person_id") == person_id)
    rows = people.join(filmography(star, person_id), "person_id", "left")
    if person_id is None:
        return rows
    return rows.orderBy(F.desc_nulls_first("year"), "movie_id", "category")


def person_summary(star: Star, person_id=None) -> DataFrame:
    """Credits in total and by role, mean of the known ratings, first and last year, per person."""
    rating = F.col("imdb_rating")
    role = F.col("category")
    is_actor, is_director = role.eqNullSafe("actor"), role.eqNullSafe("director")
    return filmography(star, person_id).groupBy("person_id").agg(
        F.count("*").alias("film_rows"),
        stable_avg(F.when(rating != 0, rating)).alias("avg_rating"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_if(is_actor).alias("actor_rows"),
        F.count_if(is_director).alias("director_rows"),
        F.count_if(~is_actor & ~is_director).alias("other_rows"),
    )
