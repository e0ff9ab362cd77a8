"""Silver tables -> star schema: four dimensions, one fact, two bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.genres import canonical_genre, is_mapped_genre
from reelspark.functions.money import round_half_up
from reelspark.operators.dedupe import first_per_key
from reelspark.operators.joins import left_join_sparse, union_all
from reelspark.operators.numbering import dense_key_of_names
from reelspark.plans.star import layout_keys
from reelspark.sources import writers
from reelspark.sources.readers import calendar, read_present, read_table, run_date


def build_dim_time(days: DataFrame) -> DataFrame:
    """Calendar attributes of a table of days (column ``date``). Sunday is day 1; weeks are ISO weeks."""
    d = F.col("date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("time_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
    )


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """All days between the first and the last date of a column."""
    span = df.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("date"))


def exploded_genres(silver: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return silver.select(*(keys or []), F.explode("genres_array").alias("genre"))


def build_dim_genre(silver_tables: list[DataFrame]) -> DataFrame:
    """Canonical genre names of all sources that are present, numbered by name.

    Raw spellings are made distinct before they are canonicalised, so the text work is done once per spelling.
    """
    raw = union_all([exploded_genres(t) for t in silver_tables]).distinct()
    return dense_key_of_names(raw.select(canonical_genre(F.col("genre")).alias("genre_name")), "genre_name", "genre_id")


def unmapped_genres(silver_tables: list[DataFrame], default: str = "Other") -> DataFrame:
    """Spellings outside the vocabulary with their number of uses and the category they fall back to."""
    raw = union_all([exploded_genres(t) for t in silver_tables])
    uses = raw.where(F.col("genre").isNotNull()).groupBy("genre").agg(F.count("*").alias("uses"))
    return uses.where(~is_mapped_genre(F.col("genre"))).withColumn("default_genre", F.lit(default))


def build_dim_person(names: DataFrame) -> DataFrame:
    """Persons with a known birth year, one row each."""
    people = names.where(F.col("birth_year").isNotNull()).select(
        "person_id",
        "name",
        "birth_year",
        "death_year",
        "primary_profession",
        F.col("professions_raw").alias("all_professions"),
        "known_for_titles",
    )
    return first_per_key(people, ["person_id"])


def build_dim_movie(
    spine: DataFrame, imdb: DataFrame, ml: DataFrame, tmdb: DataFrame, rt: DataFrame
) -> DataFrame:
    """One row per film; titles and years come from IMDb, else MovieLens, TMDB, Rotten Tomatoes."""
    ids = spine.select("movie_id", "imdb_id", "tmdb_id", "ml_id", "rt_slug")
    imdb = imdb.select(
        "imdb_id",
        F.col("primary_title").alias("imdb_title"),
        F.col("original_title").alias("imdb_original"),
        F.col("year").alias("imdb_year"),
        F.col("runtime_minutes").alias("runtime"),
        "is_adult",
    )
    ml = ml.select("ml_id", F.col("title").alias("ml_title"), F.col("year").alias("ml_year"))
    tmdb = tmdb.select(
        "tmdb_id",
        F.col("title").alias("tmdb_title"),
        F.col("year").alias("tmdb_year"),
        "plot_summary",
        "poster_url",
        "backdrop_url",
        "popularity",
    )
    rt = rt.select(
        "rt_slug", F.col("title").alias("rt_title"), F.col("release_year").alias("rt_year"), "mpaa_rating"
    )
    joined = ids
    for side, key in [(imdb, "imdb_id"), (ml, "ml_id"), (tmdb, "tmdb_id"), (rt, "rt_slug")]:
        joined = left_join_sparse(joined, _one_per_key(side, key), key, ["movie_id"])
    return joined.select(
        "movie_id",
        "imdb_id",
        "tmdb_id",
        "ml_id",
        "rt_slug",
        F.coalesce("imdb_title", "ml_title", "tmdb_title", "rt_title").alias("title"),
        F.coalesce("imdb_original", "tmdb_title").alias("original_title"),
        F.coalesce("imdb_year", "ml_year", "tmdb_year", "rt_year").alias("year"),
        "runtime",
        "mpaa_rating",
        "plot_summary",
        "poster_url",
        "backdrop_url",
        "is_adult",
        "popularity",
    )


def metric_id(movie_id: Column, day: Column) -> Column:
    """Stable hash of film and snapshot day, both as int. An id beyond the int range is an error, not another hash."""
    return F.xxhash64(movie_id.cast("int"), day.cast("int"))


def _one_per_key(side: DataFrame, key: str) -> DataFrame:
    """One row per id before it is joined, so that a repeated source row doesn't repeat a film. NULL ids join nothing."""
    return first_per_key(side.where(F.col(key).isNotNull()), [key])


def build_fact_metrics(
    spine: DataFrame,
    ml_ratings: DataFrame,
    imdb_ratings: DataFrame,
    rt: DataFrame,
    tmdb: DataFrame,
    date: str | None = None,
) -> DataFrame:
    """All ratings and money of a film as seen on the snapshot day."""
    ml_ratings = ml_ratings.select(
        "ml_id", round_half_up(F.col("ml_avg_rating"), 2).alias("ml_avg_rating"), "ml_rating_count"
    )
    imdb_ratings = imdb_ratings.select("imdb_id", "imdb_rating", "imdb_votes")
    rt = rt.select("rt_slug", "tomatometer_score", "audience_score", "divisive_score")
    tmdb = tmdb.select(
        "tmdb_id", "tmdb_rating", "tmdb_votes", F.col("popularity").alias("tmdb_popularity"), "budget", "revenue"
    )
    joined = spine.select("movie_id", "ml_id", "imdb_id", "tmdb_id", "rt_slug")
    for side, key in [(ml_ratings, "ml_id"), (imdb_ratings, "imdb_id"), (rt, "rt_slug"), (tmdb, "tmdb_id")]:
        joined = left_join_sparse(joined, _one_per_key(side, key), key, ["movie_id"])
    day = F.date_format(run_date(date), "yyyyMMdd")
    return joined.select(
        metric_id(F.col("movie_id"), day).alias("metric_id"),
        "movie_id",
        day.cast("int").alias("time_id"),
        "ml_avg_rating",
        "ml_rating_count",
        "imdb_rating",
        "imdb_votes",
        "tmdb_rating",
        "tmdb_votes",
        "tmdb_popularity",
        "tomatometer_score",
        "audience_score",
        "divisive_score",
        "budget",
        "revenue",
    )


def build_bridge_cast(spine: DataFrame, principals: DataFrame, dim_person: DataFrame) -> DataFrame:
    """Credits of known films and known persons, one row per (film, person, ordering)."""
    films = spine.where(F.col("imdb_id").isNotNull()).select("movie_id", "imdb_id")
    credits = principals.join(dim_person.select("person_id"), "person_id", "left_semi").join(films, "imdb_id")
    rows = credits.select("movie_id", "person_id", "category", "ordering", "job", "characters")
    return first_per_key(rows, ["movie_id", "person_id", "ordering"])


def build_bridge_genres(spine: DataFrame, silver_by_key: dict[str, DataFrame], dim_genre: DataFrame) -> DataFrame:
    """(film, genre) from every source, joined by that source's own id (``silver_by_key``: id column -> table)."""
    spelled = {key: silver.select(key, F.explode("genres_array").alias("spelling")) for key, silver in silver_by_key.items()}
    # The text work is done once for each distinct spelling, a small vocabulary, and not for each film.
    distinct = union_all([s.select("spelling") for s in spelled.values()]).distinct()
    names = distinct.select("spelling", canonical_genre(F.col("spelling")).alias("genre_name"))
    ids = names.join(dim_genre.select("genre_id", "genre_name"), "genre_name").select("spelling", "genre_id")
    parts = []
    for key, genres in spelled.items():
        films = spine.where(F.col(key).isNotNull()).select("movie_id", key)
        parts.append(films.join(genres, key).select("movie_id", "spelling"))
    return union_all(parts).join(ids, "spelling").select("movie_id", "genre_id").distinct()


# Silver tables that carry genres, with the id that links them to the spine.
GENRE_SOURCES = {
    "movielens/movies": "ml_id",
    "imdb/title_basics": "imdb_id",
    "tmdb/movies": "tmdb_id",
    "rotten_tomatoes/movies": "rt_slug",
}


def publish_all(spark: SparkSession, lake_root: str, date: str | None = None) -> None:
    """Refresh the star from silver. Dimensions are written first; the bridges read them back instead of
    computing them again. A missing genre source is skipped."""

    def silver(name: str) -> DataFrame:
        return read_table(spark, f"{lake_root}/silver/{name}")

    def gold(name: str) -> DataFrame:
        return read_table(spark, f"{lake_root}/gold/{name}")

    def publish(name: str, df: DataFrame) -> None:
        writers.write_table(
            df.withColumn("created_date", run_date(date)), f"{lake_root}/gold/{name}", sort_by=layout_keys(name)
        )

    spine = silver("entity_spine")
    imdb, ml, tmdb, rt = [
        silver(t) for t in ("imdb/title_basics", "movielens/movies", "tmdb/movies", "rotten_tomatoes/movies")
    ]
    present = read_present(spark, [f"{lake_root}/silver/{t}" for t in GENRE_SOURCES])
    by_key = {GENRE_SOURCES[path.removeprefix(f"{lake_root}/silver/")]: df for path, df in present.items()}

    publish("dim_time", build_dim_time(calendar(spark)))
    publish("dim_genre", build_dim_genre(list(by_key.values())))
    publish("dim_person", build_dim_person(silver("imdb/name_basics")))
    publish("dim_movie", build_dim_movie(spine, imdb, ml, tmdb, rt))
    publish(
        "fact_movie_metrics",
        build_fact_metrics(spine, silver("movielens/ratings_agg"), silver("imdb/title_ratings"), rt, tmdb, date),
    )
    # The fact holds the newest snapshot; its days are kept beside it.
    writers.write_days(gold("fact_movie_metrics"), f"{lake_root}/gold/_snapshots/fact_movie_metrics", "time_id")
    publish("bridge_movie_cast", build_bridge_cast(spine, silver("imdb/title_principals"), gold("dim_person")))
    publish("bridge_movie_genres", build_bridge_genres(spine, by_key, gold("dim_genre")))
