"""Bronze tables -> silver tables: names, types, arrays. All builders are lazy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.genres import genre_names_from_ids
from reelspark.functions.money import parse_box_office, stable_avg
from reelspark.functions.text import normalize_title, split_or_null, strip_year_suffix, year_suffix
from reelspark.sources import writers
from reelspark.sources.readers import read_day, run_date

# Fixed values.
POSTER_BASE = "https://image.tmdb.org/t/p/w500"
BACKDROP_BASE = "https://image.tmdb.org/t/p/original"
NO_GENRES = "(no genres listed)"


def _int(name: str) -> Column:
    return F.col(name).try_cast("int")


def clean_ml_movies(movies: DataFrame, date: str | None = None) -> DataFrame:
    genres = F.when(F.col("genres") != NO_GENRES, F.split("genres", r"\|"))
    return movies.select(
        F.col("movieId").alias("ml_id"),
        strip_year_suffix(F.col("title")).alias("title"),
        year_suffix(F.col("title")).alias("year"),
        genres.alias("genres_array"),
        F.col("genres").alias("genres_raw"),
        run_date(date).alias("cleaned_date"),
    )


def aggregate_ml_ratings(ratings: DataFrame, date: str | None = None) -> DataFrame:
    return (
        ratings.groupBy(F.col("movieId").alias("ml_id"))
        .agg(stable_avg(F.col("rating")).alias("ml_avg_rating"), F.count("rating").alias("ml_rating_count"))
        .withColumn("aggregated_date", run_date(date))
    )


def clean_ml_tags(tags: DataFrame, date: str | None = None) -> DataFrame:
    """Trimmed tags; blank ones are dropped."""
    return tags.where(F.trim("tag") != "").select(
        F.col("userId").alias("user_id"),
        F.col("movieId").alias("ml_id"),
        F.trim("tag").alias("tag"),
        "timestamp",
        run_date(date).alias("cleaned_date"),
    )


def clean_imdb_titles(title_basics: DataFrame, date: str | None = None) -> DataFrame:
    """Films only."""
    return title_basics.where(F.col("titleType") == "movie").select(
        F.col("tconst").alias("imdb_id"),
        F.trim("primaryTitle").alias("primary_title"),
        F.trim("originalTitle").alias("original_title"),
        _int("startYear").alias("year"),
        _int("runtimeMinutes").alias("runtime_minutes"),
        _int("isAdult").alias("is_adult"),
        split_or_null(F.col("genres"), ",").alias("genres_array"),
        F.col("genres").alias("genres_raw"),
        run_date(date).alias("cleaned_date"),
    )


def clean_imdb_ratings(title_ratings: DataFrame, date: str | None = None) -> DataFrame:
    return title_ratings.select(
        F.col("tconst").alias("imdb_id"),
        F.col("averageRating").try_cast("double").alias("imdb_rating"),
        _int("numVotes").alias("imdb_votes"),
        run_date(date).alias("cleaned_date"),
    )


def clean_imdb_names(name_basics: DataFrame, date: str | None = None) -> DataFrame:
    return name_basics.select(
        F.col("nconst").alias("person_id"),
        F.trim("primaryName").alias("name"),
        _int("birthYear").alias("birth_year"),
        _int("deathYear").alias("death_year"),
        F.get(F.split("primaryProfession", ","), F.lit(0)).alias("primary_profession"),
        F.col("primaryProfession").alias("professions_raw"),
        F.split("knownForTitles", ",").alias("known_for_titles"),
        run_date(date).alias("cleaned_date"),
    )


def clean_imdb_principals(title_principals: DataFrame, date: str | None = None) -> DataFrame:
    return title_principals.select(
        F.col("tconst").alias("imdb_id"),
        _int("ordering").alias("ordering"),
        F.col("nconst").alias("person_id"),
        F.trim("category").alias("category"),
        F.trim("job").alias("job"),
        F.col("characters"),
        run_date(date).alias("cleaned_date"),
    )


def clean_imdb_crew(title_crew: DataFrame, date: str | None = None) -> DataFrame:
    return title_crew.select(
        F.col("tconst").alias("imdb_id"),
        split_or_null(F.col("directors"), ",").alias("directors"),
        split_or_null(F.col("writers"), ",").alias("writers"),
        run_date(date).alias("cleaned_date"),
    )


def clean_tmdb_movies(movies: DataFrame, date: str | None = None) -> DataFrame:
    return movies.select(
        F.col("id").alias("tmdb_id"),
        "title",
        "original_title",
        F.col("overview").alias("plot_summary"),
        F.concat(F.lit(POSTER_BASE), "poster_path").alias("poster_url"),
        F.concat(F.lit(BACKDROP_BASE), "backdrop_path").alias("backdrop_url"),
        "release_date",
        F.substring("release_date", 1, 4).try_cast("int").alias("year"),
        "popularity",
        F.col("vote_average").alias("tmdb_rating"),
        F.col("vote_count").alias("tmdb_votes"),
        "genre_ids",
        genre_names_from_ids(F.col("genre_ids")).alias("genres_array"),
        "original_language",
        "adult",
        "budget",
        "revenue",
        run_date(date).alias("cleaned_date"),
    )


def clean_rt_movies(movies: DataFrame, date: str | None = None) -> DataFrame:
    return movies.select(
        "rt_id",
        F.col("slug").alias("rt_slug"),
        "title",
        normalize_title(F.col("title")).alias("normalized_title"),
        "tomatometer_score",
        "audience_score",
        F.abs(F.col("tomatometer_score") - F.col("audience_score")).alias("divisive_score"),
        "mpaa_rating",
        F.col("box_office").alias("box_office_raw"),
        parse_box_office(F.col("box_office")).alias("box_office_revenue"),
        "release_date",
        "release_year",
        split_or_null(F.trim("director"), r",\s*").alias("directors"),
        split_or_null(F.trim("genre"), r",\s*").alias("genres_array"),
        F.col("genre").alias("genre_raw"),
        run_date(date).alias("cleaned_date"),
    )


def box_office_parse_flag(movies: DataFrame, column: str = "box_office") -> DataFrame:
    """Raw box office text, the parsed amount, and whether parsing worked."""
    amount = parse_box_office(F.col(column))
    return movies.select(
        "*", amount.alias("box_office_revenue"), amount.isNotNull().alias("parse_success")
    )


# Silver table -> its bronze table and the job between them.
JOBS = {
    "movielens/movies": ("movielens/movies", clean_ml_movies),
    "movielens/ratings_agg": ("movielens/ratings", aggregate_ml_ratings),
    "movielens/tags": ("movielens/tags", clean_ml_tags),
    "imdb/title_basics": ("imdb/title_basics", clean_imdb_titles),
    "imdb/title_ratings": ("imdb/title_ratings", clean_imdb_ratings),
    "imdb/name_basics": ("imdb/name_basics", clean_imdb_names),
    "imdb/title_principals": ("imdb/title_principals", clean_imdb_principals),
    "imdb/title_crew": ("imdb/title_crew", clean_imdb_crew),
    "tmdb/movies": ("tmdb/movies", clean_tmdb_movies),
    "rotten_tomatoes/movies": ("rotten_tomatoes/movies", clean_rt_movies),
}


def refine_all(spark: SparkSession, lake_root: str, date: str | None = None, ingest_day: str | None = None) -> None:
    """Refresh every silver table from the newest (or the given) ingest day of bronze."""
    for name, (source, job) in JOBS.items():
        df = job(read_day(spark, f"{lake_root}/bronze/{source}", "ingest_date", ingest_day), date)
        writers.write_table(df, f"{lake_root}/silver/{name}")
