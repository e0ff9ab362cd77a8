"""Raw files -> bronze tables: declared schema, one row per source key, audit date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.operators.dedupe import first_per_key
from reelspark.sources import readers, schemas, writers

# Chunk files as they are delivered, and as the sink of this library names them.
CHUNKS = "{movies_*.ndjson,part-*.json}"


def _dated(df: DataFrame, date: str | None) -> DataFrame:
    return df.withColumn("ingest_date", readers.run_date(date))


def read_movielens(spark: SparkSession, folder: str, date: str | None = None) -> dict[str, DataFrame]:
    return {
        name: _dated(readers.read_csv(spark, f"{folder}/{name}.csv", schema), date)
        for name, schema in schemas.MOVIELENS.items()
    }


def read_imdb(spark: SparkSession, folder: str, date: str | None = None) -> dict[str, DataFrame]:
    return {
        name.replace(".", "_"): _dated(readers.read_tsv(spark, f"{folder}/{name}.tsv*", schema), date)
        for name, schema in schemas.IMDB.items()
    }


def dedupe_tmdb(movies: DataFrame) -> DataFrame:
    """The same film may sit in several chunk files: one row per id."""
    return first_per_key(movies, ["id"])


def read_tmdb(spark: SparkSession, folder: str, date: str | None = None) -> DataFrame:
    raw = readers.read_ndjson(spark, f"{folder}/{CHUNKS}", schemas.TMDB_MOVIES)
    return _dated(dedupe_tmdb(raw), date)


def dedupe_rt(movies: DataFrame, key: str = "slug") -> DataFrame:
    """One row per slug. ``key='rt_id'`` also merges remakes, whose slugs differ in the year only."""
    return first_per_key(movies, [key])


def read_rotten_tomatoes(
    spark: SparkSession, folder: str, date: str | None = None, key: str = "slug"
) -> DataFrame:
    raw = readers.read_ndjson(spark, f"{folder}/{CHUNKS}", schemas.RT_MOVIES)
    return _dated(dedupe_rt(raw, key), date)


def ingest_all(spark: SparkSession, raw_root: str, lake_root: str, date: str | None = None) -> None:
    """Land the newest (or the dated) delivery of every source in ``<lake_root>/bronze``, partitioned by ingest day: a rerun replaces its
    own day, earlier days stay."""

    def folder(source: str) -> str:
        return readers.input_folder(spark, f"{raw_root}/{source}", date)

    for name, df in read_movielens(spark, folder("movielens"), date).items():
        writers.write_days(df, f"{lake_root}/bronze/movielens/{name}", "ingest_date")
    for name, df in read_imdb(spark, folder("imdb"), date).items():
        writers.write_days(df, f"{lake_root}/bronze/imdb/{name}", "ingest_date")
    writers.write_days(read_tmdb(spark, folder("tmdb"), date), f"{lake_root}/bronze/tmdb/movies", "ingest_date")
    rt = read_rotten_tomatoes(spark, folder("rotten_tomatoes"), date)
    writers.write_days(rt, f"{lake_root}/bronze/rotten_tomatoes/movies", "ingest_date")


def enrich_box_office(movies: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """Attach budget and revenue. A film without details keeps NULL money; money missing in its details is 0; of
    several details of a film the smallest row is taken."""
    money = ["budget", "revenue"]
    found = details.select(key, *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in money])
    return movies.drop(*money).join(first_per_key(found.where(F.col(key).isNotNull()), [key]), key, "left")
