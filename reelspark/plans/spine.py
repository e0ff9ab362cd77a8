"""Entity resolution: one row per film over four sources.

Id links come first, then Rotten Tomatoes records are matched by title. Within one title (and year) the matching rule
always settles on the smallest slug and the smallest MovieLens id, so it is computed from minima per title key and
never from the pairs of all records that share a title. A title that a third of the records carry costs no more
than any other.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions.text import normalize_title, pad_imdb_id, strip_year_suffix, year_suffix
from reelspark.operators.joins import left_join_sparse, union_all
from reelspark.operators.numbering import lazy_serial_key, serial_key
from reelspark.session import cut_lineage
from reelspark.sources import writers
from reelspark.sources.readers import read_day, run_date

SPINE_IDS = {"ml_id": "int", "imdb_id": "string", "tmdb_id": "int", "rt_slug": "string", "rt_match_method": "string"}
EXACT, FUZZY, UNMATCHED = "title_year_exact", "title_year_fuzzy", "unmatched"


class SpineInputs(NamedTuple):
    links: DataFrame
    ml_movies: DataFrame
    tmdb_movies: DataFrame
    title_basics: DataFrame
    rt_movies: DataFrame


def linked_ids(links: DataFrame) -> DataFrame:
    return links.select(
        F.col("movieId").alias("ml_id"), pad_imdb_id(F.col("imdbId")).alias("imdb_id"), F.col("tmdbId").alias("tmdb_id")
    )


def _imdb_films(title_basics: DataFrame) -> DataFrame:
    return title_basics.where(F.col("titleType") == "movie").select(
        F.col("tconst").alias("imdb_id"),
        F.col("primaryTitle").alias("imdb_title"),
        F.col("startYear").try_cast("int").alias("imdb_year"),
    )


def core_entities(inputs: SpineInputs, ascii_titles: bool = False) -> DataFrame:
    """Linked records with their canonical title key and year (TMDB, else IMDb, else MovieLens)."""
    ml = inputs.ml_movies.select(
        F.col("movieId").alias("ml_id"),
        strip_year_suffix(F.col("title")).alias("ml_title"),
        year_suffix(F.col("title")).alias("ml_year"),
    )
    tmdb = inputs.tmdb_movies.select(
        F.col("id").alias("tmdb_id"),
        F.col("title").alias("tmdb_title"),
        F.year(F.try_to_date("release_date", "yyyy-MM-dd")).alias("tmdb_year"),
    )
    joined = linked_ids(inputs.links).join(ml, "ml_id", "left")
    joined = left_join_sparse(joined, tmdb, "tmdb_id", ["ml_id"])
    joined = left_join_sparse(joined, _imdb_films(inputs.title_basics), "imdb_id", ["ml_id"])
    title = F.coalesce("tmdb_title", "imdb_title", "ml_title")
    return joined.select(
        "ml_id",
        "imdb_id",
        "tmdb_id",
        normalize_title(title, ascii_titles).alias("title_key"),
        F.coalesce("tmdb_year", "imdb_year", "ml_year").alias("year"),
    )


def rt_records(rt_movies: DataFrame, ascii_titles: bool = False) -> DataFrame:
    return rt_movies.select(
        F.col("slug").alias("rt_slug"),
        normalize_title(F.col("title"), ascii_titles).alias("title_key"),
        F.col("release_year").alias("year"),
    )


def match_exact(core: DataFrame, rt: DataFrame, require_year: bool = True) -> DataFrame:
    """(ml_id, rt_slug) of equal title and, unless switched off, equal year: each side at most once."""
    on = ["title_key", "year"] if require_year else ["title_key"]
    left = core.groupBy(*on).agg(F.min("ml_id").alias("ml_id"))
    right = rt.groupBy(*on).agg(F.min("rt_slug").alias("rt_slug"))
    return left.join(right, on).select("ml_id", "rt_slug")


def match_fuzzy(core: DataFrame, rt: DataFrame) -> DataFrame:
    """(ml_id, rt_slug) of equal title and a year at most one apart.

    A film takes the smallest slug in reach, then a slug takes the smallest film that chose it. The year band is
    an equi join: each Rotten Tomatoes year offers its slug to the year before, its own and the year after.
    """
    offered = rt.groupBy("title_key", "year").agg(F.min("rt_slug").alias("rt_slug"))
    offered = offered.select("title_key", "rt_slug", F.explode(F.expr("sequence(year - 1, year + 1)")).alias("year"))
    in_reach = offered.groupBy("title_key", "year").agg(F.min("rt_slug").alias("rt_slug"))
    films = core.groupBy("title_key", "year").agg(F.min("ml_id").alias("ml_id"))
    chosen = films.join(in_reach, ["title_key", "year"])
    return chosen.groupBy("rt_slug").agg(F.min("ml_id").alias("ml_id")).select("ml_id", "rt_slug")


def match_rt(core: DataFrame, rt: DataFrame, require_year: bool = True) -> DataFrame:
    """Both passes: exact first, then the fuzzy one among what is left."""
    exact = match_exact(core, rt, require_year)
    fuzzy = match_fuzzy(
        core.join(exact.select("ml_id"), "ml_id", "left_anti"), rt.join(exact.select("rt_slug"), "rt_slug", "left_anti")
    )
    return exact.withColumn("rt_match_method", F.lit(EXACT)).unionByName(
        fuzzy.withColumn("rt_match_method", F.lit(FUZZY))
    )


def _as_spine(df: DataFrame, **known: Column) -> DataFrame:
    return df.select(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in SPINE_IDS.items()])


def orphan_entities(inputs: SpineInputs, matches: DataFrame) -> DataFrame:
    """TMDB and IMDb records without a link, Rotten Tomatoes records without a match."""
    links = linked_ids(inputs.links)
    tmdb = inputs.tmdb_movies.select(F.col("id").alias("tmdb_id")).join(links, "tmdb_id", "left_anti")
    imdb = _imdb_films(inputs.title_basics).join(links, "imdb_id", "left_anti")
    rt = inputs.rt_movies.select(F.col("slug").alias("rt_slug")).join(matches, "rt_slug", "left_anti")
    return union_all(
        [
            _as_spine(tmdb, tmdb_id=F.col("tmdb_id")),
            _as_spine(imdb, imdb_id=F.col("imdb_id")),
            _as_spine(rt, rt_slug=F.col("rt_slug"), rt_match_method=F.lit(UNMATCHED)),
        ]
    )


def spine_order() -> list[Column]:
    """IMDb records first, then TMDB, then MovieLens, then the rest; by id within each."""
    has = F.when(F.col("imdb_id").isNotNull(), 0).when(F.col("tmdb_id").isNotNull(), 1)
    return [
        has.when(F.col("ml_id").isNotNull(), 2).otherwise(3),
        *[F.col(c) for c in ["imdb_id", "tmdb_id", "ml_id", "rt_slug"]],
    ]


def build_entity_spine(
    inputs: SpineInputs, date: str | None = None, require_year: bool = True, ascii_titles: bool = False, lazy: bool = False
) -> DataFrame:
    """``require_year=False`` with ``ascii_titles=True`` matches by ASCII title alone in the first pass. ``lazy=True`` runs no job while
    the plan is built and numbers by splitters; it computes the joins anew for each reader instead of storing them."""
    core = core_entities(inputs, ascii_titles)
    # Narrow, and read by the match passes as well as by the final join: stored once.
    core = core if lazy else cut_lineage(core)
    matches = match_rt(core, rt_records(inputs.rt_movies, ascii_titles), require_year)
    matched = core.join(matches, "ml_id", "left").select(*SPINE_IDS)
    entities = matched.unionByName(orphan_entities(inputs, matches))
    number = lazy_serial_key if lazy else serial_key
    return number(entities, spine_order(), "movie_id").withColumn("created_date", run_date(date))


def resolve_all(spark: SparkSession, lake_root: str, date: str | None = None, ingest_day: str | None = None, **options) -> None:
    """Refresh the silver entity spine from the newest (or the given) ingest day of bronze."""
    tables = ["movielens/links", "movielens/movies", "tmdb/movies", "imdb/title_basics", "rotten_tomatoes/movies"]
    inputs = SpineInputs(*[read_day(spark, f"{lake_root}/bronze/{t}", "ingest_date", ingest_day) for t in tables])
    writers.write_table(build_entity_spine(inputs, date, **options), f"{lake_root}/silver/entity_spine")
