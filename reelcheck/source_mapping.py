"""Driver tables -> the raw source tables, to run the silver and gold jobs and the matcher on whole tables.

part holds the MovieLens films, links and Rotten Tomatoes records (few different titles, so many films share one),
customer the TMDB films, orders the IMDb titles, lineitem the IMDb credits, supplier the IMDb people, events the
ratings and tags. Links point at every third customer and every twentieth order number, at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelcheck.star_mapping import table
from reelspark.plans.spine import SpineInputs

# Each mapping is one list of expressions that both engines read the same way.
ML_MOVIES = (
    "part",
    [
        "CAST(p_partkey AS INT) AS movieId",
        "CASE WHEN p_partkey % 9 = 0 THEN p_name ELSE concat(p_name, ' (', CAST(1950 + p_size AS VARCHAR(9)), ')') END AS title",
        "CASE WHEN p_partkey % 10 = 0 THEN '(no genres listed)' ELSE concat(p_type, '|', p_brand) END AS genres",
    ],
)
LINKS = (
    "part",
    [
        "CAST(p_partkey AS INT) AS movieId",
        "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_partkey * 20 AS VARCHAR(20)) END AS imdbId",
        "CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_partkey * 3 AS INT) END AS tmdbId",
    ],
)
RT_MOVIES = (
    "part",
    [
        "concat('s', CAST(p_partkey AS VARCHAR(20))) AS rt_id",
        "concat('s', CAST(p_partkey AS VARCHAR(20)), '_', CAST(1950 + (p_size * 7) % 50 AS VARCHAR(9))) AS slug",
        "concat(' ', upper(p_name), '!') AS title",
        "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size * 2 AS INT) END AS tomatometer_score",
        "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(100 - p_size AS INT) END AS audience_score",
        "CASE WHEN p_partkey % 3 = 0 THEN 'PG-13' WHEN p_partkey % 3 = 1 THEN 'R' ELSE NULL END AS mpaa_rating",
        "CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN '' "
        "WHEN p_partkey % 4 = 0 THEN concat('$', CAST(p_size AS VARCHAR(9)), '.2M') "
        "WHEN p_partkey % 4 = 1 THEN concat('$', CAST(p_size AS VARCHAR(9)), 'K') "
        "WHEN p_partkey % 4 = 2 THEN concat('$1.', CAST(p_size AS VARCHAR(9)), 'b') "
        "ELSE concat(' $', CAST(p_size AS VARCHAR(9)), ',250,000 ') END AS box_office",
        "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE concat('Opened ', CAST(1950 + p_size AS VARCHAR(9))) END AS release_date",
        "CAST(1950 + (p_size * 7) % 50 AS INT) AS release_year",
        "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat(p_brand, ',  ', p_type) END AS director",
        "CASE WHEN p_partkey % 5 = 1 THEN 'sci-fi, Kids & Family' WHEN p_partkey % 5 = 2 THEN 'reality-tv' "
        "WHEN p_partkey % 5 = 3 THEN NULL ELSE concat(lower(p_type), ',Musical') END AS genre",
        "'' AS scraped_at",
    ],
)
RATINGS = (
    "events",
    [
        "CAST(event_id AS INT) AS userId",
        "CAST(user_id AS INT) AS movieId",
        "value AS rating",
        "event_id AS timestamp",
    ],
)
TAGS = (
    "events",
    [
        "CAST(user_id AS INT) AS userId",
        "CAST(user_id AS INT) AS movieId",
        "CASE event_id % 7 WHEN 0 THEN '   ' WHEN 1 THEN NULL ELSE concat('  ', event_type, ' ') END AS tag",
        "event_id AS timestamp",
    ],
)
TITLE_BASICS = (
    "orders",
    [
        "concat('tt', CASE WHEN length(CAST(o_orderkey AS VARCHAR(20))) < 7 THEN lpad(CAST(o_orderkey AS VARCHAR(20)), 7, '0') "
        "ELSE CAST(o_orderkey AS VARCHAR(20)) END) AS tconst",
        "CASE o_orderstatus WHEN 'P' THEN 'tvSeries' ELSE 'movie' END AS titleType",
        "concat(' Order ', o_orderpriority, ' ') AS primaryTitle",
        "concat('Orden ', o_orderpriority) AS originalTitle",
        "'0' AS isAdult",
        "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR(9)) END AS startYear",
        "CASE WHEN o_custkey % 8 = 0 THEN 'n/a' ELSE CAST(60 + o_orderkey % 90 AS VARCHAR(20)) END AS runtimeMinutes",
        "CASE WHEN o_custkey % 6 = 0 THEN '' WHEN o_custkey % 6 = 1 THEN 'Drama,Film-Noir' ELSE 'Comedy,War,Musical' END AS genres",
    ],
)
TITLE_RATINGS = (
    "orders",
    [
        "concat('tt', CASE WHEN length(CAST(o_orderkey AS VARCHAR(20))) < 7 THEN lpad(CAST(o_orderkey AS VARCHAR(20)), 7, '0') "
        "ELSE CAST(o_orderkey AS VARCHAR(20)) END) AS tconst",
        "concat(CAST(o_orderkey % 10 AS VARCHAR(20)), '.', CAST(o_custkey % 10 AS VARCHAR(20))) AS averageRating",
        "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey * 3 AS VARCHAR(20)) END AS numVotes",
    ],
)
NAME_BASICS = (
    "supplier",
    [
        "concat('nm', CAST(s_suppkey AS VARCHAR(20))) AS nconst",
        "concat(' ', s_name, ' ') AS primaryName",
        "CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(1900 + s_nationkey AS VARCHAR(9)) END AS birthYear",
        "CASE WHEN s_nationkey % 2 = 0 THEN NULL ELSE CAST(1980 + s_nationkey AS VARCHAR(9)) END AS deathYear",
        "CASE WHEN s_nationkey % 3 = 0 THEN 'actor,director' ELSE 'writer' END AS primaryProfession",
        "concat('tt', CAST(s_suppkey AS VARCHAR(20)), ',tt', CAST(s_nationkey AS VARCHAR(9))) AS knownForTitles",
    ],
)
TITLE_PRINCIPALS = (
    "lineitem",
    [
        "concat('tt', CASE WHEN length(CAST(l_orderkey AS VARCHAR(20))) < 7 THEN lpad(CAST(l_orderkey AS VARCHAR(20)), 7, '0') "
        "ELSE CAST(l_orderkey AS VARCHAR(20)) END) AS tconst",
        "CAST(l_linenumber AS VARCHAR(9)) AS ordering",
        "concat('nm', CAST(l_suppkey AS VARCHAR(20))) AS nconst",
        "CASE l_returnflag WHEN 'A' THEN ' actor' WHEN 'N' THEN 'director ' ELSE 'writer' END AS category",
        "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE concat(' job ', l_linestatus) END AS job",
        "concat('[\"part ', CAST(l_partkey AS VARCHAR(20)), '\"]') AS characters",
    ],
)
TITLE_CREW = (
    "orders",
    [
        "concat('tt', CAST(o_orderkey AS VARCHAR(20))) AS tconst",
        "CASE WHEN o_custkey % 4 = 0 THEN '' ELSE concat('nm', CAST(o_custkey AS VARCHAR(20)), ',nm', CAST(o_custkey + 1 AS VARCHAR(20))) END AS directors",
        "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE concat('nm', CAST(o_custkey AS VARCHAR(20))) END AS writers",
    ],
)
TMDB_MOVIES = (
    "customer",
    [
        "CAST(c_custkey AS INT) AS id",
        "concat(c_mktsegment, ' ', CAST(c_nationkey AS VARCHAR(9))) AS title",
        "c_name AS original_title",
        "concat('About ', c_name) AS overview",
        "CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE concat('/', c_name, '.jpg') END AS poster_path",
        "CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE concat('/', c_name, '.png') END AS backdrop_path",
        "CASE WHEN c_nationkey % 6 = 0 THEN '' ELSE concat(CAST(1960 + c_nationkey AS VARCHAR(9)), '-06-1', CAST(c_nationkey % 10 AS VARCHAR(9))) END AS release_date",
        "round(abs(c_acctbal) / 100, 1) AS popularity",
        "CAST(c_nationkey % 10 AS DOUBLE) AS vote_average",
        "CAST(c_custkey % 5000 AS INT) AS vote_count",
        "CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE array(28, 12 + 4 * (c_nationkey % 2), 99900 + c_nationkey % 3) END AS genre_ids",
        "CASE WHEN c_nationkey % 3 = 0 THEN 'fr' ELSE 'en' END AS original_language",
        "false AS adult",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(round(c_acctbal) AS BIGINT) * 1000 END AS budget",
        "CAST(c_custkey AS BIGINT) * 3000000 AS revenue",
        "false AS video",
    ],
)
SOURCES = {
    "ml_movies": ML_MOVIES,
    "links": LINKS,
    "rt_movies": RT_MOVIES,
    "ratings": RATINGS,
    "tags": TAGS,
    "title_basics": TITLE_BASICS,
    "title_ratings": TITLE_RATINGS,
    "name_basics": NAME_BASICS,
    "title_principals": TITLE_PRINCIPALS,
    "title_crew": TITLE_CREW,
    "tmdb_movies": TMDB_MOVIES,
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, expressions = SOURCES[name]
    return table(spark, sf_dir, base).selectExpr(*expressions)


def spine_inputs(spark: SparkSession, sf_dir: str) -> SpineInputs:
    return SpineInputs(
        *[source(spark, sf_dir, n) for n in ["links", "ml_movies", "tmdb_movies", "title_basics", "rt_movies"]]
    )


def source_sql(name: str) -> str:
    """The same mapping for DuckDB, whose array literal and integer division are spelled differently."""
    base, expressions = SOURCES[name]
    columns = ", ".join(expressions).replace("array(", "list_value(")
    return f"{name} AS (SELECT {columns} FROM {base})"
