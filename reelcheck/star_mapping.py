"""Driver tables -> star schema.

orders become films and facts, lineitem the credits and genres, supplier the people, part brands the genre
vocabulary. Sums are taken over whole numbers, so both engines get the same values whatever the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.operators.numbering import dense_key_of_names
from reelspark.plans import gold
from reelspark.plans.star import Star


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star_of(spark: SparkSession, sf_dir: str) -> Star:
    read = cache(partial(table, spark, sf_dir))
    genre_names = cache(partial(_genre_dimension, read))
    films = cache(partial(_films, read))
    return Star(
        dim_time=lambda: gold.build_dim_time(gold.calendar_of(read("orders"), "o_orderdate")),
        dim_genre=genre_names,
        dim_person=lambda: read("supplier").selectExpr(
            "s_suppkey as person_id",
            "s_name as name",
            "case when s_acctbal < 0 then null else 1900 + s_nationkey end as birth_year",
        ),
        dim_movie=lambda: films().selectExpr(
            "o_orderkey as movie_id",
            "concat('tt', o_orderkey) as imdb_id",
            "cast(o_custkey as int) as tmdb_id",
            "cast(null as int) as ml_id",
            "cast(null as string) as rt_slug",
            "nm as title",
            "nm as original_title",
            "year(o_orderdate) as year",
            "cast(q as int) as runtime",
            "nullif(o_orderpriority, '4-NOT SPECIFIED') as mpaa_rating",
            "concat('Order of customer ', o_custkey) as plot_summary",
            "concat('/poster/', o_orderkey) as poster_url",
            "concat('/backdrop/', o_orderkey) as backdrop_url",
            "0 as is_adult",
            "cast(x as double) as popularity",
        ),
        fact_movie_metrics=lambda: films().selectExpr(
            "o_orderkey as metric_id",
            "o_orderkey as movie_id",
            "cast(date_format(o_orderdate, 'yyyyMMdd') as int) as time_id",
            "round(cast(x as double) / n / 2, 2) as ml_avg_rating",
            "n as ml_rating_count",
            "cast(d as double) / n as imdb_rating",
            "q * 50 as imdb_votes",
            "cast(x as double) / n as tmdb_rating",
            "n as tmdb_votes",
            "cast(x as double) as tmdb_popularity",
            f"{_TOMATO} as tomatometer_score",
            f"{_AUDIENCE} as audience_score",
            f"abs({_TOMATO} - {_AUDIENCE}) as divisive_score",
            "ext as budget",
            "case when o_orderstatus = 'P' then 0 else cast(round(o_totalprice) as bigint) end as revenue",
        ),
        bridge_movie_cast=lambda: read("lineitem")
        .selectExpr(
            "l_orderkey as movie_id",
            "l_suppkey as person_id",
            "case l_returnflag when 'A' then 'actor' when 'N' then 'director' else 'writer' end as category",
            "l_linenumber as ordering",
            "concat('part ', l_partkey) as characters",
        )
        .distinct(),
        bridge_movie_genres=lambda: _lines_with_parts(read)
        .select(F.col("l_orderkey").alias("movie_id"), F.col("p_brand").alias("genre_name"))
        .distinct()
        .join(genre_names(), "genre_name")
        .select("movie_id", "genre_id"),
    )


_TOMATO = "case when o_custkey % 5 = 0 then null else cast(o_custkey % 101 as int) end"
_AUDIENCE = "case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 101 as int) end"

Read = Callable[[str], DataFrame]


def _genre_dimension(read: Read) -> DataFrame:
    return dense_key_of_names(read("part").select(F.col("p_brand").alias("genre_name")), "genre_name", "genre_id")


def _lines_with_parts(read: Read) -> DataFrame:
    parts = read("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return read("lineitem").join(parts, "l_partkey")


def _films(read: Read) -> DataFrame:
    per_order = _lines_with_parts(read).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.expr("sum(cast(l_quantity as bigint))").alias("q"),
        F.expr("sum(cast(round(l_extendedprice) as bigint))").alias("ext"),
        F.expr("sum(cast(round(l_discount * 100) as bigint))").alias("d"),
        F.expr("sum(cast(round(l_tax * 100) as bigint))").alias("x"),
        F.count("*").alias("n"),
        F.min("p_name").alias("nm"),
    )
    return read("orders").join(per_order, "o_orderkey", "left")


STAR_SQL = """
li AS (SELECT l_orderkey AS k, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
   CAST(SUM(CAST(ROUND(l_extendedprice) AS BIGINT)) AS BIGINT) AS ext,
   CAST(SUM(CAST(ROUND(l_discount*100) AS BIGINT)) AS BIGINT) AS d,
   CAST(SUM(CAST(ROUND(l_tax*100) AS BIGINT)) AS BIGINT) AS x, COUNT(*) AS n, MIN(p_name) AS nm
   FROM lineitem JOIN part ON l_partkey=p_partkey GROUP BY l_orderkey),
dim_movie AS (SELECT o_orderkey AS movie_id, 'tt'||o_orderkey AS imdb_id, CAST(o_custkey AS INT) AS tmdb_id,
   CAST(NULL AS INT) AS ml_id, CAST(NULL AS VARCHAR) AS rt_slug, nm AS title, nm AS original_title,
   CAST(YEAR(o_orderdate) AS INT) AS year, CAST(q AS INT) AS runtime,
   NULLIF(o_orderpriority,'4-NOT SPECIFIED') AS mpaa_rating, 'Order of customer '||o_custkey AS plot_summary,
   '/poster/'||o_orderkey AS poster_url, '/backdrop/'||o_orderkey AS backdrop_url, 0 AS is_adult,
   CAST(x AS DOUBLE) AS popularity
   FROM orders LEFT JOIN li ON k=o_orderkey),
fact0 AS (SELECT o_orderkey AS metric_id, o_orderkey AS movie_id,
   CAST(YEAR(o_orderdate)*10000+MONTH(o_orderdate)*100+DAY(o_orderdate) AS INT) AS time_id,
   ROUND(CAST(x AS DOUBLE)/n/2,2) AS ml_avg_rating, n AS ml_rating_count, CAST(d AS DOUBLE)/n AS imdb_rating,
   q*50 AS imdb_votes, CAST(x AS DOUBLE)/n AS tmdb_rating, n AS tmdb_votes, CAST(x AS DOUBLE) AS tmdb_popularity,
   CASE WHEN o_custkey%5=0 THEN NULL ELSE CAST(o_custkey%101 AS INT) END AS tomatometer_score,
   CASE WHEN o_orderkey%7=0 THEN NULL ELSE CAST(o_orderkey%101 AS INT) END AS audience_score,
   ext AS budget, CASE WHEN o_orderstatus='P' THEN 0 ELSE CAST(ROUND(o_totalprice) AS BIGINT) END AS revenue
   FROM orders LEFT JOIN li ON k=o_orderkey),
fact_movie_metrics AS (SELECT *, ABS(tomatometer_score-audience_score) AS divisive_score FROM fact0),
dim_person AS (SELECT s_suppkey AS person_id, s_name AS name,
   CASE WHEN s_acctbal<0 THEN NULL ELSE 1900+s_nationkey END AS birth_year FROM supplier),
bridge_movie_cast AS (SELECT DISTINCT l_orderkey AS movie_id, l_suppkey AS person_id,
   CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'N' THEN 'director' ELSE 'writer' END AS category,
   l_linenumber AS ordering, 'part '||l_partkey AS characters FROM lineitem),
dim_genre AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_brand) AS INT) AS genre_id, p_brand AS genre_name
   FROM (SELECT DISTINCT p_brand FROM part) z),
bridge_movie_genres AS (SELECT DISTINCT l_orderkey AS movie_id, genre_id
   FROM lineitem JOIN part ON l_partkey=p_partkey JOIN dim_genre ON genre_name=p_brand),
dim_time AS (SELECT CAST(strftime(date,'%Y%m%d') AS INT) AS time_id, date, CAST(YEAR(date) AS INT) AS year,
   CAST(QUARTER(date) AS INT) AS quarter, CAST(MONTH(date) AS INT) AS month, CAST(DAY(date) AS INT) AS day,
   CAST(DAYOFWEEK(date)+1 AS INT) AS day_of_week, CAST(DAYOFYEAR(date) AS INT) AS day_of_year,
   CAST(WEEKOFYEAR(date) AS INT) AS week_of_year
   FROM (SELECT CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
         FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS b FROM orders) s) t),
films AS (SELECT m.*, f.* EXCLUDE (metric_id, movie_id, time_id)
   FROM dim_movie m JOIN fact_movie_metrics f ON m.movie_id=f.movie_id)
"""
