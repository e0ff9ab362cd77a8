"""Registered queries: every operator on the driver's whole tables.

Money thresholds are lowered to the scale of the data (budgets here reach some hundred thousand); everything else
runs on defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcheck.source_mapping import source, spine_inputs
from reelcheck.star_mapping import star_of, table
from reelspark.functions.genres import canonical_genre, genre_names_from_ids
from reelspark.functions.money import parse_box_office
from reelspark.functions.text import clean_whitespace, normalize_title, replace_null_strings
from reelspark.operators import cube, quality
from reelspark.operators.dedupe import first_per_key
from reelspark.operators.joins import union_all
from reelspark.operators.numbering import serial_key
from reelspark.operators.profile import completeness_profile, delivery_sketches, merged_profile
from reelspark.plans import (
    bronze,
    dashboard,
    finance,
    genres,
    gold,
    movies,
    overview,
    people,
    ratings,
    silver,
    spine,
    temporal,
)
from reelspark.plans import star as star_jobs
from reelspark.plans.star import Star
from reelspark.sources import pages as page_jobs

RUN_DATE = "2024-01-15"
MIN_BUDGET = 1000
PAGE_LINK = r'href="/([^"/]+)"'
PAGE_SLUG = r"^https?://[^/]+/([^?#]*)"

Query = Callable[[SparkSession, str], DataFrame]


def _on_star(job: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf_dir: job(star_of(spark, sf_dir), **options)


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, the form both engines print alike."""
    return df.withColumns({a: F.array_join(a, "|") for a in arrays})


# --- expressions ---------------------------------------------------------------------------------------------


def _replace_null_strings(spark, sf_dir):
    token = F.expr(
        r"case event_id % 7 when 0 then '\\N' when 1 then 'null' when 2 then '  ' when 3 then 'None' else event_type end"
    )
    return replace_null_strings(table(spark, sf_dir, "events").select("event_id", token.alias("event_type"), "props"))


def _clean_whitespace(spark, sf_dir):
    return clean_whitespace(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def _normalize_title(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalize_title(F.col("text")).alias("title_key"))


def _normalize_title_ascii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalize_title(F.col("text"), ascii_only=True).alias("title_key"))


def _parse_box_office(spark, sf_dir):
    rt = source(spark, sf_dir, "rt_movies")
    return rt.select(
        "slug",
        parse_box_office(F.col("box_office")).alias("amount"),
        parse_box_office(F.col("box_office"), exact=False).alias("binary_amount"),
    )


def _map_genre_ids(spark, sf_dir):
    tmdb = source(spark, sf_dir, "tmdb_movies")
    return _joined(tmdb.select("id", genre_names_from_ids(F.col("genre_ids")).alias("genre_names")), "genre_names")


def _normalize_genre(spark, sf_dir):
    spelled = union_all([gold.exploded_genres(t) for t in _with_genres(spark, sf_dir)])
    return spelled.groupBy("genre").agg(F.count("*").alias("uses")).select(
        "genre", canonical_genre(F.col("genre")).alias("genre_name"), "uses"
    )


# --- silver and gold -----------------------------------------------------------------------------------------


SILVER_JOBS = {
    "ml": ("ml_movies", silver.clean_ml_movies),
    "ml_ratings": ("ratings", silver.aggregate_ml_ratings),
    "ml_tags": ("tags", silver.clean_ml_tags),
    "imdb": ("title_basics", silver.clean_imdb_titles),
    "imdb_ratings": ("title_ratings", silver.clean_imdb_ratings),
    "imdb_names": ("name_basics", silver.clean_imdb_names),
    "imdb_principals": ("title_principals", silver.clean_imdb_principals),
    "imdb_crew": ("title_crew", silver.clean_imdb_crew),
    "tmdb": ("tmdb_movies", lambda raw, date: silver.clean_tmdb_movies(bronze.dedupe_tmdb(raw), date)),
    "rt": ("rt_movies", lambda raw, date: silver.clean_rt_movies(bronze.dedupe_rt(raw), date)),
}


def _silver(spark, sf_dir, name: str) -> DataFrame:
    raw, job = SILVER_JOBS[name]
    return job(source(spark, sf_dir, raw), RUN_DATE)


def _silver_query(name: str, *arrays: str) -> Query:
    return lambda spark, sf_dir: _joined(_silver(spark, sf_dir, name), *arrays)


def _with_genres(spark, sf_dir) -> list[DataFrame]:
    return [_silver(spark, sf_dir, t) for t in ("ml", "imdb", "tmdb", "rt")]


def _spine(spark, sf_dir, **options):
    return spine.build_entity_spine(spine_inputs(spark, sf_dir), RUN_DATE, **options)


def _ratings_agg(spark, sf_dir):
    per_film = _silver(spark, sf_dir, "ml_ratings")
    return per_film.select("ml_id", "ml_avg_rating", "ml_rating_count")


def _entity_spine(spark, sf_dir):
    return _spine(spark, sf_dir)


def _entity_spine_title_only(spark, sf_dir):
    return _spine(spark, sf_dir, require_year=False, ascii_titles=True)


def _match_exact(spark, sf_dir):
    inputs = spine_inputs(spark, sf_dir)
    return spine.match_exact(spine.core_entities(inputs), spine.rt_records(inputs.rt_movies))


def _match_fuzzy(spark, sf_dir):
    inputs = spine_inputs(spark, sf_dir)
    return spine.match_fuzzy(spine.core_entities(inputs), spine.rt_records(inputs.rt_movies))


def _orphans(spark, sf_dir):
    inputs = spine_inputs(spark, sf_dir)
    matches = spine.match_rt(spine.core_entities(inputs), spine.rt_records(inputs.rt_movies))
    return spine.orphan_entities(inputs, matches)


def _dim_genre(spark, sf_dir):
    return gold.build_dim_genre(_with_genres(spark, sf_dir))


def _unmapped_genres(spark, sf_dir):
    return gold.unmapped_genres(_with_genres(spark, sf_dir))


def _dim_person(spark, sf_dir):
    return _joined(gold.build_dim_person(_silver(spark, sf_dir, "imdb_names")), "known_for_titles")


def _dim_movie(spark, sf_dir):
    sources = [_silver(spark, sf_dir, t) for t in ("imdb", "ml", "tmdb", "rt")]
    return gold.build_dim_movie(_spine(spark, sf_dir), *sources)


def _fact(spark, sf_dir):
    sources = [_silver(spark, sf_dir, t) for t in ("ml_ratings", "imdb_ratings", "rt", "tmdb")]
    return gold.build_fact_metrics(_spine(spark, sf_dir), *sources, RUN_DATE)


def _bridge_cast(spark, sf_dir):
    known = gold.build_dim_person(_silver(spark, sf_dir, "imdb_names"))
    return gold.build_bridge_cast(_spine(spark, sf_dir), _silver(spark, sf_dir, "imdb_principals"), known)


def _bridge_genres(spark, sf_dir):
    by_key = dict(zip(("ml_id", "imdb_id", "tmdb_id", "rt_slug"), _with_genres(spark, sf_dir)))
    return gold.build_bridge_genres(_spine(spark, sf_dir), by_key, _dim_genre(spark, sf_dir))


def _dim_time(spark, sf_dir):
    return gold.build_dim_time(gold.calendar_of(table(spark, sf_dir, "orders"), "o_orderdate"))


# --- operators -----------------------------------------------------------------------------------------------


def _dedupe_by_key(spark, sf_dir):
    return first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _serial_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", "o_orderkey")
    order = [F.nullif("o_orderpriority", F.lit("1-URGENT")).asc_nulls_first(), F.asc("o_custkey"), F.asc("o_orderkey")]
    return serial_key(orders, order, "row_id")


def _enrich_box_office(spark, sf_dir):
    films = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    details = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.expr("case when min(l_linenumber) > 1 then null else sum(cast(l_quantity as bigint)) end").alias("budget"),
            F.expr("sum(cast(round(l_extendedprice) as bigint))").alias("revenue"),
        )
    )
    return bronze.enrich_box_office(films, details)


def _known_people(star: Star) -> Star:
    """The star with the person filter of the gold job, so that some credits have no person."""
    return star.replace(dim_person=star.dim_person.where(F.col("birth_year").isNotNull()))


def _titled_films(star: Star) -> Star:
    """Films without a title left out of the dimension, so that some facts are orphans."""
    return star.replace(dim_movie=star.dim_movie.where(F.col("title").isNotNull()))


def _warehouse_projection(spark, sf_dir):
    star = star_of(spark, sf_dir)
    films = star.dim_movie.select("movie_id", "title").join(star_jobs.genre_names_per_movie(star), "movie_id", "left")
    rates = star.fact_movie_metrics.select(
        "movie_id",
        F.expr("case when movie_id % 10 = 0 then double('NaN') when movie_id % 10 = 1 then double('Infinity') else imdb_rating end").alias("rating"),
        (F.col("revenue") * 100_000).alias("revenue"),
        F.col("budget").cast("double").alias("budget"),
    )
    rows = films.join(rates, "movie_id").withColumn("created_date", F.current_date())
    return star_jobs.warehouse_projection(rows, {"budget": "bigint", "revenue": "bigint"})


def _quarantine_rows(spark, sf_dir):
    star = _known_people(star_of(spark, sf_dir))
    credits = table(spark, sf_dir, "lineitem").selectExpr(
        "nullif(l_orderkey, 7) as movie_id", "l_suppkey as person_id", "l_returnflag as category"
    )
    parents = [("person_id", star.dim_person, "person_id"), ("movie_id", star.dim_movie, "movie_id")]
    return quality.judge_rows(credits, ["movie_id", "person_id"], parents)


def _language_distribution(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return overview.language_distribution(docs.select(F.col("text").alias("original_title")))


def _overview_kpis(spark, sf_dir):
    titles = table(spark, sf_dir, "documents").select(F.col("text").alias("original_title"))
    return dashboard.overview_kpis(star_of(spark, sf_dir), titles)


def _quality_by_release_month(spark, sf_dir):
    star = star_of(spark, sf_dir)
    releases = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date")
    )
    return temporal.quality_by_release_month(star, releases)


def _movie_detail(spark, sf_dir):
    detail = movies.movie_detail(star_of(spark, sf_dir))
    shown = F.transform("cast", lambda p: F.concat_ws(":", p["ordering"], p["name"], p["category"]))
    named = F.transform("genres", lambda g: F.concat_ws(":", g["genre_id"], g["genre_name"]))
    return detail.select(
        "movie_id",
        "title",
        "year",
        "imdb_rating",
        "budget",
        "revenue",
        F.array_join(named, "|").alias("genres"),
        F.array_join(shown, "|").alias("cast_shown"),
    )


def _load_manifest(spark, sf_dir):
    films = star_of(spark, sf_dir).dim_movie.select("movie_id", "title", "year")
    return star_jobs.load_manifest(films, "year", completed_at="2024-01-15T00:00:00Z")


def _olap_slice(spark, sf_dir):
    films = star_of(spark, sf_dir).films()
    kept = cube.olap_slice(films, "mpaa_rating", "5-LOW")
    return cube.cube_query(kept, ["year"], {"films": F.count("*"), "revenue": F.sum("revenue")})


def _olap_dice(spark, sf_dir):
    films = star_of(spark, sf_dir).films()
    kept = cube.olap_dice(films, {"year": (1996, 1999), "mpaa_rating": ["1-URGENT", "2-HIGH"]})
    return cube.cube_query(kept, ["year", "mpaa_rating"], {"films": F.count("*"), "revenue": F.sum("revenue")})


def _olap_rollup(spark, sf_dir):
    star = star_of(spark, sf_dir)
    days = star.fact_movie_metrics.groupBy("time_id").agg(F.count("*").alias("films"), F.sum("revenue").alias("revenue"))
    dated = days.join(star.dim_time.select("time_id", "year", "month", "day"), "time_id")
    return cube.rollup_query(dated, ["year", "month", "day"], {"films": F.sum("films"), "revenue": F.sum("revenue")})


def _completeness_profile(spark, sf_dir):
    return completeness_profile(star_of(spark, sf_dir).films("left"))


def _sketched_profile(spark, sf_dir):
    """Exact counts beside the estimates of merged yearly sketches: within five per cent of the distinct values, and a median whose rank is within 0.45..0.55."""
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("delivery"), *columns)
    profile = merged_profile(delivery_sketches(orders, "delivery"))
    exact = orders.agg(*(F.count_distinct(c).alias(c) for c in columns)).select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact_distinct")) for c in columns)))
    )
    median = profile.where("column_name = 'o_totalprice'").select("median")
    below = orders.agg(F.avg((F.col("o_totalprice") < median.scalar()).cast("double")).alias("rank"))
    near = F.abs(F.col("distinct_values") - F.col("exact_distinct")) <= 0.05 * F.col("exact_distinct")
    ranked = F.when(F.col("column_name") == "o_totalprice", below.scalar().between(0.45, 0.55))
    return profile.join(exact, "column_name").select("column_name", "total", "filled", "exact_distinct", near.alias("distinct_near"), ranked.alias("median_near"))


def _dq_uniqueness(spark, sf_dir):
    star = star_of(spark, sf_dir)
    keys = {**star_jobs.PRIMARY_KEYS, "bridge_movie_cast": ["movie_id", "person_id"]}
    return star_jobs.dq_uniqueness(star, keys)


QUERIES: dict[str, Query] = {
    # finance
    "top_revenue": _on_star(finance.top_revenue),
    "top_budget": _on_star(finance.top_budget),
    "top_profit": _on_star(finance.top_profit),
    "top_loss": _on_star(finance.top_profit, direction="worst"),
    "roi_leaderboard": _on_star(finance.roi_leaderboard, min_budget=MIN_BUDGET),
    "genre_profitability": _on_star(finance.genre_profitability, min_budget=MIN_BUDGET),
    "profitability_trend": _on_star(finance.profitability_trend),
    "budget_vs_rating": _on_star(finance.budget_vs_rating, min_budget=MIN_BUDGET),
    "star_power_roi": _on_star(finance.star_power_roi, min_budget=MIN_BUDGET),
    "value_frontier": _on_star(finance.value_frontier),
    # overview
    "movies_per_year": _on_star(overview.movies_per_year),
    "top_popular": _on_star(overview.top_popular),
    "language_distribution": _language_distribution,
    # ratings
    "rating_distribution": _on_star(ratings.rating_distribution),
    "platform_comparison": _on_star(ratings.platform_comparison),
    "cult_classics": _on_star(ratings.cult_classics),
    "runtime_vs_rating": _on_star(ratings.runtime_vs_rating),
    "divisive_movies": _on_star(ratings.divisive_movies),
    # genres
    "genre_share_by_decade": _on_star(genres.genre_share_by_decade),
    "genre_average_rating": _on_star(genres.genre_average_rating),
    "genre_cooccurrence": _on_star(genres.genre_cooccurrence),
    "genre_list": _on_star(genres.genre_list),
    "top_by_genre": _on_star(genres.top_by_genre),
    # people
    "top_prolific": _on_star(people.top_prolific),
    "top_rated": _on_star(people.top_rated),
    "person_rating_history": _on_star(people.rating_history),
    "actor_network": _on_star(people.actor_network),
    "actor_network_crowded": _on_star(people.actor_network, crowd=3),
    "person_detail": _on_star(people.person_detail),
    "person_summary": _on_star(people.person_summary),
    # temporal
    "runtime_trend": _on_star(temporal.runtime_trend),
    "quality_by_month": _on_star(temporal.quality_by_month),
    "quality_by_release_month": _quality_by_release_month,
    "mpaa_distribution": _on_star(temporal.mpaa_distribution),
    "mpaa_trend": _on_star(temporal.mpaa_trend),
    # movies and views
    "movie_list": _on_star(movies.movie_list, page=2, sort_by="rating"),
    "movie_list_filtered": _on_star(
        movies.movie_list, year=1997, genre_id=3, min_rating=4.0, search="RING", sort_by="votes", sort_order="asc"
    ),
    "movies_after": _on_star(movies.movies_after, last=(4.0, 700), sort_by="rating"),
    "movies_titled": _on_star(movies.movies_titled, part="Ring"),
    "movie_list_total": _on_star(movies.movie_list_total, min_rating=4.0, search="ring"),
    "movie_detail": _movie_detail,
    "cast_by_role": _on_star(movies.cast_by_role),
    "v_movie_full": _on_star(star_jobs.v_movie_full),
    "v_movie_genres": _on_star(star_jobs.v_movie_genres),
    "v_movie_cast": _on_star(star_jobs.v_movie_cast),
    # dashboard
    "genre_shares": _on_star(dashboard.genre_shares),
    "genre_share_pivot": _on_star(dashboard.genre_share_pivot),
    "overview_kpis": _overview_kpis,
    "platform_normalized": _on_star(dashboard.platform_normalized),
    "genre_cooccurrence_matrix": _on_star(dashboard.genre_cooccurrence_matrix),
    "genre_rating_top15": _on_star(dashboard.genre_rating_top),
    "genre_roi_iqr": _on_star(dashboard.genre_roi_iqr, min_budget=MIN_BUDGET),
    "roi_tier": _on_star(dashboard.roi_tier, min_budget=MIN_BUDGET),
    "value_tier": _on_star(dashboard.value_tier),
    "actor_pairs_labelled": _on_star(dashboard.actor_pairs_labelled),
    "mpaa_top5": _on_star(dashboard.mpaa_top),
    # expressions
    "replace_null_strings": _replace_null_strings,
    "clean_whitespace": _clean_whitespace,
    "normalize_title": _normalize_title,
    "normalize_title_ascii": _normalize_title_ascii,
    "parse_box_office": _parse_box_office,
    "box_office_parse_flag": lambda spark, sf_dir: silver.box_office_parse_flag(
        source(spark, sf_dir, "rt_movies").select("slug", "box_office")
    ),
    "map_genre_ids": _map_genre_ids,
    "normalize_genre": _normalize_genre,
    # silver
    "clean_movies": _silver_query("ml", "genres_array"),
    "ratings_agg": _ratings_agg,
    "clean_tags": _silver_query("ml_tags"),
    "clean_imdb_titles": _silver_query("imdb", "genres_array"),
    "clean_imdb_ratings": _silver_query("imdb_ratings"),
    "clean_imdb_names": _silver_query("imdb_names", "known_for_titles"),
    "clean_imdb_principals": _silver_query("imdb_principals"),
    "clean_imdb_crew": _silver_query("imdb_crew", "directors", "writers"),
    "clean_tmdb_movies": lambda spark, sf_dir: _joined(_silver(spark, sf_dir, "tmdb"), "genres_array").drop("genre_ids"),
    "clean_rt_movies": _silver_query("rt", "directors", "genres_array"),
    # entity resolution
    "entity_spine": _entity_spine,
    "entity_spine_title_only": _entity_spine_title_only,
    "match_exact": _match_exact,
    "match_fuzzy": _match_fuzzy,
    "orphans": _orphans,
    # gold
    "dim_time": _dim_time,
    "dim_genre": _dim_genre,
    "unmapped_genres": _unmapped_genres,
    "dim_person": _dim_person,
    "dim_movie": _dim_movie,
    "fact_metrics": lambda spark, sf_dir: _fact(spark, sf_dir).drop("metric_id"),
    "fact_metric_ids": lambda spark, sf_dir: _fact(spark, sf_dir).select("movie_id", "metric_id"),
    "bridge_cast": _bridge_cast,
    "bridge_genres": _bridge_genres,
    # operators, load and checks
    "dedupe_by_key": _dedupe_by_key,
    "serial_key": _serial_key,
    "enrich_box_office": _enrich_box_office,
    "completeness_profile": _completeness_profile,
    "sketched_profile": _sketched_profile,
    "warehouse_projection": _warehouse_projection,
    "quarantine_rows": _quarantine_rows,
    "load_manifest": _load_manifest,
    "validate_load": lambda spark, sf_dir: star_jobs.validate_load(_titled_films(star_of(spark, sf_dir))),
    "orphan_facts": lambda spark, sf_dir: star_jobs.orphan_facts(_titled_films(star_of(spark, sf_dir))),
    "dq_uniqueness": _dq_uniqueness,
    "dq_referential": lambda spark, sf_dir: star_jobs.dq_referential(_known_people(star_of(spark, sf_dir))),
    "dq_range": _on_star(star_jobs.dq_range),
    "dq_has_id": _on_star(star_jobs.dq_has_id),
    "constraint_report": lambda spark, sf_dir: star_jobs.constraint_report(_known_people(star_of(spark, sf_dir))),
    "olap_slice": _olap_slice,
    "olap_dice": _olap_dice,
    "olap_rollup": _olap_rollup,
    # pages
    "discover_links": lambda spark, sf_dir: page_jobs.discover_links(table(spark, sf_dir, "pages"), PAGE_LINK),
    "extract_pages": lambda spark, sf_dir: page_jobs.extract_movies(
        table(spark, sf_dir, "pages"), PAGE_SLUG, scraped_at="2024-01-15T00:00:00Z"
    ),
}
