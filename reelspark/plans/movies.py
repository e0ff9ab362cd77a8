"""Movie search and detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.operators.dedupe import top_n_per_group
from reelspark.operators.trigrams import containing, postings
from reelspark.plans.star import Star

SORT_COLUMNS = {"year": "year", "title": "title", "rating": "imdb_rating", "votes": "imdb_votes"}
LISTED = ["movie_id", "title", "year", "runtime", "poster_url", "imdb_rating", "imdb_votes", "tmdb_rating", "budget", "revenue"]
CAST_SHOWN = 20


def _matching(
    star: Star, year: int | None, genre_id: int | None, min_rating: float | None, search: str | None
) -> DataFrame:
    """Films that meet the given conditions; a condition that is not given (or 0) does not apply."""
    conditions: list[Column] = []
    if year:
        conditions.append(F.col("year") == year)
    if min_rating:
        conditions.append(F.col("imdb_rating") >= min_rating)
    if search:
        conditions.append(F.col("title").ilike(f"%{search}%"))
    films = star.films("left")
    if conditions:
        films = films.where(reduce(lambda a, b: a & b, conditions))
    if genre_id:
        of_genre = star.bridge_movie_genres.where(F.col("genre_id") == genre_id).select("movie_id")
        films = films.join(of_genre, "movie_id", "left_semi")
    return films


def movie_list(
    star: Star,
    page: int = 1,
    limit: int = 20,
    year: int | None = None,
    genre_id: int | None = None,
    min_rating: float | None = None,
    search: str | None = None,
    sort_by: str = "year",
    sort_order: str = "desc",
) -> DataFrame:
    """One page of films. Runs as a top-k of page * limit rows, not as a full sort; for far pages see ``movies_after``."""
    films = _matching(star, year, genre_id, min_rating, search).select(*LISTED)
    return films.orderBy(*_page_order(sort_by, sort_order)).offset((page - 1) * limit).limit(limit)


def _page_order(sort_by: str, sort_order: str) -> list[Column]:
    by = F.col(SORT_COLUMNS.get(sort_by, "year"))
    return [by.desc_nulls_last() if sort_order.lower() == "desc" else by.asc_nulls_last(), F.asc("movie_id")]


def movies_after(
    star: Star,
    last: tuple | None = None,
    limit: int = 20,
    year: int | None = None,
    genre_id: int | None = None,
    min_rating: float | None = None,
    search: str | None = None,
    sort_by: str = "year",
    sort_order: str = "desc",
) -> DataFrame:
    """The page after the row ``last`` = (sort value or None, movie_id), the first page without it.

    Every page is a top-k of ``limit`` rows of what the filter leaves, however far it is, where an offset sends all rows before it to one
    task. Pages in a row hold the same films as ``movie_list``."""
    films = _matching(star, year, genre_id, min_rating, search).select(*LISTED)
    if last is not None:
        by, (value, movie_id) = F.col(SORT_COLUMNS.get(sort_by, "year")), last
        if value is None:  # NULLs come last
            films = films.where(by.isNull() & (F.col("movie_id") > movie_id))
        else:
            beyond = by < F.lit(value) if sort_order.lower() == "desc" else by > F.lit(value)
            films = films.where(beyond | ((by == F.lit(value)) & (F.col("movie_id") > movie_id)) | by.isNull())
    return films.orderBy(*_page_order(sort_by, sort_order)).limit(limit)


def title_index(star: Star) -> DataFrame:
    """Postings of the films' titles for ``movies_titled``; to be stored sorted by gram and movie_id."""
    return postings(star.dim_movie, "movie_id", "title")


def movies_titled(star: Star, part: str, index: DataFrame | None = None) -> DataFrame:
    """movie_id, title, year of the films whose title holds ``part``; with a stored ``title_index`` only the postings of the part are read."""
    films = star.dim_movie.select("movie_id", "title", "year")
    return containing(films, title_index(star) if index is None else index, "movie_id", "title", part)


def movie_list_total(
    star: Star,
    year: int | None = None,
    genre_id: int | None = None,
    min_rating: float | None = None,
    search: str | None = None,
) -> DataFrame:
    """Number of films over all pages."""
    return _matching(star, year, genre_id, min_rating, search).agg(F.count("*").alias("total"))


def movie_page(star: Star, page: int = 1, limit: int = 20, **conditions) -> DataFrame:
    """A page, its films nested in ``data`` in order, with the total. A page is at most ``limit`` films."""
    filters = {k: v for k, v in conditions.items() if k in ("year", "genre_id", "min_rating", "search")}
    rows = movie_list(star, page, limit, **conditions)
    by = SORT_COLUMNS.get(conditions.get("sort_by", "year"), "year")
    descending = conditions.get("sort_order", "desc").lower() == "desc"
    data = rows.agg(F.collect_list(F.struct(*rows.columns)).alias("data"))

    def before(a: Column, b: Column) -> Column:
        x, y = a[by], b[by]
        smaller, larger = (F.lit(1), F.lit(-1)) if descending else (F.lit(-1), F.lit(1))
        tie = F.when(a["movie_id"] < b["movie_id"], -1).when(a["movie_id"] > b["movie_id"], 1).otherwise(0)
        return (
            F.when(x.isNull() & y.isNull(), tie)
            .when(x.isNull(), 1)
            .when(y.isNull(), -1)
            .when(x < y, smaller)
            .when(x > y, larger)
            .otherwise(tie)
        )

    both = data.unionByName(movie_list_total(star, **filters), allowMissingColumns=True)
    return both.agg(F.first("data", ignorenulls=True).alias("data"), F.max("total").alias("total")).select(
        F.array_sort("data", before).alias("data"), "total", F.lit(page).alias("page"), F.lit(limit).alias("limit")
    )


def movie_cast(star: Star, movie_id: int | None = None, limit: int = CAST_SHOWN) -> DataFrame:
    """The first billed people of a film, or of every film when none is named."""
    credits = star.bridge_movie_cast
    if movie_id is not None:
        credits = credits.where(F.col("movie_id") == movie_id)
    known = credits.join(star.dim_person.select("person_id", "name"), "person_id")
    shown = known.select("movie_id", "person_id", "name", "category", "ordering", "characters")
    by = [F.asc("ordering"), F.asc("person_id"), F.asc("category"), F.asc("characters")]
    if movie_id is not None:
        return shown.orderBy(*by).limit(limit)
    return top_n_per_group(shown, ["movie_id"], by, limit, "_billing").drop("_billing")


def movie_detail(star: Star, movie_id: int | None = None) -> DataFrame:
    """Films with metrics, genres and the first 20 billed people that the person dimension knows.

    The nested lists are bounded: by the genre vocabulary and by the number of people shown.
    """
    films, genres = star.films("left"), star.bridge_movie_genres
    if movie_id is not None:
        films, genres = films.where(F.col("movie_id") == movie_id), genres.where(F.col("movie_id") == movie_id)
    genre_lists = (
        genres.join(star.dim_genre, "genre_id")
        .groupBy("movie_id")
        .agg(F.array_sort(F.collect_list(F.struct("genre_id", "genre_name"))).alias("genres"))
    )
    billed = F.struct("ordering", "person_id", "name", "category", "characters")
    cast_lists = (
        movie_cast(star, movie_id).groupBy("movie_id").agg(F.array_sort(F.collect_list(billed)).alias("cast"))
    )
    return films.join(genre_lists, "movie_id", "left").join(cast_lists, "movie_id", "left")


def cast_by_role(star: Star, movie_id: int | None = None) -> DataFrame:
    """The shown cast of a film, split into actors and directors (names in billing order)."""

    def names_of(role: str) -> Column:
        billed = F.array_sort(
            F.collect_list(F.when(F.col("category") == role, F.struct("ordering", "person_id", "name")))
        )
        return F.array_join(F.transform(billed, lambda p: p["name"]), ", ")

    return (
        movie_cast(star, movie_id)
        .groupBy("movie_id")
        .agg(names_of("actor").alias("actors"), names_of("director").alias("directors"))
    )
