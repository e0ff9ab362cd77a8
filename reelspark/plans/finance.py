"""Box office, profit and return on investment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.functions.money import revenue_multiple, round_half_up
from reelspark.operators.quantiles import exact_percentiles
from reelspark.operators.sampling import sample_exactly
from reelspark.plans.star import Star

CREDIT_CATEGORIES = ("actor", "director", "writer")
RATING_COLUMNS = {"imdb": "imdb_rating", "tmdb": "tmdb_rating", "movielens": "ml_avg_rating"}
# Multiples beyond this are treated as data errors and capped in the value score (fixed value).
MULTIPLE_CEILING = 10_000
# Smallest budget the value score accepts (fixed value).
VALUE_BUDGET_FLOOR = 10_000



def _profit() -> Column:
    return F.col("revenue") - F.col("budget")


def _multiple() -> Column:
    return revenue_multiple(F.col("revenue"), F.col("budget"))


def _in_years(start_year: int, end_year: int) -> Column:
    return F.col("year").between(start_year, end_year)


def _ranked(df: DataFrame, measure: str, best: bool, limit: int) -> DataFrame:
    by = F.col(measure).desc_nulls_last() if best else F.col(measure).asc_nulls_last()
    return df.orderBy(by, "movie_id").limit(limit)


def _check_direction(direction: str) -> bool:
    if direction not in ("best", "worst"):
        raise ValueError("direction is 'best' or 'worst'")
    return direction == "best"


_FILM = ["movie_id", "title", "year", "poster_url"]


def top_revenue(star: Star, limit: int = 10, start_year: int = 1900, end_year: int = 2030) -> DataFrame:
    films = star.films().where((F.col("revenue") > 0) & _in_years(start_year, end_year))
    rows = films.select(*_FILM, "revenue", "budget", _profit().alias("profit"), "imdb_rating")
    return _ranked(rows, "revenue", True, limit)


def top_budget(star: Star, limit: int = 10, start_year: int = 1900, end_year: int = 2030) -> DataFrame:
    films = star.films().where((F.col("budget") > 0) & _in_years(start_year, end_year))
    rows = films.select(*_FILM, "budget", "revenue", _profit().alias("profit"), "imdb_rating")
    return _ranked(rows, "budget", True, limit)


def top_profit(
    star: Star, limit: int = 10, direction: str = "best", start_year: int = 1900, end_year: int = 2030
) -> DataFrame:
    """Largest profits, or with ``direction='worst'`` the largest losses."""
    films = star.films().where((F.col("budget") > 0) & (F.col("revenue") > 0) & _in_years(start_year, end_year))
    rows = films.select(*_FILM, "budget", "revenue", _profit().alias("profit"), "imdb_rating")
    return _ranked(rows, "profit", _check_direction(direction), limit)


def roi_leaderboard(
    star: Star,
    direction: str = "best",
    min_budget: int = 1_000_000,
    start_year: int = 1980,
    end_year: int = 2025,
    limit: int = 25,
) -> DataFrame:
    """Films by revenue per budget, as rounded for display."""
    films = star.films().where(
        (F.col("budget") >= min_budget) & (F.col("revenue") > 0) & _in_years(start_year, end_year)
    )
    rows = films.select(
        *_FILM,
        "budget",
        "revenue",
        _profit().alias("profit"),
        round_half_up(_multiple(), 2).alias("revenue_multiple"),
        "imdb_rating",
    )
    return _ranked(rows, "revenue_multiple", _check_direction(direction), limit)


def _financed(star: Star, start_year: int, end_year: int, min_budget: int) -> DataFrame:
    """Year and money of the films with both sums known."""
    return (
        star.films()
        .where((F.col("budget") >= min_budget) & (F.col("revenue") > 0) & _in_years(start_year, end_year))
        .select("movie_id", "year", "budget", "revenue")
    )


def _with_returns(df: DataFrame) -> DataFrame:
    """Multiple and profit, computed after the last join: both passes of the percentile then ask the joins for the
    same columns and share their shuffles."""
    return df.withColumns({"multiple": _multiple(), "profit": _profit()})


def _mean(total: str, count: str = "movie_count") -> Column:
    """Average from an exact integer sum."""
    return round_half_up(F.col(total).cast("double") / F.col(count), 0)


def genre_profitability(
    star: Star, start_year: int = 1980, end_year: int = 2025, min_budget: int = 1_000_000, min_movies: int = 20
) -> DataFrame:
    """Median return per genre with its quartiles."""
    rows = star.bridge_movie_genres.join(_financed(star, start_year, end_year, min_budget), "movie_id")
    stats = exact_percentiles(
        _with_returns(rows),
        ["genre_id"],
        "multiple",
        {"median": 0.5, "p25": 0.25, "p75": 0.75},
        row_count="movie_count",
        sums={"profit_sum": F.col("profit")},
    )
    return (
        stats.where(F.col("movie_count") >= min_movies)
        .join(star.dim_genre, "genre_id")
        .select(
            "genre_name",
            "movie_count",
            round_half_up(F.col("median"), 2).alias("median_roi"),
            round_half_up(F.col("p25"), 2).alias("p25_roi"),
            round_half_up(F.col("p75"), 2).alias("p75_roi"),
            _mean("profit_sum").alias("avg_profit"),
        )
        .orderBy(F.desc("median_roi"), "genre_name")
    )


def profitability_trend(star: Star, start_year: int = 1980, end_year: int = 2025, min_budget: int = 0) -> DataFrame:
    """Mean budget, revenue and profit, and median return, by year. ``min_budget=0`` means no threshold."""
    stats = exact_percentiles(
        _with_returns(_financed(star, start_year, end_year, max(min_budget, 1))),
        ["year"],
        "multiple",
        {"median": 0.5},
        row_count="movie_count",
        sums={c + "_sum": F.col(c) for c in ["budget", "revenue", "profit"]},
    )
    return stats.select(
        "year",
        "movie_count",
        _mean("budget_sum").alias("avg_budget"),
        _mean("revenue_sum").alias("avg_revenue"),
        _mean("profit_sum").alias("avg_profit"),
        round_half_up(F.col("median"), 2).alias("median_roi"),
    ).orderBy("year")


def budget_vs_rating(
    star: Star,
    source: str = "imdb",
    start_year: int = 1980,
    end_year: int = 2025,
    min_budget: int = 1_000_000,
    sample_size: int = 1000,
    seed: int = 0,
) -> DataFrame:
    """Random films with budget and rating, for a scatter plot."""
    rating = RATING_COLUMNS.get(source, RATING_COLUMNS["imdb"])
    films = star.films().where(
        (F.col("budget") >= min_budget) & F.col(rating).isNotNull() & _in_years(start_year, end_year)
    )
    rows = films.select("movie_id", "budget", F.col(rating).alias("rating"), "revenue", "title", "year")
    return sample_exactly(rows, sample_size, F.col("movie_id"), seed).drop("movie_id")


def star_power_roi(
    star: Star,
    category: str = "actor",
    start_year: int = 1980,
    end_year: int = 2025,
    min_budget: int = 1_000_000,
    min_movies: int = 5,
    limit: int = 25,
) -> DataFrame:
    """People by the median return of the films they are credited for."""
    if category not in CREDIT_CATEGORIES:
        category = "actor"
    credits = star.bridge_movie_cast.where(F.col("category") == category).select("movie_id", "person_id")
    stats = exact_percentiles(
        _with_returns(credits.join(_financed(star, start_year, end_year, min_budget), "movie_id")),
        ["person_id"],
        "multiple",
        {"median": 0.5},
        row_count="movie_count",
        sums={"profit_sum": F.col("profit")},
    )
    return (
        stats.where(F.col("movie_count") >= min_movies)
        .join(star.dim_person.select("person_id", "name"), "person_id")
        .select(
            "person_id",
            "name",
            "movie_count",
            round_half_up(F.col("median"), 2).alias("median_roi"),
            _mean("profit_sum").alias("avg_profit"),
        )
        .orderBy(F.desc_nulls_last("median_roi"), "person_id")
        .limit(limit)
    )


def value_frontier(
    star: Star,
    start_year: int = 1980,
    end_year: int = 2025,
    min_budget: int = 0,
    max_budget: int | None = None,
    min_rating: float | None = None,
    limit: int = 50,
) -> DataFrame:
    """Films that combine a high rating with a high return: rating * ln(1 + capped multiple)."""
    keep = (
        (F.col("budget") >= max(min_budget, VALUE_BUDGET_FLOOR))
        & (F.col("revenue") > 0)
        & F.col("imdb_rating").isNotNull()
        & _in_years(start_year, end_year)
    )
    if max_budget is not None:
        keep = keep & (F.col("budget") <= max_budget)
    if min_rating is not None:
        keep = keep & (F.col("imdb_rating") >= min_rating)
    capped = F.least(_multiple(), F.lit(float(MULTIPLE_CEILING)))
    rows = star.films().where(keep).select(
        *_FILM,
        "budget",
        "revenue",
        round_half_up(capped, 2).alias("revenue_multiple"),
        "imdb_rating",
        round_half_up(F.col("imdb_rating") * F.ln(1 + capped), 2).alias("value_score"),
    )
    return _ranked(rows, "value_score", True, limit)
