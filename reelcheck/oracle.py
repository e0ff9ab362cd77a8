"""DuckDB statements for the registered queries, written as the textbook form of each query."""

from __future__ import annotations

from reelcheck.registry import MIN_BUDGET, RUN_DATE
from reelcheck.source_mapping import source_sql
from reelcheck.star_mapping import STAR_SQL
from reelspark.functions.genres import GENRE_SYNONYMS, TMDB_GENRES
from reelspark.functions.text import LANGUAGE_PATTERNS


def _star(sql: str) -> str:
    return f"WITH {STAR_SQL} {sql}"


def _sources(names: list[str], ctes: str, sql: str) -> str:
    head = ", ".join(source_sql(n) for n in names)
    return f"WITH {head}{', ' + ctes if ctes else ''} {sql}"


def _rnd(x: str, scale: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {scale}) AS DOUBLE)"


def _avg(x: str) -> str:
    return _rnd(f"CAST(SUM(CAST({x} AS DECIMAL(20,10))) AS DOUBLE) / COUNT({x})", 6)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FILM = "movie_id, title, year, poster_url"
_PROFIT = "revenue - budget AS profit"
_MULTIPLE = "CAST(revenue AS DOUBLE) / NULLIF(budget, 0)"
_YEARS = "year BETWEEN 1980 AND 2025"
_FINANCED = f"budget >= {MIN_BUDGET} AND revenue > 0 AND {_YEARS}"

# --- finance ---

_ROI = f"""SELECT {_FILM}, budget, revenue, {_PROFIT}, {_rnd(_MULTIPLE, 2)} AS revenue_multiple, imdb_rating
  FROM films WHERE {_FINANCED} ORDER BY revenue_multiple DESC NULLS LAST, movie_id LIMIT 25"""

_GENRE_PROFIT = f"""SELECT genre_name, COUNT(*) AS movie_count,
  {_rnd('quantile_cont(rm, 0.5)', 2)} AS median_roi, {_rnd('quantile_cont(rm, 0.25)', 2)} AS p25_roi,
  {_rnd('quantile_cont(rm, 0.75)', 2)} AS p75_roi, {_rnd('CAST(SUM(profit) AS DOUBLE) / COUNT(*)', 0)} AS avg_profit
  FROM (SELECT genre_id, {_MULTIPLE} AS rm, {_PROFIT} FROM films JOIN bridge_movie_genres USING (movie_id) WHERE {_FINANCED}) g
  JOIN dim_genre USING (genre_id) GROUP BY genre_name HAVING COUNT(*) >= 20"""

_CAPPED = f"LEAST({_MULTIPLE}, 10000)"
_VALUE = f"""SELECT {_FILM}, budget, revenue, {_rnd(_CAPPED, 2)} AS revenue_multiple, imdb_rating,
  {_rnd(f'imdb_rating * LN(1 + {_CAPPED})', 2)} AS value_score
  FROM films WHERE budget >= 10000 AND revenue > 0 AND imdb_rating IS NOT NULL AND {_YEARS}
  ORDER BY value_score DESC NULLS LAST, movie_id LIMIT 50"""

FINANCE = {
    "top_revenue": f"""SELECT {_FILM}, revenue, budget, {_PROFIT}, imdb_rating FROM films
      WHERE revenue > 0 AND year BETWEEN 1900 AND 2030 ORDER BY revenue DESC, movie_id LIMIT 10""",
    "top_budget": f"""SELECT {_FILM}, budget, revenue, {_PROFIT}, imdb_rating FROM films
      WHERE budget > 0 AND year BETWEEN 1900 AND 2030 ORDER BY budget DESC, movie_id LIMIT 10""",
    "top_profit": f"""SELECT {_FILM}, budget, revenue, {_PROFIT}, imdb_rating FROM films
      WHERE budget > 0 AND revenue > 0 AND year BETWEEN 1900 AND 2030 ORDER BY profit DESC, movie_id LIMIT 10""",
    "top_loss": f"""SELECT {_FILM}, budget, revenue, {_PROFIT}, imdb_rating FROM films
      WHERE budget > 0 AND revenue > 0 AND year BETWEEN 1900 AND 2030 ORDER BY profit ASC, movie_id LIMIT 10""",
    "roi_leaderboard": _ROI,
    "genre_profitability": _GENRE_PROFIT,
    "profitability_trend": f"""SELECT year, COUNT(*) AS movie_count,
      {_rnd('CAST(SUM(budget) AS DOUBLE) / COUNT(*)', 0)} AS avg_budget,
      {_rnd('CAST(SUM(revenue) AS DOUBLE) / COUNT(*)', 0)} AS avg_revenue,
      {_rnd('CAST(SUM(revenue - budget) AS DOUBLE) / COUNT(*)', 0)} AS avg_profit,
      {_rnd(f'quantile_cont({_MULTIPLE}, 0.5)', 2)} AS median_roi
      FROM films WHERE budget > 0 AND revenue > 0 AND {_YEARS} GROUP BY year""",
    "budget_vs_rating": f"""SELECT budget, imdb_rating AS rating, revenue, title, year FROM films
      WHERE budget >= {MIN_BUDGET} AND imdb_rating IS NOT NULL AND {_YEARS}
      ORDER BY md5('0|' || movie_id), movie_id LIMIT 1000""",
    "star_power_roi": f"""SELECT person_id, name, COUNT(*) AS movie_count, {_rnd('quantile_cont(rm, 0.5)', 2)} AS median_roi,
      {_rnd('CAST(SUM(profit) AS DOUBLE) / COUNT(*)', 0)} AS avg_profit
      FROM (SELECT person_id, name, {_MULTIPLE} AS rm, {_PROFIT} FROM bridge_movie_cast JOIN dim_person USING (person_id)
        JOIN films USING (movie_id) WHERE {_FINANCED} AND category = 'actor') c
      GROUP BY person_id, name HAVING COUNT(*) >= 5 ORDER BY median_roi DESC, person_id LIMIT 25""",
    "value_frontier": _VALUE,
}

# --- overview and ratings ---

_LANGUAGE = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(original_title, {_q(p)}) THEN '{n}'" for n, p in LANGUAGE_PATTERNS)
    + " ELSE 'Other' END"
)
_LANGUAGES = f"SELECT {_LANGUAGE} AS language, COUNT(*) AS count FROM (SELECT text AS original_title FROM documents) t GROUP BY 1"
_PER_YEAR = "SELECT year, COUNT(*) AS count FROM dim_movie WHERE year BETWEEN 1900 AND 2030 GROUP BY year"
_BINS = """SELECT CAST(FLOOR(imdb_rating) AS INT) AS bin, COUNT(*) AS count FROM fact_movie_metrics
  WHERE imdb_rating IS NOT NULL GROUP BY 1"""
_PLATFORMS = f"""SELECT year, {_avg('imdb_rating')} AS imdb_avg, {_avg('tmdb_rating')} AS tmdb_avg,
  {_avg('ml_avg_rating')} AS ml_avg FROM films WHERE year BETWEEN 1990 AND 2025 GROUP BY year"""

OVERVIEW = {
    "movies_per_year": _PER_YEAR,
    "top_popular": """SELECT CAST(movie_id AS VARCHAR) AS movie_id, title, year, poster_url, imdb_votes, tmdb_popularity,
      imdb_rating, budget, revenue FROM (SELECT * FROM films WHERE imdb_votes IS NOT NULL
      ORDER BY imdb_votes DESC, movie_id LIMIT 10) t""",
    "language_distribution": _LANGUAGES,
    "rating_distribution": _BINS,
    "platform_comparison": _PLATFORMS,
    "cult_classics": f"""SELECT {_FILM}, imdb_rating, imdb_votes, tmdb_rating FROM films
      WHERE imdb_rating >= 8.0 AND imdb_votes <= 10000 AND imdb_votes > 1000
      ORDER BY imdb_rating DESC, imdb_votes, movie_id LIMIT 50""",
    "runtime_vs_rating": """SELECT runtime, imdb_rating AS rating FROM films
      WHERE runtime BETWEEN 30 AND 300 AND imdb_rating IS NOT NULL ORDER BY md5('0|' || movie_id), movie_id LIMIT 1000""",
    "divisive_movies": """SELECT movie_id, title, year, tomatometer_score, audience_score, divisive_score FROM films
      WHERE divisive_score IS NOT NULL ORDER BY divisive_score DESC, movie_id LIMIT 10""",
}

# --- genres ---

_SHARE = """SELECT CAST((year // 10) * 10 AS INT) AS decade, genre_name, COUNT(*) AS count
  FROM dim_movie JOIN bridge_movie_genres USING (movie_id) JOIN dim_genre USING (genre_id)
  WHERE year BETWEEN 1920 AND 2024 GROUP BY 1, 2"""
_GENRE_RATING = f"""SELECT genre_name, {_avg('imdb_rating')} AS avg_rating, COUNT(*) AS movie_count
  FROM dim_genre JOIN bridge_movie_genres USING (genre_id) JOIN fact_movie_metrics USING (movie_id)
  WHERE imdb_rating IS NOT NULL GROUP BY genre_name HAVING COUNT(*) > 100"""
_COOCCURRENCE = """SELECT g1.genre_name AS genre1, g2.genre_name AS genre2, COUNT(*) AS count
  FROM bridge_movie_genres b1 JOIN bridge_movie_genres b2 ON b1.movie_id = b2.movie_id AND b1.genre_id < b2.genre_id
  JOIN dim_genre g1 ON b1.genre_id = g1.genre_id JOIN dim_genre g2 ON b2.genre_id = g2.genre_id
  GROUP BY 1, 2 HAVING COUNT(*) > 50"""

GENRES = {
    "genre_share_by_decade": _SHARE,
    "genre_average_rating": _GENRE_RATING,
    "genre_cooccurrence": _COOCCURRENCE,
    "genre_list": """SELECT g.genre_id, g.genre_name, COUNT(b.movie_id) AS movie_count FROM dim_genre g
      LEFT JOIN bridge_movie_genres b ON g.genre_id = b.genre_id GROUP BY 1, 2""",
    "top_by_genre": """SELECT genre_name, CAST(rank AS INT) AS rank, movie_id, title, year, revenue FROM (
      SELECT genre_name, movie_id, title, year, revenue,
        ROW_NUMBER() OVER (PARTITION BY genre_id ORDER BY revenue DESC, movie_id) AS rank
      FROM films JOIN bridge_movie_genres USING (movie_id) JOIN dim_genre USING (genre_id) WHERE revenue IS NOT NULL) t
      WHERE rank <= 5""",
}

# --- people ---

_PAIRS = """SELECT p1.name AS actor1, p2.name AS actor2, COUNT(*) AS collaborations
  FROM bridge_movie_cast c1 JOIN bridge_movie_cast c2 ON c1.movie_id = c2.movie_id AND c1.person_id < c2.person_id
  JOIN dim_person p1 ON c1.person_id = p1.person_id JOIN dim_person p2 ON c2.person_id = p2.person_id
  WHERE c1.category = 'actor' AND c2.category = 'actor' GROUP BY 1, 2 HAVING COUNT(*) >= 3
  ORDER BY collaborations DESC, actor1, actor2 LIMIT 100"""
_CREDITS = """SELECT c.person_id, c.movie_id, m.title, m.year, c.category, c.characters, f.imdb_rating
  FROM bridge_movie_cast c JOIN dim_movie m ON c.movie_id = m.movie_id
  LEFT JOIN fact_movie_metrics f ON m.movie_id = f.movie_id"""

PEOPLE = {
    "top_prolific": """SELECT person_id, name, COUNT(DISTINCT movie_id) AS movie_count FROM dim_person
      JOIN bridge_movie_cast USING (person_id) WHERE category = 'actor' GROUP BY 1, 2
      ORDER BY movie_count DESC, person_id LIMIT 20""",
    "top_rated": f"""SELECT person_id, name, {_avg('imdb_rating')} AS avg_rating, COUNT(DISTINCT movie_id) AS movie_count
      FROM dim_person JOIN bridge_movie_cast USING (person_id) JOIN fact_movie_metrics USING (movie_id)
      WHERE category = 'actor' AND imdb_rating IS NOT NULL GROUP BY 1, 2 HAVING COUNT(DISTINCT movie_id) >= 5
      ORDER BY avg_rating DESC, person_id LIMIT 20""",
    "person_rating_history": f"""SELECT person_id, year, {_avg('imdb_rating')} AS avg_rating, COUNT(*) AS movie_count
      FROM bridge_movie_cast JOIN films USING (movie_id) WHERE imdb_rating IS NOT NULL GROUP BY 1, 2""",
    "actor_network": _PAIRS,
    "actor_network_crowded": _PAIRS,
    "person_detail": f"""SELECT p.person_id, p.name, p.birth_year, movie_id, title, year, category, characters, imdb_rating
      FROM dim_person p LEFT JOIN ({_CREDITS}) c ON p.person_id = c.person_id""",
    "person_summary": f"""SELECT person_id, COUNT(*) AS film_rows,
      {_avg('CASE WHEN imdb_rating <> 0 THEN imdb_rating END')} AS avg_rating,
      MIN(year) AS first_year, MAX(year) AS last_year,
      COUNT(CASE WHEN category = 'actor' THEN 1 END) AS actor_rows,
      COUNT(CASE WHEN category = 'director' THEN 1 END) AS director_rows,
      COUNT(CASE WHEN category IS NULL OR category NOT IN ('actor', 'director') THEN 1 END) AS other_rows
      FROM ({_CREDITS}) c GROUP BY person_id""",
}

# --- temporal ---

_MPAA = f"""SELECT mpaa_rating, COUNT(*) AS count, {_avg('imdb_rating')} AS avg_rating FROM dim_movie m
  LEFT JOIN fact_movie_metrics f ON m.movie_id = f.movie_id WHERE mpaa_rating IS NOT NULL GROUP BY 1"""

TEMPORAL = {
    "runtime_trend": """SELECT year, CAST(SUM(runtime) AS DOUBLE) / COUNT(*) AS avg_runtime, COUNT(*) AS movie_count
      FROM dim_movie WHERE runtime BETWEEN 30 AND 300 AND year BETWEEN 1950 AND 2025 GROUP BY year""",
    "quality_by_month": f"""SELECT month, {_avg('imdb_rating')} AS avg_rating, COUNT(*) AS movie_count
      FROM fact_movie_metrics JOIN dim_time USING (time_id) WHERE imdb_rating IS NOT NULL GROUP BY month""",
    "quality_by_release_month": f"""SELECT CAST(MONTH(o_orderdate) AS INT) AS month, {_avg('imdb_rating')} AS avg_rating,
      COUNT(*) AS movie_count FROM fact_movie_metrics JOIN orders ON o_orderkey = movie_id
      WHERE imdb_rating IS NOT NULL GROUP BY 1""",
    "mpaa_distribution": _MPAA,
    "mpaa_trend": """SELECT CAST((year // 10) * 10 AS INT) AS decade, mpaa_rating, COUNT(*) AS count FROM dim_movie
      WHERE mpaa_rating IS NOT NULL AND year >= 1960 GROUP BY 1, 2""",
}

# --- movies and views ---

_LISTED = "movie_id, title, year, runtime, poster_url, imdb_rating, imdb_votes, tmdb_rating, budget, revenue"
_SHOWN = """SELECT * FROM (SELECT movie_id, person_id, name, category, ordering, characters,
  ROW_NUMBER() OVER (PARTITION BY movie_id ORDER BY ordering, person_id, category, characters) AS billing
  FROM bridge_movie_cast JOIN dim_person USING (person_id)) t WHERE billing <= 20"""

MOVIES = {
    "movie_list": f"SELECT {_LISTED} FROM films ORDER BY imdb_rating DESC NULLS LAST, movie_id LIMIT 20 OFFSET 20",
    "movie_list_filtered": f"""SELECT {_LISTED} FROM films WHERE year = 1997 AND imdb_rating >= 4.0 AND title ILIKE '%RING%'
      AND movie_id IN (SELECT movie_id FROM bridge_movie_genres WHERE genre_id = 3)
      ORDER BY imdb_votes ASC NULLS LAST, movie_id LIMIT 20""",
    "movies_after": f"""SELECT {_LISTED} FROM films WHERE imdb_rating < 4.0 OR (imdb_rating = 4.0 AND movie_id > 700) OR imdb_rating IS NULL
      ORDER BY imdb_rating DESC NULLS LAST, movie_id LIMIT 20""",
    "movies_titled": "SELECT movie_id, title, year FROM dim_movie WHERE title ILIKE '%ring%'",
    "movie_list_total": "SELECT COUNT(*) AS total FROM films WHERE imdb_rating >= 4.0 AND title ILIKE '%ring%'",
    "movie_detail": f"""SELECT movie_id, title, year, imdb_rating, budget, revenue, genres, cast_shown FROM films
      LEFT JOIN (SELECT movie_id, STRING_AGG(genre_id || ':' || genre_name, '|' ORDER BY genre_id) AS genres
        FROM bridge_movie_genres JOIN dim_genre USING (genre_id) GROUP BY movie_id) g USING (movie_id)
      LEFT JOIN (SELECT movie_id, STRING_AGG(ordering || ':' || name || ':' || category, '|'
          ORDER BY ordering, person_id, name, category, characters) AS cast_shown
        FROM ({_SHOWN}) s GROUP BY movie_id) c USING (movie_id)""",
    "cast_by_role": f"""SELECT movie_id,
      COALESCE(STRING_AGG(name, ', ' ORDER BY ordering, person_id) FILTER (WHERE category = 'actor'), '') AS actors,
      COALESCE(STRING_AGG(name, ', ' ORDER BY ordering, person_id) FILTER (WHERE category = 'director'), '') AS directors
      FROM ({_SHOWN}) s GROUP BY movie_id""",
    "v_movie_full": """SELECT movie_id, title, original_title, year, runtime, mpaa_rating, plot_summary, poster_url,
      ml_avg_rating, ml_rating_count, imdb_rating, imdb_votes, tmdb_rating, tmdb_votes, tomatometer_score, audience_score,
      divisive_score, budget, revenue FROM films""",
    "v_movie_genres": """SELECT m.movie_id, m.title, m.year, STRING_AGG(g.genre_name, ', ' ORDER BY g.genre_name) AS genres
      FROM dim_movie m LEFT JOIN bridge_movie_genres b ON m.movie_id = b.movie_id
      LEFT JOIN dim_genre g ON b.genre_id = g.genre_id GROUP BY 1, 2, 3""",
    "v_movie_cast": """SELECT m.movie_id, m.title, c.category, c.ordering, p.person_id, p.name AS person_name, c.characters
      FROM dim_movie m JOIN bridge_movie_cast c ON m.movie_id = c.movie_id JOIN dim_person p ON c.person_id = p.person_id""",
}

# --- dashboard ---


def _shares(kept: str) -> str:
    return f"""SELECT decade, genre_name, CAST(count AS DOUBLE) / SUM(count) OVER (PARTITION BY decade) * 100 AS share
      FROM ({_SHARE}) s WHERE {kept}"""


_TOP_GENRES = f"genre_name IN (SELECT genre_name FROM ({_SHARE}) s GROUP BY 1 ORDER BY SUM(count) DESC, genre_name LIMIT 8)"
_LEADING = f"SELECT genre_name, ROW_NUMBER() OVER (ORDER BY SUM(count) DESC, genre_name) AS rank FROM ({_SHARE}) s GROUP BY 1"
_PIVOTED = ", ".join(
    f"(SELECT genre_name FROM ({_LEADING}) l WHERE rank = {i}) AS genre_{i}, "
    f"COALESCE(CAST(SUM(count) FILTER (WHERE rank = {i}) AS DOUBLE) / SUM(count) FILTER (WHERE rank <= 8) * 100, 0.0) AS share_{i}"
    for i in range(1, 9)
)

DASHBOARD = {
    "genre_shares": _shares(_TOP_GENRES),
    "genre_share_pivot": f"""SELECT decade, {_PIVOTED}, CAST(COALESCE(SUM(count) FILTER (WHERE rank > 8), 0) AS BIGINT) AS other_films
      FROM ({_SHARE}) p JOIN ({_LEADING}) r USING (genre_name) GROUP BY decade""",
    "overview_kpis": f"""SELECT CAST((SELECT SUM(count) FROM ({_PER_YEAR}) a WHERE year BETWEEN 1950 AND 2025) AS BIGINT) AS total_movies,
      (SELECT year FROM ({_PER_YEAR}) b WHERE year BETWEEN 1950 AND 2025 ORDER BY count DESC, year LIMIT 1) AS peak_year,
      (SELECT CAST(SUM(bin * count) AS DOUBLE) / SUM(count) FROM ({_BINS}) c) AS avg_rating,
      (SELECT COUNT(*) FROM ({_LANGUAGES}) d) AS total_languages""",
    "platform_normalized": f"SELECT year, imdb_avg, tmdb_avg * 1.0 AS tmdb_avg, ml_avg * 2 AS ml_avg FROM ({_PLATFORMS}) p",
    "genre_cooccurrence_matrix": f"""SELECT CAST(DENSE_RANK() OVER (ORDER BY genre1) - 1 AS INT) AS x,
      CAST(DENSE_RANK() OVER (ORDER BY genre2) - 1 AS INT) AS y, genre1, genre2, count,
      CAST(count AS DOUBLE) / GREATEST(MAX(count) OVER (), 1) * CAST(0.85 AS DOUBLE) + CAST(0.15 AS DOUBLE) AS opacity
      FROM (SELECT genre1, genre2, count FROM ({_COOCCURRENCE}) a UNION ALL SELECT genre2, genre1, count FROM ({_COOCCURRENCE}) b) t""",
    "genre_rating_top15": f"SELECT * FROM ({_GENRE_RATING}) g ORDER BY avg_rating DESC, genre_name LIMIT 15",
    "genre_roi_iqr": f"""SELECT *, ROUND(median_roi - p25_roi, 2) AS below_median, ROUND(p75_roi - median_roi, 2) AS above_median
      FROM ({_GENRE_PROFIT}) g""",
    "roi_tier": f"""SELECT *, CASE WHEN revenue_multiple >= 10 THEN '10x and more' WHEN revenue_multiple >= 5 THEN '5x'
      WHEN revenue_multiple >= 2 THEN '2x' ELSE 'below 2x' END AS tier FROM ({_ROI}) r""",
    "value_tier": f"""SELECT *, CASE WHEN value_score / GREATEST(MAX(value_score) OVER (), 1.0) > 0.7 THEN 'high'
      WHEN value_score / GREATEST(MAX(value_score) OVER (), 1.0) > 0.4 THEN 'medium' ELSE 'low' END AS tier FROM ({_VALUE}) v""",
    "actor_pairs_labelled": f"SELECT *, actor1 || ' & ' || actor2 AS pair FROM ({_PAIRS}) p",
    "mpaa_top5": f"SELECT * FROM ({_MPAA}) m ORDER BY count DESC, mpaa_rating LIMIT 5",
}

# --- expressions on raw sources ---


def _title_key(t: str) -> str:
    bare = rf"lower(regexp_replace({t}, '\s*\(\d{{4}}\)\s*$', ''))"
    return rf"NULLIF(TRIM(regexp_replace(regexp_replace({bare}, '[^\p{{L}}\p{{M}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')), '')"


def _ascii_key(t: str) -> str:
    return rf"TRIM(regexp_replace(regexp_replace(TRIM(lower({t})), '[^\w\s]', '', 'g'), '\s+', ' ', 'g'))"


def _title_case(s: str) -> str:
    runs = rf"regexp_extract_all({s}, '(\p{{L}}+|\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def _canonical(g: str) -> str:
    s = rf"regexp_replace({g}, '^\s+|\s+$', '', 'g')"
    whens = " ".join(f"WHEN {_q(k)} THEN {'NULL' if v is None else _q(v)}" for k, v in GENRE_SYNONYMS.items())
    return f"CASE WHEN {g} IS NULL THEN NULL ELSE CASE upper({s}) {whens} ELSE {_title_case(s)} END END"


_TMDB_NAME = (
    "CASE i "
    + " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in TMDB_GENRES.items())
    + " ELSE 'Unknown(' || i || ')' END"
)
_TMDB_NAMES = f"list_transform(genre_ids, lambda i: {_TMDB_NAME})"
_BARE_MONEY = "TRIM(regexp_replace(upper(box_office), '[$,]', '', 'g'))"
_FACTOR = f"CASE right({_BARE_MONEY}, 1) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 WHEN 'B' THEN 1000000000 ELSE 1 END"
_DIGITS = f"regexp_replace({_BARE_MONEY}, '[KMB]$', '')"
_AMOUNT = f"CAST(TRUNC(TRY_CAST({_DIGITS} AS DECIMAL(28,9)) * {_FACTOR}) AS BIGINT)"
_BINARY_AMOUNT = f"CAST(TRUNC(TRY_CAST({_DIGITS} AS DOUBLE) * {_FACTOR}) AS BIGINT)"

# --- silver ---

_ML_YEAR = r"TRY_CAST(NULLIF(regexp_extract(title, '\((\d{4})\)\s*$', 1), '') AS INT)"
_ML_TITLE = r"regexp_replace(title, '\s*\(\d{4}\)\s*$', '')"
_DAY = f"DATE '{RUN_DATE}'"
_SILVER = f"""
s_ml AS (SELECT movieId AS ml_id, {_ML_TITLE} AS title, {_ML_YEAR} AS year,
  CASE WHEN genres <> '(no genres listed)' THEN string_split(genres, '|') END AS genres_array, genres AS genres_raw,
  {_DAY} AS cleaned_date FROM ml_movies),
s_ml_ratings AS (SELECT movieId AS ml_id, {_avg('rating')} AS ml_avg_rating, COUNT(rating) AS ml_rating_count FROM ratings GROUP BY 1),
s_tags AS (SELECT userId AS user_id, movieId AS ml_id, TRIM(tag) AS tag, timestamp, {_DAY} AS cleaned_date FROM tags WHERE TRIM(tag) <> ''),
s_imdb AS (SELECT tconst AS imdb_id, TRIM(primaryTitle) AS primary_title, TRIM(originalTitle) AS original_title,
  TRY_CAST(startYear AS INT) AS year, TRY_CAST(runtimeMinutes AS INT) AS runtime_minutes, TRY_CAST(isAdult AS INT) AS is_adult,
  CASE WHEN genres <> '' THEN string_split(genres, ',') END AS genres_array, genres AS genres_raw, {_DAY} AS cleaned_date
  FROM title_basics WHERE titleType = 'movie'),
s_imdb_ratings AS (SELECT tconst AS imdb_id, TRY_CAST(averageRating AS DOUBLE) AS imdb_rating,
  TRY_CAST(numVotes AS INT) AS imdb_votes, {_DAY} AS cleaned_date FROM title_ratings),
s_names AS (SELECT nconst AS person_id, TRIM(primaryName) AS name, TRY_CAST(birthYear AS INT) AS birth_year,
  TRY_CAST(deathYear AS INT) AS death_year, string_split(primaryProfession, ',')[1] AS primary_profession,
  primaryProfession AS professions_raw, string_split(knownForTitles, ',') AS known_for_titles, {_DAY} AS cleaned_date FROM name_basics),
s_principals AS (SELECT tconst AS imdb_id, TRY_CAST(ordering AS INT) AS ordering, nconst AS person_id, TRIM(category) AS category,
  TRIM(job) AS job, characters, {_DAY} AS cleaned_date FROM title_principals),
s_crew AS (SELECT tconst AS imdb_id, CASE WHEN directors <> '' THEN string_split(directors, ',') END AS directors,
  CASE WHEN writers <> '' THEN string_split(writers, ',') END AS writers, {_DAY} AS cleaned_date FROM title_crew),
s_tmdb AS (SELECT id AS tmdb_id, title, original_title, overview AS plot_summary,
  'https://image.tmdb.org/t/p/w500' || poster_path AS poster_url, 'https://image.tmdb.org/t/p/original' || backdrop_path AS backdrop_url,
  release_date, TRY_CAST(NULLIF(release_date[1:4], '') AS INT) AS year, popularity, vote_average AS tmdb_rating, vote_count AS tmdb_votes,
  {_TMDB_NAMES} AS genres_array, original_language, adult, budget, revenue, {_DAY} AS cleaned_date FROM tmdb_movies),
s_rt AS (SELECT rt_id, slug AS rt_slug, title, {_title_key('title')} AS normalized_title, tomatometer_score, audience_score,
  ABS(tomatometer_score - audience_score) AS divisive_score, mpaa_rating, box_office AS box_office_raw, {_AMOUNT} AS box_office_revenue,
  release_date, release_year, CASE WHEN TRIM(director) <> '' THEN regexp_split_to_array(TRIM(director), ',\\s*') END AS directors,
  CASE WHEN TRIM(genre) <> '' THEN regexp_split_to_array(TRIM(genre), ',\\s*') END AS genres_array, genre AS genre_raw,
  {_DAY} AS cleaned_date FROM rt_movies)
"""
_ALL = [
    "ml_movies",
    "links",
    "rt_movies",
    "ratings",
    "tags",
    "title_basics",
    "title_ratings",
    "name_basics",
    "title_principals",
    "title_crew",
    "tmdb_movies",
]


def _silver(sql: str, ctes: str = "") -> str:
    return _sources(_ALL, _SILVER + (", " + ctes if ctes else ""), sql)


def _flat(table: str, *arrays: str, exclude: tuple[str, ...] = ()) -> str:
    dropped = f" EXCLUDE ({', '.join(exclude)})" if exclude else ""
    replaced = ", ".join(f"array_to_string({a}, '|') AS {a}" for a in arrays)
    return f"SELECT *{dropped}{f' REPLACE ({replaced})' if arrays else ''} FROM {table}"


_RAW_GENRES = " UNION ALL ".join(
    f"SELECT UNNEST(genres_array) AS genre FROM {t}" for t in ["s_ml", "s_imdb", "s_tmdb", "s_rt"]
)

SILVER = {
    "replace_null_strings": r"""SELECT event_id, CASE WHEN event_type IN ('\N', 'null', 'NULL', 'None', '') OR TRIM(event_type) = ''
      THEN NULL ELSE event_type END AS event_type, props FROM (SELECT event_id, props, CASE event_id % 7 WHEN 0 THEN '\N'
      WHEN 1 THEN 'null' WHEN 2 THEN '  ' WHEN 3 THEN 'None' ELSE event_type END AS event_type FROM events) t""",
    "clean_whitespace": r"""SELECT doc_id, TRIM(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS text,
      TRIM(regexp_replace(lang, '\s+', ' ', 'g')) AS lang FROM documents""",
    "normalize_title": f"SELECT doc_id, {_title_key('text')} AS title_key FROM documents",
    "normalize_title_ascii": f"SELECT doc_id, {_ascii_key('text')} AS title_key FROM documents",
    "parse_box_office": _sources(["rt_movies"], "", f"SELECT slug, {_AMOUNT} AS amount, {_BINARY_AMOUNT} AS binary_amount FROM rt_movies"),
    "box_office_parse_flag": _sources(
        ["rt_movies"],
        "",
        f"SELECT slug, box_office, {_AMOUNT} AS box_office_revenue, {_AMOUNT} IS NOT NULL AS parse_success FROM rt_movies",
    ),
    "map_genre_ids": _sources(
        ["tmdb_movies"], "", f"SELECT id, array_to_string({_TMDB_NAMES}, '|') AS genre_names FROM tmdb_movies"
    ),
    "normalize_genre": _silver(f"SELECT genre, {_canonical('genre')} AS genre_name, COUNT(*) AS uses FROM ({_RAW_GENRES}) g GROUP BY genre"),
    "clean_movies": _silver(_flat("s_ml", "genres_array")),
    "ratings_agg": _silver("SELECT ml_id, ml_avg_rating, ml_rating_count FROM s_ml_ratings"),
    "clean_tags": _silver(_flat("s_tags")),
    "clean_imdb_titles": _silver(_flat("s_imdb", "genres_array")),
    "clean_imdb_ratings": _silver(_flat("s_imdb_ratings")),
    "clean_imdb_names": _silver(_flat("s_names", "known_for_titles")),
    "clean_imdb_principals": _silver(_flat("s_principals")),
    "clean_imdb_crew": _silver(_flat("s_crew", "directors", "writers")),
    "clean_tmdb_movies": _silver(_flat("s_tmdb", "genres_array")),
    "clean_rt_movies": _silver(_flat("s_rt", "directors", "genres_array")),
}

# --- entity resolution: the pairwise rule, spelled out ---


def _spine_ctes(key, exact_on: str) -> str:
    return f"""
l AS (SELECT movieId AS ml_id, 'tt' || CASE WHEN length(imdbId) < 7 THEN lpad(imdbId, 7, '0') ELSE imdbId END AS imdb_id, tmdbId AS tmdb_id FROM links),
core AS (SELECT l.ml_id, l.imdb_id, l.tmdb_id, {key('COALESCE(t.title, b.primaryTitle, m.mt)')} AS k,
    CAST(COALESCE(YEAR(TRY_CAST(NULLIF(t.release_date, '') AS DATE)), TRY_CAST(b.startYear AS INT), m.my) AS INT) AS y
  FROM l LEFT JOIN (SELECT movieId, {_ML_TITLE} AS mt, {_ML_YEAR} AS my FROM ml_movies) m ON m.movieId = l.ml_id
  LEFT JOIN tmdb_movies t ON t.id = l.tmdb_id
  LEFT JOIN (SELECT * FROM title_basics WHERE titleType = 'movie') b ON b.tconst = l.imdb_id),
rt AS (SELECT slug AS rt_slug, {key('title')} AS k, release_year AS y FROM rt_movies),
e1 AS (SELECT ml_id, rt_slug, ROW_NUMBER() OVER (PARTITION BY ml_id ORDER BY rt_slug) AS r FROM core JOIN rt ON {exact_on}),
e2 AS (SELECT ml_id, rt_slug, ROW_NUMBER() OVER (PARTITION BY rt_slug ORDER BY ml_id) AS r FROM e1 WHERE r = 1),
exact AS (SELECT ml_id, rt_slug FROM e2 WHERE r = 1)"""


def _fuzzy_ctes(name: str, left: str, right: str) -> str:
    return f"""
{name}1 AS (SELECT a.ml_id, b.rt_slug, ROW_NUMBER() OVER (PARTITION BY a.ml_id ORDER BY b.rt_slug) AS r
  FROM {left} a JOIN {right} b ON a.k = b.k AND ABS(a.y - b.y) <= 1),
{name}2 AS (SELECT ml_id, rt_slug, ROW_NUMBER() OVER (PARTITION BY rt_slug ORDER BY ml_id) AS r FROM {name}1 WHERE r = 1),
{name} AS (SELECT ml_id, rt_slug FROM {name}2 WHERE r = 1)"""


def _matching_ctes(key, exact_on: str) -> str:
    rest = _fuzzy_ctes(
        "fuzzy",
        "(SELECT * FROM core WHERE ml_id NOT IN (SELECT ml_id FROM exact))",
        "(SELECT * FROM rt WHERE rt_slug NOT IN (SELECT rt_slug FROM exact))",
    )
    return f"""{_spine_ctes(key, exact_on)}, {rest},
matches AS (SELECT ml_id, rt_slug, 'title_year_exact' AS rt_match_method FROM exact
  UNION ALL SELECT ml_id, rt_slug, 'title_year_fuzzy' FROM fuzzy),
lost AS (SELECT CAST(NULL AS INT) AS ml_id, CAST(NULL AS VARCHAR) AS imdb_id, id AS tmdb_id, CAST(NULL AS VARCHAR) AS rt_slug,
    CAST(NULL AS VARCHAR) AS rt_match_method FROM tmdb_movies WHERE id NOT IN (SELECT tmdb_id FROM l WHERE tmdb_id IS NOT NULL)
  UNION ALL SELECT NULL, tconst, NULL, NULL, NULL FROM title_basics WHERE titleType = 'movie'
    AND tconst NOT IN (SELECT imdb_id FROM l WHERE imdb_id IS NOT NULL)
  UNION ALL SELECT NULL, NULL, NULL, rt_slug, 'unmatched' FROM rt WHERE rt_slug NOT IN (SELECT rt_slug FROM matches)),
entities AS (SELECT ml_id, imdb_id, tmdb_id, rt_slug, rt_match_method FROM core LEFT JOIN matches USING (ml_id)
  UNION ALL SELECT * FROM lost),
spine AS (SELECT ROW_NUMBER() OVER (ORDER BY CASE WHEN imdb_id IS NOT NULL THEN 0 WHEN tmdb_id IS NOT NULL THEN 1
    WHEN ml_id IS NOT NULL THEN 2 ELSE 3 END, imdb_id NULLS FIRST, tmdb_id NULLS FIRST, ml_id NULLS FIRST, rt_slug NULLS FIRST) AS movie_id,
  ml_id, imdb_id, tmdb_id, rt_slug, rt_match_method, {_DAY} AS created_date FROM entities)"""


_SAME_YEAR = "core.k = rt.k AND core.y = rt.y"
# Constants of the XXH64 hash (fixed values).
_P1, _P2, _P3, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 2870177450012600261


def _xxh_int(source: str, value: str) -> str:
    """XXH64 of a 4-byte value with the hash so far (column h) as seed, modulo 2^64 in wider integers."""

    def mod(x: str) -> str:
        return f"(({x}) % {1 << 64}::UHUGEINT)"

    def xor(a: str, b: str) -> str:
        return f"CAST(xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT)) AS UHUGEINT)"

    wide = f"CAST({value} AS UHUGEINT)"
    steps = [
        xor(mod(f"CAST(h AS UHUGEINT) + {_P5}::UHUGEINT + 4"), mod(f"{wide} * {_P1}::UHUGEINT")),
        mod(f"({mod(f'h * {1 << 23}')} + h // {1 << 41}) * {_P2}::UHUGEINT + {_P3}::UHUGEINT"),
        mod(f"{xor('h', f'h // {1 << 33}')} * {_P2}::UHUGEINT"),
        mod(f"{xor('h', f'h // {1 << 29}')} * {_P3}::UHUGEINT"),
        xor("h", f"h // {1 << 32}"),
    ]
    for step in steps:
        source = f"SELECT movie_id, {step} AS h FROM ({source}) t"
    return source


_SPINE = _matching_ctes(_title_key, _SAME_YEAR)
_SPINE_SOURCES = ["links", "ml_movies", "tmdb_movies", "title_basics", "rt_movies"]

SPINE = {
    "entity_spine": _sources(_SPINE_SOURCES, _SPINE, "SELECT * FROM spine"),
    "entity_spine_title_only": _sources(
        _SPINE_SOURCES, _matching_ctes(_ascii_key, "core.k = rt.k"), "SELECT * FROM spine"
    ),
    "match_exact": _sources(_SPINE_SOURCES, _spine_ctes(_title_key, _SAME_YEAR), "SELECT * FROM exact"),
    "match_fuzzy": _sources(
        _SPINE_SOURCES, f"{_spine_ctes(_title_key, _SAME_YEAR)}, {_fuzzy_ctes('near', 'core', 'rt')}", "SELECT * FROM near"
    ),
    "orphans": _sources(_SPINE_SOURCES, _SPINE, "SELECT * FROM lost"),
}

# --- gold ---

_GENRE_DIM = f"""genre_names AS (SELECT DISTINCT {_canonical('genre')} AS genre_name FROM (SELECT DISTINCT genre FROM ({_RAW_GENRES}) a) b),
g_dim AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY genre_name) AS INT) AS genre_id, genre_name FROM genre_names WHERE genre_name <> '')"""
_PERSON_DIM = """p_dim AS (SELECT person_id, name, birth_year, death_year, primary_profession, professions_raw AS all_professions,
  known_for_titles FROM s_names WHERE birth_year IS NOT NULL)"""
_KNOWN = sorted(set(GENRE_SYNONYMS) | {n.upper() for n in TMDB_GENRES.values()})

GOLD = {
    "dim_time": _star("SELECT * FROM dim_time"),
    "dim_genre": _silver("SELECT * FROM g_dim", _GENRE_DIM),
    "unmapped_genres": _silver(
        f"""SELECT genre, COUNT(*) AS uses, 'Other' AS default_genre FROM ({_RAW_GENRES}) g WHERE genre IS NOT NULL
        AND upper(TRIM(genre)) NOT IN ({', '.join(_q(k) for k in _KNOWN)}) GROUP BY genre"""
    ),
    "dim_person": _silver(_flat("p_dim", "known_for_titles"), _PERSON_DIM),
    "dim_movie": _silver(
        """SELECT s.movie_id, s.imdb_id, s.tmdb_id, s.ml_id, s.rt_slug, COALESCE(i.primary_title, m.title, t.title, r.title) AS title,
        COALESCE(i.original_title, t.title) AS original_title, COALESCE(i.year, m.year, t.year, r.release_year) AS year,
        i.runtime_minutes AS runtime, r.mpaa_rating, t.plot_summary, t.poster_url, t.backdrop_url, i.is_adult, t.popularity
        FROM spine s LEFT JOIN s_imdb i ON i.imdb_id = s.imdb_id LEFT JOIN s_ml m ON m.ml_id = s.ml_id
        LEFT JOIN s_tmdb t ON t.tmdb_id = s.tmdb_id LEFT JOIN s_rt r ON r.rt_slug = s.rt_slug""",
        _SPINE,
    ),
    "fact_metric_ids": _silver(
        f"""SELECT movie_id, CAST(CASE WHEN h >= {1 << 63} THEN CAST(h AS HUGEINT) - {1 << 64} ELSE CAST(h AS HUGEINT) END AS BIGINT)
        AS metric_id FROM ({_xxh_int(_xxh_int("SELECT movie_id, 42 AS h FROM spine", "movie_id"), RUN_DATE.replace("-", ""))}) x""",
        _SPINE,
    ),
    "fact_metrics": _silver(
        f"""SELECT s.movie_id, {int(RUN_DATE.replace('-', ''))} AS time_id, {_rnd('a.ml_avg_rating', 2)} AS ml_avg_rating, a.ml_rating_count,
        i.imdb_rating, i.imdb_votes, t.tmdb_rating, t.tmdb_votes, t.popularity AS tmdb_popularity, r.tomatometer_score,
        r.audience_score, r.divisive_score, t.budget, t.revenue
        FROM spine s LEFT JOIN s_imdb_ratings i ON i.imdb_id = s.imdb_id LEFT JOIN s_ml_ratings a ON a.ml_id = s.ml_id
        LEFT JOIN s_tmdb t ON t.tmdb_id = s.tmdb_id LEFT JOIN s_rt r ON r.rt_slug = s.rt_slug""",
        _SPINE,
    ),
    "bridge_cast": _silver(
        """SELECT movie_id, person_id, category, ordering, job, characters FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY movie_id, person_id, ordering
          ORDER BY category NULLS LAST, job NULLS LAST, characters NULLS LAST) AS r
        FROM (SELECT s.movie_id, c.person_id, c.category, c.ordering, c.job, c.characters FROM spine s
          JOIN s_principals c ON c.imdb_id = s.imdb_id WHERE c.person_id IN (SELECT person_id FROM p_dim)) t) u WHERE r = 1""",
        f"{_SPINE}, {_PERSON_DIM}",
    ),
    "bridge_genres": _silver(
        "SELECT DISTINCT movie_id, genre_id FROM (" + " UNION ALL ".join(
            f"SELECT movie_id, {_canonical('genre')} AS genre_name FROM spine JOIN "
            f"(SELECT {key}, UNNEST(genres_array) AS genre FROM {table}) x USING ({key})"
            for key, table in [("ml_id", "s_ml"), ("imdb_id", "s_imdb"), ("tmdb_id", "s_tmdb"), ("rt_slug", "s_rt")]
        ) + ") g JOIN g_dim USING (genre_name)",
        f"{_SPINE}, {_GENRE_DIM}",
    ),
}

# --- operators, load and checks ---

_LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_TITLED = "dim_movie WHERE title IS NOT NULL"
_KNOWN_PEOPLE = "(SELECT * FROM dim_person WHERE birth_year IS NOT NULL)"


def _unique(table: str, keys: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'unique_key' AS check_name, COUNT(*) AS violations
      FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1) t"""


def _uniqueness(cast_key: str, person: str = "dim_person") -> str:
    keys = [
        ("dim_time", "time_id"),
        ("dim_genre", "genre_id"),
        ("dim_person", "person_id"),
        ("dim_movie", "movie_id"),
        ("fact_movie_metrics", "metric_id"),
        ("bridge_movie_cast", cast_key),
        ("bridge_movie_genres", "movie_id, genre_id"),
    ]
    return " UNION ALL ".join(_unique(t, k) for t, k in keys)


def _referential() -> str:
    keys = [
        ("fact_movie_metrics", "movie_id", "dim_movie"),
        ("fact_movie_metrics", "time_id", "dim_time"),
        ("bridge_movie_cast", "movie_id", "dim_movie"),
        ("bridge_movie_cast", "person_id", "dim_person"),
        ("bridge_movie_genres", "movie_id", "dim_movie"),
        ("bridge_movie_genres", "genre_id", "dim_genre"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS table_name, '{k} in {p}' AS check_name, COUNT(*) AS violations FROM {c} c
        WHERE NOT EXISTS (SELECT 1 FROM {_KNOWN_PEOPLE if p == 'dim_person' else p} p WHERE p.{k} = c.{k})"""
        for c, k, p in keys
    )


_RANGES = " UNION ALL ".join(
    f"""SELECT 'fact_movie_metrics' AS table_name, '{name}' AS check_name,
    COUNT(CASE WHEN NOT ({rule}) THEN 1 END) AS violations FROM fact_movie_metrics"""
    for name, rule in [
        ("tomatometer_score 0..100", "tomatometer_score BETWEEN 0 AND 100"),
        ("audience_score 0..100", "audience_score BETWEEN 0 AND 100"),
        ("budget >= 0", "budget >= 0"),
        ("revenue >= 0", "revenue >= 0"),
    ]
)
_HAS_ID = """SELECT 'dim_movie' AS table_name, 'has_source_id' AS check_name, COUNT(*) AS violations FROM dim_movie
  WHERE imdb_id IS NULL AND tmdb_id IS NULL AND ml_id IS NULL AND rt_slug IS NULL"""
_PROFILED = [
    "movie_id", "imdb_id", "tmdb_id", "ml_id", "rt_slug", "title", "original_title", "year", "runtime", "mpaa_rating",
    "plot_summary", "poster_url", "backdrop_url", "is_adult", "popularity", "ml_avg_rating", "ml_rating_count",
    "imdb_rating", "imdb_votes", "tmdb_rating", "tmdb_votes", "tmdb_popularity", "tomatometer_score", "audience_score",
    "divisive_score", "budget", "revenue",
]

CHECKS = {
    "dedupe_by_key": f"""SELECT l_orderkey, {_LINE_REST}, l_linenumber FROM (SELECT *,
      ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_REST}) AS r FROM lineitem) t WHERE r = 1""",
    "serial_key": """SELECT ROW_NUMBER() OVER (ORDER BY NULLIF(o_orderpriority, '1-URGENT') NULLS FIRST, o_custkey, o_orderkey) AS row_id,
      o_orderpriority, o_custkey, o_orderkey FROM orders""",
    "enrich_box_office": """SELECT o_orderkey AS id, o_orderpriority, CASE WHEN d.id IS NOT NULL THEN COALESCE(budget, 0) END AS budget,
      revenue FROM orders LEFT JOIN (SELECT l_orderkey AS id,
        CASE WHEN MIN(l_linenumber) > 1 THEN NULL ELSE CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) END AS budget,
        CAST(SUM(CAST(ROUND(l_extendedprice) AS BIGINT)) AS BIGINT) AS revenue FROM lineitem GROUP BY 1) d ON d.id = o_orderkey""",
    "completeness_profile": _star(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) AS total, COUNT({c}) AS filled, "
            f"ROUND(COUNT({c}) * 100.0 / COUNT(*), 2)::DOUBLE AS filled_pct FROM films"
            for c in _PROFILED
        )
    ),
    "warehouse_projection": _star(
        """SELECT m.movie_id, m.title, g.genre_names,
        CASE WHEN f.movie_id % 10 IN (0, 1) THEN NULL ELSE imdb_rating END AS rating, revenue * 100000 AS revenue, budget
        FROM dim_movie m JOIN fact_movie_metrics f ON m.movie_id = f.movie_id
        LEFT JOIN (SELECT movie_id, STRING_AGG(genre_name, ',' ORDER BY genre_name) AS genre_names
          FROM bridge_movie_genres JOIN dim_genre USING (genre_id) GROUP BY movie_id) g ON g.movie_id = m.movie_id"""
    ),
    "sketched_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS total, COUNT({c}) AS filled, COUNT(DISTINCT {c}) AS exact_distinct, TRUE AS distinct_near,
        {"TRUE" if c == "o_totalprice" else "CAST(NULL AS BOOLEAN)"} AS median_near FROM orders"""
        for c in ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    ),
    "quarantine_rows": _star(
        f"""SELECT movie_id, person_id, category, reason, CAST(COUNT(*) AS BIGINT) AS copies FROM (
        SELECT *, CASE WHEN movie_id IS NULL OR person_id IS NULL THEN 'null_key'
          WHEN person_id NOT IN (SELECT person_id FROM {_KNOWN_PEOPLE} k) OR movie_id NOT IN (SELECT movie_id FROM dim_movie) THEN 'orphan'
          WHEN ROW_NUMBER() OVER (PARTITION BY movie_id, person_id ORDER BY category) = 1 THEN 'loaded' ELSE 'duplicate_key' END AS reason
        FROM (SELECT NULLIF(l_orderkey, 7) AS movie_id, l_suppkey AS person_id, l_returnflag AS category FROM lineitem) l) t
        GROUP BY ALL"""
    ),
    "load_manifest": _star(
        """SELECT COUNT(*) AS total_movies, CAST(CEIL(COUNT(*) / 1000.0) AS BIGINT) AS total_chunks, MIN(year) AS first_year,
        MAX(year) AS last_year, 'movie_id,title,year' AS fields, '2024-01-15T00:00:00Z' AS completed_at FROM dim_movie"""
    ),
    "validate_load": _star(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {_TITLED if t == 'dim_movie' else t}"
            for t in ["dim_time", "dim_genre", "dim_person", "dim_movie", "fact_movie_metrics", "bridge_movie_cast", "bridge_movie_genres"]
        )
        + f""" UNION ALL SELECT '_orphan_facts', COUNT(*) FROM fact_movie_metrics f
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {_TITLED}) d WHERE d.movie_id = f.movie_id)"""
    ),
    "orphan_facts": _star(
        f"""SELECT * FROM fact_movie_metrics f
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM {_TITLED}) d WHERE d.movie_id = f.movie_id)"""
    ),
    "dq_uniqueness": _star(_uniqueness("movie_id, person_id")),
    "dq_referential": _star(_referential()),
    "dq_range": _star(_RANGES),
    "dq_has_id": _star(_HAS_ID),
    "constraint_report": _star(
        f"{_uniqueness('movie_id, person_id, ordering')} UNION ALL {_referential()} UNION ALL {_RANGES} UNION ALL {_HAS_ID}"
    ),
    "olap_slice": _star(
        """SELECT year, COUNT(*) AS films, CAST(SUM(revenue) AS BIGINT) AS revenue FROM films
        WHERE mpaa_rating = '5-LOW' GROUP BY year"""
    ),
    "olap_dice": _star(
        """SELECT year, mpaa_rating, COUNT(*) AS films, CAST(SUM(revenue) AS BIGINT) AS revenue FROM films
        WHERE year BETWEEN 1996 AND 1999 AND mpaa_rating IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2"""
    ),
    "olap_rollup": _star(
        """SELECT year, month, day, CAST(3 - GROUPING(year) - GROUPING(month) - GROUPING(day) AS INT) AS level,
        COUNT(*) AS films, CAST(SUM(revenue) AS BIGINT) AS revenue FROM fact_movie_metrics JOIN dim_time USING (time_id)
        GROUP BY ROLLUP (year, month, day)"""
    ),
}

# --- pages ---

_SLUG = "regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1)"
_TEXT = "regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)"
_TEXT = f"regexp_replace({_TEXT}, '<[^>]*>', '', 'g')"
for _entity, _char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")]:
    _TEXT = f"replace({_TEXT}, '{_entity}', '{_char}')"
_TEXT = f"regexp_replace({_TEXT}, '^\\s+|\\s+$', '', 'g')"


def _board(attribute: str) -> str:
    return (
        f"TRY_CAST(regexp_extract(regexp_extract(html, '(?is)<score-board\\b[^>]*>'), "
        f"'(?i)\\b{attribute}=\"\\s*([+-]?\\d+)', 1) AS INT)"
    )


PAGES = {
    "discover_links": """SELECT DISTINCT slug FROM (SELECT UNNEST(regexp_extract_all(html, 'href="/([^"/]+)"', 1)) AS slug FROM pages) t""",
    # The driver's pages hold neither JSON-LD nor label/value items, so these fields stay NULL there.
    "extract_pages": f"""SELECT regexp_replace({_SLUG}, '_(19|20)\\d{{2}}$', '') AS rt_id, {_SLUG} AS slug,
      COALESCE(NULLIF({_TEXT}, ''), {_SLUG}) AS title, {_board('tomatometerscore')} AS tomatometer_score,
      {_board('audiencescore')} AS audience_score, CAST(NULL AS VARCHAR) AS mpaa_rating, CAST(NULL AS VARCHAR) AS box_office,
      CAST(NULL AS VARCHAR) AS release_date, CAST(NULL AS INT) AS release_year, CAST(NULL AS VARCHAR) AS director,
      CAST(NULL AS VARCHAR) AS genre, '2024-01-15T00:00:00Z' AS scraped_at FROM pages""",
}

ORACLE: dict[str, str] = {
    **{
        name: _star(sql)
        for group in (FINANCE, OVERVIEW, GENRES, PEOPLE, TEMPORAL, MOVIES, DASHBOARD)
        for name, sql in group.items()
    },
    **SILVER,
    **SPINE,
    **GOLD,
    **CHECKS,
    **PAGES,
}
