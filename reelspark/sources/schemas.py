"""Declared schemas of the raw files. Nothing is inferred. Money is bigint: int would turn large sums into NULL."""

from __future__ import annotations

MOVIELENS = {
    "ratings": "userId int, movieId int, rating float, timestamp bigint",
    "movies": "movieId int, title string, genres string",
    "tags": "userId int, movieId int, tag string, timestamp bigint",
    "links": "movieId int, imdbId string, tmdbId int",
}


def _strings(*names: str) -> str:
    return ", ".join(f"{n} string" for n in names)


IMDB = {
    "title.basics": _strings(
        "tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear", "endYear", "runtimeMinutes", "genres"
    ),
    "title.ratings": _strings("tconst", "averageRating", "numVotes"),
    "name.basics": _strings("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
    "title.principals": _strings("tconst", "ordering", "nconst", "category", "job", "characters"),
    "title.crew": _strings("tconst", "directors", "writers"),
    "title.akas": _strings(
        "titleId", "ordering", "title", "region", "language", "types", "attributes", "isOriginalTitle"
    ),
    "title.episode": _strings("tconst", "parentTconst", "seasonNumber", "episodeNumber"),
}

TMDB_MOVIES = (
    "id int, title string, original_title string, overview string, poster_path string, backdrop_path string, "
    "release_date string, popularity double, vote_average double, vote_count int, genre_ids array<int>, "
    "original_language string, adult boolean, video boolean, budget bigint, revenue bigint"
)

RT_MOVIES = (
    "rt_id string, slug string, title string, tomatometer_score int, audience_score int, mpaa_rating string, "
    "box_office string, release_date string, release_year int, director string, genre string, scraped_at string"
)
