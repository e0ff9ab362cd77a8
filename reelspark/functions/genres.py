"""Genre vocabulary: id lookup and canonical names."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# TMDB genre ids.
TMDB_GENRES = {
    28: "Action",
    12: "Adventure",
    16: "Animation",
    35: "Comedy",
    80: "Crime",
    99: "Documentary",
    18: "Drama",
    10751: "Family",
    14: "Fantasy",
    36: "History",
    27: "Horror",
    10402: "Music",
    9648: "Mystery",
    10749: "Romance",
    878: "Science Fiction",
    10770: "TV Movie",
    53: "Thriller",
    10752: "War",
    37: "Western",
}

# Spellings (upper case) with a canonical name that title-casing would not give. None drops the genre.
GENRE_SYNONYMS = {
    "SCI-FI": "Science Fiction",
    "SCIENCE FICTION": "Science Fiction",
    "SCIFI": "Science Fiction",
    "CHILDREN": "Family",
    "KIDS & FAMILY": "Family",
    "CHILDREN'S": "Family",
    "FILM-NOIR": "Film Noir",
    "FILM NOIR": "Film Noir",
    "MUSICAL": "Music",
    "WAR": "War",
    "IMAX": "IMAX",
    "(NO GENRES LISTED)": None,
}


def _literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(entries.items())])


def genre_names_from_ids(genre_ids: Column) -> Column:
    """Array of TMDB ids -> array of names; an id outside the vocabulary reads 'Unknown(<id>)'."""
    names = _literal_map(TMDB_GENRES)
    return F.transform(
        genre_ids,
        lambda i: F.coalesce(names[i], F.concat(F.lit("Unknown("), i.cast("string"), F.lit(")"))),
    )


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, so that 'reality-tv' gives 'Reality-Tv' (initcap stops at spaces only)."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def canonical_genre(genre: Column) -> Column:
    """Canonical genre name, NULL for a missing genre and for the 'nothing listed' marker."""
    stripped = F.regexp_replace(genre, r"^\s+|\s+$", "")
    key = F.upper(stripped)
    renamed = {k: v for k, v in GENRE_SYNONYMS.items() if v is not None}
    dropped = [k for k, v in GENRE_SYNONYMS.items() if v is None]
    return F.when(~key.isin(dropped), F.coalesce(_literal_map(renamed)[key], title_case(stripped)))


def is_mapped_genre(genre: Column) -> Column:
    """True when the spelling is in the synonym list or is already a canonical vocabulary name."""
    key = F.upper(F.regexp_replace(genre, r"^\s+|\s+$", ""))
    known = sorted(set(GENRE_SYNONYMS) | {n.upper() for n in TMDB_GENRES.values()})
    return key.isin(known)
