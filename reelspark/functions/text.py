"""Text clean-up and title normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The strings that the sources use for "no value".
NULL_TOKENS = ["\\N", "null", "NULL", "None", ""]

# Script and accent classes, tested in this order; the first hit names the language.
LANGUAGE_PATTERNS = [
    ("English", r"""\A[A-Za-z0-9 .,!?'"-]+\z"""),
    ("Chinese", "[一-鿿]"),
    ("Japanese", "[぀-ヿ]"),
    ("Russian", "[Ѐ-ӿ]"),
    ("French", "[àâäéèêëïîôùûüÿœæç]"),
    ("Spanish", "[áéíóúüñ¿¡]"),
    ("German", "[äöüß]"),
    ("Korean", "[가-힯]"),
]

# Letters, marks and numbers of any script. Spelled out so that it means the same in every regex dialect.
_NOT_WORD_OR_SPACE = r"[^\p{L}\p{M}\p{N}_\s]"
_NOT_ASCII_WORD_OR_SPACE = r"[^\w\s]"
_YEAR_SUFFIX = r"\s*\(\d{4}\)\s*$"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def replace_null_strings(df: DataFrame, null_values: list[str] | None = None) -> DataFrame:
    """Turn null tokens and blank strings of every string column into NULL, in one projection."""
    tokens = NULL_TOKENS if null_values is None else null_values
    targets = set(string_columns(df))
    return df.select(
        *[
            F.when(~(F.col(c).isin(tokens) | (F.trim(F.col(c)) == "")), F.col(c)).alias(c)
            if c in targets
            else F.col(c)
            for c in df.columns
        ]
    )


def clean_whitespace(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Collapse runs of whitespace and trim, on the given columns or on all string columns."""
    targets = set(string_columns(df) if columns is None else columns)
    return df.select(
        *[
            F.trim(F.regexp_replace(F.col(c), r"\s+", " ")).alias(c) if c in targets else F.col(c)
            for c in df.columns
        ]
    )


def split_or_null(c: Column, pattern: str) -> Column:
    """Split a delimited text; NULL and '' give NULL instead of a one-element array."""
    return F.when(c != "", F.split(c, pattern))


def strip_year_suffix(title: Column) -> Column:
    """'Toy Story (1995)' -> 'Toy Story'."""
    return F.regexp_replace(title, _YEAR_SUFFIX, "")


def year_suffix(title: Column) -> Column:
    """'Toy Story (1995)' -> 1995, NULL when there is none."""
    return F.regexp_extract(title, r"\((\d{4})\)\s*$", 1).try_cast("int")


def normalize_title(title: Column, ascii_only: bool = False) -> Column:
    """Join key of a title: lower case, no punctuation, single spaces, no '(YYYY)' suffix.

    By default letters of every script survive and a title without any letter or digit becomes NULL, so
    that such titles never meet in a join. ``ascii_only=True`` keeps ASCII word characters only, leaves the
    digits of the year suffix in place and keeps empty keys.
    """
    if ascii_only:
        kept = F.regexp_replace(F.trim(F.lower(title)), _NOT_ASCII_WORD_OR_SPACE, "")
        return F.trim(F.regexp_replace(kept, r"\s+", " "))
    kept = F.regexp_replace(F.lower(strip_year_suffix(title)), _NOT_WORD_OR_SPACE, "")
    key = F.trim(F.regexp_replace(kept, r"\s+", " "))
    return F.nullif(key, F.lit(""))


def title_language(title: Column) -> Column:
    """Language guess from the characters of a title."""
    (first_name, first_pattern), *rest = LANGUAGE_PATTERNS
    guess = F.when(title.rlike(first_pattern), first_name)
    for name, pattern in rest:
        guess = guess.when(title.rlike(pattern), name)
    return guess.otherwise("Other")


def pad_imdb_id(digits: Column) -> Column:
    """'114709' -> 'tt0114709'. Ids of eight and more digits are kept whole."""
    text = digits.cast("string")
    return F.concat(F.lit("tt"), F.when(F.length(text) < 7, F.lpad(text, 7, "0")).otherwise(text))
