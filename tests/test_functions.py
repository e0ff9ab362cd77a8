"""Column expressions, one case per documented edge."""

import pytest
from pyspark.sql import functions as F

from reelspark.functions.genres import canonical_genre, genre_names_from_ids, is_mapped_genre
from reelspark.functions.money import parse_box_office, revenue_multiple, round_half_up
from reelspark.functions.text import (
    clean_whitespace,
    normalize_title,
    pad_imdb_id,
    replace_null_strings,
    title_language,
)


def _apply(spark, function, values, ctype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ctype}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_box_office(spark):
    texts = ["$100M", "$1.2B", "$950K", "$12,345,678", "", " ", None, "n/a", "$8.2M", "$8.2m ", "$0.0000019M"]
    whole = [100_000_000, 1_200_000_000, 950_000, 12_345_678, None, None, None, None, 8_200_000, 8_200_000, 1]
    assert _apply(spark, parse_box_office, texts) == whole
    assert _apply(spark, lambda c: parse_box_office(c, exact=False), ["$8.2M", "$100M"]) == [8_199_999, 100_000_000]


def test_genre_ids(spark):
    got = _apply(spark, genre_names_from_ids, [[10751, 14, 16, 10749], [99999], [], None], "array<int>")
    assert got == [["Family", "Fantasy", "Animation", "Romance"], ["Unknown(99999)"], [], None]


def test_canonical_genre(spark):
    raw = ["Sci-Fi", "Children", "Kids & Family", "Film-Noir", "Musical", "(no genres listed)", "reality-tv", "TV Movie", None, " drama ", "war", "imax"]
    want = ["Science Fiction", "Family", "Family", "Film Noir", "Music", None, "Reality-Tv", "Tv Movie", None, "Drama", "War", "IMAX"]
    assert _apply(spark, canonical_genre, raw) == want
    # The title rule equals that of Python's str.title() on these spellings.
    words = ["it's a-b c", "CAPS here", "été à nice", "3d film"]
    assert _apply(spark, canonical_genre, words) == [w.title() for w in words]
    assert _apply(spark, is_mapped_genre, ["Drama", "sci-fi", "Reality-TV"]) == [True, True, False]


def test_title_key(spark):
    titles = ["Amélie", "千と千尋の神隠し", "Toy Story (1995)", "  Se7en:  The   Movie! ", "???", None, "Don't_Look"]
    assert _apply(spark, normalize_title, titles) == [
        "amélie", "千と千尋の神隠し", "toy story", "se7en the movie", None, None, "dont_look",
    ]
    ascii_keys = _apply(spark, lambda c: normalize_title(c, ascii_only=True), titles)
    assert ascii_keys == ["amlie", "", "toy story 1995", "se7en the movie", "", None, "dont_look"]


def test_language(spark):
    titles = ["Amélie", "千と千尋", "Война", "기생충", "Inception", "となりの", "El niño", "Der Fluß", "naïve", "Line\nbreak", "Tail\n"]
    want = ["French", "Chinese", "Russian", "Korean", "English", "Japanese", "Spanish", "German", "French", "Other", "Other"]
    assert _apply(spark, title_language, titles) == want


def test_imdb_id(spark):
    assert _apply(spark, pad_imdb_id, ["114709", "10872600", None]) == ["tt0114709", "tt10872600", None]


def test_null_strings_and_whitespace(spark):
    df = spark.createDataFrame([(1, "\\N", " a\t b "), (2, "None", ""), (3, "  ", "x"), (4, "ok", None)], "i int, a string, b string")
    assert [tuple(r) for r in replace_null_strings(df).orderBy("i").collect()] == [
        (1, None, " a\t b "), (2, None, None), (3, None, "x"), (4, "ok", None),
    ]
    assert [r.b for r in clean_whitespace(df).orderBy("i").collect()] == ["a b", "", "x", None]
    assert [r.b for r in clean_whitespace(df, ["a"]).orderBy("i").collect()][0] == " a\t b "


@pytest.mark.parametrize("x,scale,want", [(1.005, 2, 1.01), (2.5, 0, 3.0), (-2.5, 0, -3.0), (1.004999, 2, 1.0)])
def test_rounding(spark, x, scale, want):
    assert _apply(spark, lambda c: round_half_up(c, scale), [x], "double") == [want]


def test_multiple_of_zero_budget(spark):
    df = spark.createDataFrame([(5, 0), (5, 2)], "revenue bigint, budget bigint")
    assert [r[0] for r in df.select(revenue_multiple(F.col("revenue"), F.col("budget"))).collect()] == [None, 2.5]
