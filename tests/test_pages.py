"""Page extraction, branch by branch."""

import random

import pytest
from pyspark.sql import functions as F

from reelspark.sources.pages import _ITEM, discover_links, elements, extract_movies
from reelspark.sources.readers import read_pages

JSON_LD = """<html><script type="application/ld+json">{"name": "Dune", "director": [{"name": "A B"}, {"x": 1}, {"name": "C D"}],
 "dateCreated": "released 1984-12-14", "contentRating": "PG-13", "genre": ["Sci-Fi", "Drama"], "aggregateRating": {"ratingValue": "40%"}}</script>
<score-board audiencescore="65" tomatometerscore="99"></score-board>
<ul><li><b>Box Office (Gross USA):</b> <span>$30.9M</span></li><li><b>Director:</b><span>Nobody</span></li></ul></html>"""
BROKEN = """<script type="application/ld+json">{"name": "Dune", </script><h1 class="t"> Tom &amp; <i>Jerry</i> </h1>
<ScOrE-Board tomatometerscore="77" audiencescore=""></score-board>
<div data-qa="movie-info-item"><div data-qa="movie-info-item-label">Release Date (Theaters):</div></div>
<li><dt>In Theaters</dt><dd>Mar 3, 2001</dd></li><li><dt>Rating</dt><dd>R</dd></li><li><b>Director</b><span> X Y </span></li>"""
ONE_DIRECTOR = """<script type="application/ld+json">{"name": "", "director": {"name": "Solo"}, "genre": []}</script>"""
OLD = """<script type="application/ld+json">{"name": "Old", "dateCreated": "1949-01-01"}</script>"""


@pytest.fixture(scope="module")
def records(spark):
    pages = [
        (1, "https://x.org/m/dune_1984?x=1", JSON_LD),
        (2, "https://x.org/m/tom", BROKEN),
        (3, "https://x.org/m/solo_2018", ONE_DIRECTOR),
        (4, "https://x.org/m/old", OLD),
        (5, "https://x.org/m/bare", "<p>nothing</p>"),
    ]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    return {r.slug: r for r in extract_movies(df, scraped_at="now").collect()}


def test_structured_data_wins(records):
    r = records["dune_1984"]
    assert (r.rt_id, r.title, r.director, r.release_date, r.release_year) == ("dune", "Dune", "A B, C D", "released 1984-12-14", 1984)
    assert (r.mpaa_rating, r.genre, r.tomatometer_score, r.audience_score) == ("PG-13", "Sci-Fi, Drama", 40, 65)
    assert r.box_office == "$30.9M" and r.scraped_at == "now"


def test_fallbacks(records):
    r = records["tom"]
    assert (r.title, r.tomatometer_score, r.audience_score) == ("Tom & Jerry", 77, None)
    assert (r.release_date, r.release_year, r.mpaa_rating, r.director) == ("Mar 3, 2001", 2001, "R", "X Y")
    assert (records["solo_2018"].title, records["solo_2018"].director, records["solo_2018"].genre) == ("solo_2018", "Solo", None)
    assert records["bare"].title == "bare" and records["bare"].box_office is None


def test_old_films_are_dropped(records):
    assert "old" not in records and len(records) == 4


def test_links(spark):
    html = '<a href="/m/a"></a><a href="/m/b/reviews"></a><a href="/m/a"></a><a href="/tv/c"></a><a href="/m/d_2001">'
    df = spark.createDataFrame([(html,), ('<a href="/m/a">',)], "html string")
    assert sorted(r.slug for r in discover_links(df).collect()) == ["a", "d_2001"]


def test_saved_pages(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "dune_1984.html").write_text(JSON_LD)
    r = extract_movies(read_pages(spark, str(tmp_path / "m")), r"/m/([^/?#.]+)").first()
    assert (r.slug, r.title, r.release_year) == ("dune_1984", "Dune", 1984)


def test_items_end_at_their_own_closing_tags(spark):
    probe = '<div class="info-item"><div class="info-item-label">Director</div><div class="info-item-value">Jane X</div></div>'
    nested = '<ul><li><b>Box Office</b><ul><li>x</li></ul><span>$<span>5</span>M</span></li><li>A<br><b>Rating</b> <span class="q">PG</span></li></ul>'
    repeated = '<li><b>Director</b><span>Al</span><b>Director</b><span>Al</span></li>'
    hidden = '<!-- <li><b>Rating</b><span>X</span></li> --><script>"<li><b>Rating</b><span>Y</span></li>"</script><li><b>Rating</b><span>R'
    df = spark.createDataFrame([(f"https://x/m/{i}", h) for i, h in enumerate((probe, nested, repeated, hidden, None))], "url string, html string")
    got = {r.slug: r for r in extract_movies(df).collect()}
    assert got["0"].director == "Jane X" and (got["1"].box_office, got["1"].mpaa_rating) == ("$5M5", "PG")
    assert got["2"].director == "AlAl" and got["3"].mpaa_rating == "R" and got["4"].title == "4"


def test_elements_of_random_markup(spark):
    rng = random.Random(3)
    tags = ["div", "li", "b", "span", 'div class="x"', 'p data-qa="movie-info-item"', 'div class="a info-item z"']
    wanted = {"li", 'p data-qa="movie-info-item"', 'div class="a info-item z"'}

    def tree(depth):
        """Markup, and the inner markup of the wanted elements in it, in page order."""
        text, found = "", []
        for _ in range(rng.randint(0, 4)):
            if depth == 0 or rng.random() < 0.4:
                text += rng.choice(["t", "a b", "<br>", "<img src=x/>", "&lt;", "5 < 6 "])
                continue
            tag = rng.choice(tags)
            inner, below = tree(depth - 1)
            found += ([inner] if tag in wanted else []) + below
            text += f"<{tag}>{inner}</{tag.split()[0].upper()}>"
        return text, found

    cases = [tree(5) for _ in range(300)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, html string")
    got = {r.i: r.found for r in df.select("i", elements(F.col("html"), _ITEM).alias("found")).collect()}
    assert all(got[i] == found for i, (_, found) in enumerate(cases)) and any(len(f) > 5 for _, f in cases)
