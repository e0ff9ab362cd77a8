"""Link discovery and movie records from a table of fetched HTML pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINK_PATTERN = r'href="/m/([^"/]+)"'
SLUG_PATTERN = r"/m/([^/?#]+)"
FIRST_YEAR = 1950

_YEAR = r"\b(19\d{2}|20\d{2})\b"
_JSON_LD = r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
_H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"
_SCORE_BOARD = r"(?is)<score-board\b[^>]*>"


def _opens(tags: str, mark: str) -> str:
    """Pattern of an opening tag of one of the tags, or of any tag with the data-qa mark or its class."""
    marked = rf'data-qa="movie-{mark}"|class="(?:[^"]*\s)?{mark}(?:\s[^"]*)?"'
    return rf"(?is)^<(?:(?:{tags})(?=[\s/>])|\w[^>]*\s(?:{marked}))"


_ITEM = _opens("li", "info-item")
_LABEL = _opens("dt|b", "info-item-label")
_VALUE = _opens("dd|span|time", "info-item-value")
# Elements that have no closing tag.
_VOID = "area base br col embed hr img input link meta source track wbr".split()
_TOKENS = r"(?s)<[A-Za-z/!?][^>]*>|[^<]+|<"
_NO_MARKUP = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"

# Directors come as one object or as a list, so the field is kept as JSON text first.
_RECORD_SCHEMA = (
    "name string, director string, dateCreated string, contentRating string, genre array<string>, "
    "aggregateRating struct<ratingValue: string>"
)

# The entities that occur in running text; the ampersand comes last, so that nothing is decoded twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def discover_links(pages: DataFrame, pattern: str = LINK_PATTERN) -> DataFrame:
    """Distinct slugs that the pages link to; ``pattern`` captures the slug and excludes nested paths."""
    found = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    return pages.select(F.explode(F.array_distinct(found)).alias("slug")).where(F.col("slug") != "").distinct()


def rt_id_of(slug: Column) -> Column:
    """Slug without its year suffix."""
    return F.regexp_replace(slug, r"_(19|20)\d{2}$", "")


def plain_text(markup: Column) -> Column:
    """Text of a piece of markup: tags dropped, common entities decoded, trimmed."""
    text = F.regexp_replace(markup, r"<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """First match, NULL instead of '' when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _leading_int(text: Column) -> Column:
    return _found(text, r"^\s*([+-]?\d+)").try_cast("int")


def _non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _director_names(director_json: Column) -> Column:
    many = F.from_json(director_json, "array<struct<name: string>>")
    one = F.from_json(director_json, "struct<name: string>")
    people = F.when(F.ltrim(director_json).startswith("["), many["name"]).otherwise(F.array(one["name"]))
    return F.array_join(F.filter(people, lambda n: n.isNotNull() & (n != "")), ", ")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def elements(markup: Column, opening: str) -> Column:
    """Inner markup of every element whose opening tag matches, nested ones too, in page order.

    The markup is cut into tags and text, and folded once. Every open element that was asked for counts the elements of its own name inside, and ends
    at its own closing tag; one that is never closed ends with the markup. Self-closed and void elements are empty. NULL reads as
    no markup."""

    def token(t: Column, i: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][\w:-]*)", 1))
        empty = (name == "") | name.isin(*_VOID) | t.endswith("/>")
        kind = F.when((name != "") & t.startswith("</"), -1).when(empty, 0).otherwise(1)
        return F.struct(i.alias("at"), name.alias("name"), kind.alias("kind"), (t.rlike(opening) & (name != "")).alias("wanted"))

    def fold(state: Column, t: Column) -> Column:
        inner = lambda e: F.struct(e["name"].alias("name"), (e["depth"] + F.when(e["name"] == t["name"], t["kind"]).otherwise(0)).alias("depth"), e["at"].alias("at"))
        held = F.transform(state["open"], inner)
        span = lambda at: F.struct(at.alias("first"), t["at"].alias("last"))
        new = F.array(F.struct(t["name"].alias("name"), F.lit(1).alias("depth"), t["at"].alias("at")))
        none = F.slice(new, 1, 0)
        closed = F.transform(F.filter(held, lambda e: e["depth"] == 0), lambda e: span(e["at"]))
        return (
            F.when((t["kind"] == 1), F.struct(F.concat(held, F.when(t["wanted"], new).otherwise(none)).alias("open"), state["done"].alias("done")))
            .when(t["kind"] == -1, F.struct(F.filter(held, lambda e: e["depth"] > 0).alias("open"), F.concat(state["done"], closed).alias("done")))
            .when(t["wanted"], F.struct(state["open"].alias("open"), F.concat(state["done"], F.array(span(t["at"]))).alias("done")))
            .otherwise(state)
        )

    def cut(tokens: Column) -> Column:
        start = F.struct(F.array().cast("array<struct<name: string, depth: int, at: int>>").alias("open"), F.array().cast("array<struct<first: int, last: int>>").alias("done"))
        folded = F.aggregate(F.transform(tokens, token), start, fold)
        spans = _let(folded, lambda s: F.concat(s["done"], F.transform(s["open"], lambda e: F.struct(e["at"].alias("first"), F.size(tokens).alias("last")))))
        return F.transform(F.array_sort(spans), lambda e: F.array_join(F.slice(tokens, e["first"] + 2, F.greatest(e["last"] - e["first"] - 1, F.lit(0))), ""))

    plain = F.regexp_replace(F.coalesce(markup, F.lit("")), _NO_MARKUP, "")
    return _let(F.regexp_extract_all(plain, F.lit(_TOKENS), F.lit(0)), cut)


def _text_of(item: Column, opening: str) -> Column:
    """Text of the elements of an item, put together."""
    return plain_text(F.array_join(elements(item, opening), ""))


def _first_value(items: Column, *labels: str) -> Column:
    def wanted(i: Column) -> Column:
        hit = i["label"].contains(labels[0])
        for other in labels[1:]:
            hit = hit | i["label"].contains(other)
        return hit & (i["value"] != "")

    return F.get(F.filter(items, wanted), F.lit(0))["value"]


def extract_movies(
    pages: DataFrame, slug_pattern: str = SLUG_PATTERN, first_year: int = FIRST_YEAR, scraped_at: str | None = None
) -> DataFrame:
    """One movie record per page.

    Structured data (JSON-LD) comes first; the heading, the score board and the label/value items fill what it
    leaves open; the slug is the last resort for a title. Malformed JSON-LD reads as absent. Movies known to be
    older than ``first_year`` are dropped.
    """
    slug = F.regexp_extract("url", slug_pattern, 1)
    parsed = pages.select(
        slug.alias("slug"),
        F.from_json(_found(F.col("html"), _JSON_LD), _RECORD_SCHEMA).alias("ld"),
        plain_text(F.regexp_extract("html", _H1, 1)).alias("heading"),
        F.regexp_extract("html", _SCORE_BOARD, 0).alias("board"),
        F.transform(
            elements(F.when(F.col("html").rlike(_ITEM.replace("^<", "<", 1)), F.col("html")), _ITEM),
            lambda item: F.struct(F.lower(_text_of(item, _LABEL)).alias("label"), _text_of(item, _VALUE).alias("value")),
        ).alias("items"),
    )
    ld, items = F.col("ld"), F.col("items")
    ld_date = _non_empty(ld["dateCreated"])
    item_date = _first_value(items, "release date", "in theaters")
    release_date = F.coalesce(ld_date, item_date)
    record = F.struct(
        rt_id_of(F.col("slug")).alias("rt_id"),
        F.col("slug"),
        F.coalesce(_non_empty(ld["name"]), _non_empty(F.col("heading")), F.col("slug")).alias("title"),
        F.coalesce(
            _leading_int(ld["aggregateRating"]["ratingValue"]),
            _leading_int(F.regexp_extract("board", r'(?i)\btomatometerscore="([^"]*)"', 1)),
        ).alias("tomatometer_score"),
        _leading_int(F.regexp_extract("board", r'(?i)\baudiencescore="([^"]*)"', 1)).alias("audience_score"),
        F.coalesce(_non_empty(ld["contentRating"]), _first_value(items, "rating")).alias("mpaa_rating"),
        _first_value(items, "box office").alias("box_office"),
        release_date.alias("release_date"),
        _found(release_date, _YEAR).try_cast("int").alias("release_year"),
        F.coalesce(_non_empty(_director_names(ld["director"])), _first_value(items, "director")).alias("director"),
        _non_empty(F.array_join(ld["genre"], ", ")).alias("genre"),
        F.lit(scraped_at).alias("scraped_at"),
    )
    # The year test sits inside the generator: as a filter it would be pushed below the extraction and make the
    # scan parse every page a second time.
    recent = F.filter(F.array(record), lambda r: r["release_year"].isNull() | (r["release_year"] >= first_year))
    return parsed.select(F.inline(recent))
