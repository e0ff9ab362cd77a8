"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text. Elements that never belong to an article (menus, footers, sidebars,
forms, scripts, notices, adverts, comments) are left out; outside an article, and at its ends, they become runs of empty lines. A
sliding window adds up the text lengths of BLOCK lines; text starts at a surge of that sum and ends at a dive to zero. Text of links
doesn't count towards the sums. The sum has to pass a threshold, or half the largest sum of the page where that is less. A line inside
<article> or <main> that has text besides links counts ARTICLE characters more: the element is a weight, too little to pass the
threshold by itself, and the sums choose the text inside and outside of it. Lines of the element that touch chosen ones belong to them,
short ones and links too, as headings and last lines are.

A class or id that is one of MARKS leaves its element out. One that is made of several words, one of them in MARKS (`site-footer`), does so
outside an article; inside, only if its other words are furniture as well (`share-buttons`, but not `market-share`).

Defined cases: NULL or empty html gives an empty text; unclosed elements end at the next article or at the end of their parent;
white space (also no-break spaces) collapses; repeated pages are extracted each for itself; an empty table gives no rows; page_id and
url pass through as they are, NULLs included, and other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK = 3
THRESHOLD = 120
ARTICLE = THRESHOLD // (BLOCK + 1)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|title|object|canvas|math)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
MARK = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav footer aside form head button select menu dialog fieldset datalist option".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer comment comments disqus cookie cookies consent notice popup modal newsletter subscribe subscription "
    "related share sharing social widget toolbar pagination contentinfo complementary search".split()
)
# What stands beside a word of MARKS in the names of elements that aren't text.
FURNITURE = MARKS | frozenset(
    "area articles bar block bottom box button buttons card column container content count form global group header icon icons inner item items label "
    "left link links list main mobile page panel posts primary right row secondary section signup site slot stories thread title top "
    "unit wrap wrapper".split()
)
PAGE_HEADER = frozenset("header masthead".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())


def _marked(attributes: str, article: bool) -> set[str]:
    """Words of the class, id, role and label of an element; inside an article those of furniture alone."""
    if "=" not in attributes:
        return set()
    names = [n for m in MARK.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()]
    words = [[w for w in re.split(r"[_-]+", n) if w] for n in names]
    return {w for ws in words if not article or len(ws) == 1 or all(w in FURNITURE or w.isdigit() for w in ws) for w in ws}


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, length without link text, inside an article) of each line in page order; gaps are runs of empty lines."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    links: list[str] = []
    article = link = 0
    gap = [("", 0, False)] * BLOCK
    skipped, depth = "", 0  # the element that is being left out, and how many of its kind are open

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape(" ".join(links)).split())) if links else 0
                lines.append((text, max(len(text) - linked, 0), article > 0))
            parts.clear()
            links.clear()

    def data(text: str) -> None:
        if text and not skipped:
            parts.append(text)
            if link:
                links.append(text)

    at = 0
    for m in TOKEN.finditer(page):
        data(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if m[1] and not skipped and m[1].lower() == "noscript":
                flush()
            continue
        closing, block = bool(m[2]), name not in INLINE
        if skipped:
            if name == skipped:
                depth += -1 if closing else 0 if skipped in SELF_CLOSING else 1
                if depth <= 0 or (not closing and skipped in SELF_CLOSING):
                    skipped = ""
                if closing or skipped:
                    continue
            elif skipped in SELF_CLOSING and block:
                skipped = ""
            elif name in ("article", "main") and not closing and skipped not in ("aside", "footer"):
                skipped = ""  # an unclosed menu doesn't swallow the article
            elif name in ("article", "main", "body") and closing:
                skipped = ""
            else:
                continue
        if block:
            flush()
        if closing:
            if name in ("article", "main"):
                article = max(article - 1, 0)
                if not article:
                    lines.extend(gap)
            elif name == "a":
                link = max(link - 1, 0)
            continue
        marks = _marked(m[4], article > 0)
        if name in NEVER or (
            name not in ("article", "main", "body", "html") or "comment" in marks
        ) and (marks & MARKS or (not article and (name in PAGE_HEADER or marks & PAGE_HEADER))):
            flush()
            if not article:
                lines.extend(gap)
            if name not in VOID:
                skipped, depth = name, 1
        elif name in ("article", "main"):
            if not article:
                lines.extend(gap)
            article += 1
        elif name == "a":
            link += 1
    data(page[at:])
    flush()
    return lines


def main_text(page: str | None, threshold: int = THRESHOLD) -> str:
    lines = page_lines(page or "")
    n = len(lines)
    weight = [w + ARTICLE if w and inside else w for _, w, inside in lines]
    sums = [sum(weight[i : i + BLOCK]) for i in range(n)]
    surge = min(threshold, max(sums, default=0) / 2)
    beside = lambda k: 0 <= k < n and lines[k][2] and lines[k][0]
    kept, i, end = [], 0, 0
    while i < n:
        if weight[i] > 0 and sums[i] > surge:
            first = i
            while first > end and beside(first - 1):
                first -= 1
            while i < n and (sums[i] > 0 or beside(i)):
                i += 1
            end = i
            kept.extend(lines[k][0] for k in range(first, end) if lines[k][0])
        else:
            i += 1
    return " ".join(kept)


def extract_pages(pages: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    chosen = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, threshold) for x in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType for f in chosen.schema.fields}
    out = T.StructType([T.StructField(c, kinds[c]) for c in ("page_id", "url")])
    return chosen.mapInArrow(run, out.add("text", T.StringType()).add("n_chars", T.LongType()))
