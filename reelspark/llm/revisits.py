"""Not-modified revisits of a web archive, resolved to the full responses they stand for.

A revisit is joined as of its time to the latest strictly earlier full response of its canonical url. Its validators are then
checked, and its permitted headers replace those of the response.

The as-of join has no self-join: captures are split by url and slice of time. Slices end at the approximate quantiles of all times and,
for a url with more than one in HOT of the captures, at those of its own times, so that odd times (0, a far future) don't empty the
slices and a url whose captures all lie close together is spread as well. Only captures of one url at one time stay together. Inside a
slice a running window finds the latest response, and what a slice hands on to the next ones is one row for each url and slice. A url
that holds a third of all captures is thus spread over SLICES tasks, and the rows that meet in one window are SLICES at most. The
quantiles are a part of the plan (one row for all urls, at most HOT rows for hot ones, broadcast by that bound); no job runs while it is built.

Validators: a revisit that names an ETag must agree with the response in it (weakly: W/ is ignored); without ETag in Last-Modified;
without both in the payload digest; without any it is unverified.

Defined cases: captures without url or time resolve to nothing (no_earlier_response); of responses at the same time the largest record_id
is the latest; a NULL header map is empty; names of headers are lower-cased, and of names that differ only by case the last
in order wins; repeated rows are resolved each for itself; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64
HOT = 256  # a url with more than one in so many captures has slices of its own; there are fewer than HOT of them
# Headers that a 304 response may renew (RFC 9110, 15.4.5, and Last-Modified as its metadata for selecting). Fixed values.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that don't select content.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|msclkid|sessionid)(=.*)?$"


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path without trailing slash, sorted parameters without tracking; no scheme, no
    fragment. NULL for NULL."""
    whole = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    rest = F.regexp_replace(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _lower_names(headers: Column) -> Column:
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.lower(e["key"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]), e["value"])))


def merged_headers(full: Column, revisit: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    full, renewed = _lower_names(full), F.map_filter(_lower_names(revisit), lambda k, v: k.isin(*permitted))
    return F.map_concat(F.map_filter(full, lambda k, v: ~F.array_contains(F.map_keys(renewed), k)), renewed)


def _verdict(r: Column, full: Column) -> Column:
    tag = lambda x: F.regexp_replace(F.trim(x), "^W/", "")
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    agrees = (
        F.when(r["etag"].isNotNull(), same(tag(r["etag"]), tag(full["etag"])))
        .when(r["last_modified"].isNotNull(), same(r["last_modified"], full["last_modified"]))
        .when(r["digest"].isNotNull(), same(r["digest"], full["digest"]))
    )
    return (
        F.when(full["record_id"].isNull(), "no_earlier_response")
        .when(agrees.isNull(), "unverified")
        .when(agrees, "resolved")
        .otherwise("validator_mismatch")
    )


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """rows (canonical_url, time, ...) with their slice: how many bounds of their url (or of all urls) their time has passed."""
    bounds = lambda: F.approx_percentile("time", [k / slices for k in range(1, slices)] or [0.5], 1000)
    timed = rows.where("canonical_url is not null and time is not null")
    everyone = timed.agg(F.count("*").alias("n"), bounds().alias("shared"))
    by_url = timed.groupBy("canonical_url").agg(F.count("*").alias("own_n"))
    hot = by_url.where(F.col("own_n") * HOT > everyone.select("n").scalar()).select("canonical_url")
    own = timed.join(F.broadcast(hot), "canonical_url").groupBy("canonical_url").agg(bounds().alias("own_bounds"))
    split = rows.withColumn("shared", everyone.select("shared").scalar()).join(F.broadcast(own), "canonical_url", "left")
    passed = F.size(F.filter(F.coalesce("own_bounds", "shared"), lambda b: b < F.col("time")))
    return split.withColumn("slice", F.coalesce(passed, F.lit(0))).drop("own_bounds", "shared")


def resolve_revisits(captures: DataFrame, payloads: bool = False, slices: int = SLICES) -> DataFrame:
    """record_id, canonical_url, time, source_id, status, headers [, payload] of every revisit.

    captures: record_id, url, time (bigint), kind (response or revisit), etag, last_modified, digest, headers
    (map<string,string>) and, for payloads, payload. source_id, headers and payload are NULL unless resolved or unverified.
    """
    fields = ("record_id", "etag", "last_modified", "digest", "headers")
    rows = captures.where(F.col("kind").isin("response", "revisit")).select(
        canonical_url(F.col("url")).alias("canonical_url"), F.col("time").cast("bigint").alias("time"), "kind", F.struct(*fields).alias("own")
    )
    rows = _sliced(rows, slices)
    usable = F.col("canonical_url").isNotNull() & F.col("time").isNotNull()
    full = F.when((F.col("kind") == "response") & usable, F.col("own"))
    # A response at the time of a revisit isn't earlier: revisits come first.
    inside = Window.partitionBy("canonical_url", "slice").orderBy("time", F.col("kind") == "response", "own.record_id")
    handed = rows.where(usable & (F.col("kind") == "response")).groupBy("canonical_url", "slice")
    handed = handed.agg(F.max_by("own", F.struct("time", "own.record_id")).alias("last"))
    # The last response of a slice reaches the following slices of its url until another one takes over.
    over = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    present = rows.where(usable).select("canonical_url", "slice").distinct()
    before = present.join(handed, ["canonical_url", "slice"], "left").withColumn("before", F.last("last", ignorenulls=True).over(over))
    found = rows.withColumn("here", F.last(full, ignorenulls=True).over(inside)).where("kind = 'revisit'")
    found = found.join(before.select("canonical_url", "slice", "before"), ["canonical_url", "slice"], "left")
    found = found.withColumn("full", F.coalesce("here", "before")).withColumn("status", _verdict(F.col("own"), F.col("full")))
    good = F.col("status").isin("resolved", "unverified")
    out = found.select(
        "own.record_id",
        "canonical_url",
        "time",
        F.when(good, F.col("full.record_id")).alias("source_id"),
        "status",
        F.when(good, merged_headers(F.col("full.headers"), F.col("own.headers"))).alias("headers"),
    )
    if not payloads:
        return out
    stored = captures.where("kind = 'response'").select(F.col("record_id").alias("source_id"), "payload")
    return out.join(stored, "source_id", "left").select(*out.columns, "payload")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Archive captures that follow from a table of pages: each page is fetched in full once and asked for twice more, first
    unchanged, then with another ETag or only a date where its id says so."""
    fetched = F.pmod(F.col("page_id") * 7919, F.lit(1_000_000)).cast("bigint")
    digest, length = F.md5(F.coalesce("html", F.lit(""))), F.length(F.coalesce("html", F.lit(""))).cast("string")
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    day = lambda t: F.concat(F.lit("day "), (t / 1000).cast("bigint").cast("string"))
    name = lambda **kv: F.create_map(*(x for k, v in kv.items() for x in (F.lit(k.replace("_", "-")), v)))
    page, later, last = F.col("page_id"), fetched + 5000, fetched + 90000

    def capture(record_id, time, kind, etag=None, last_modified=None, digest=None, headers=None) -> Column:
        values = {"etag": etag, "last_modified": last_modified, "digest": digest}
        texts = (F.coalesce(F.lit(None).cast("string") if v is None else v, F.lit(None)).cast("string").alias(k) for k, v in values.items())
        return F.struct(record_id.alias("record_id"), time.alias("time"), F.lit(kind).alias("kind"), *texts, headers.alias("headers"))

    versions = F.array(
        capture(page * 3, fetched, "response", tag, day(fetched), digest, name(Date=day(fetched), ETag=tag, Content_Length=length, Content_Type=F.lit("text/html"))),
        capture(page * 3 + 1, later, "revisit", F.concat(F.lit("W/"), tag), headers=name(Date=day(later), ETag=tag, Content_Length=F.lit("0"), Cache_Control=F.lit("max-age=60"))),
        capture(
            page * 3 + 2, last, "revisit", F.when(page % 4 == 1, F.lit('"changed"')), F.when(page % 4 == 2, day(fetched)), F.when(page % 4 == 3, digest),
            name(Date=day(last), Server=F.lit("s")),
        ),
    )
    return pages.select("url", F.inline(versions))
