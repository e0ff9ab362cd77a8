"""URL rules decided by Bloom filter cascades.

A rule is an action, a host and a path prefix; it fits its host and all subdomains. The keys of a url are all its host suffixes
joined with its path prefixes of the lengths that rules have. For each action a cascade answers, exactly and without a join, which
keys of the corpus are listed: level 1 is a Bloom filter of the listed keys, level 2 of the corpus keys that pass level 1 without
being listed, level 3 of the listed keys that pass level 2, and so on until no error is left. Only the keys that pass level 1 by
mistake are ever stored; the other keys of the corpus are settled by level 1 itself.

Filters are sent to all tasks, so their size is checked: beyond `max_filter_bytes` the keys are looked up by a shuffled join instead.

Defined cases: a NULL url, or one without "://", has an empty host and path; the longest fitting rule wins, among rules of one length
the one with the longer host; a key listed under both actions is blocked; without rules everything takes `default`; NULLs in rules are
dropped; repeated rows and page ids are judged each for itself; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.session import cut_lineage

SEED = 42  # of Spark's xxhash64, so that both sides hash a key alike
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ACTIONS = ("block", "allow")


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: str, path: str, lengths: Iterable[int]) -> list[tuple[str, str]]:
    """(host suffix, path prefix) pairs a rule could have, longest rule first."""
    suffixes, at = [host] if host else [], 0
    while (at := host.find(".", at)) >= 0:
        at += 1
        if at < len(host):
            suffixes.append(host[at:])
    pairs = [(s, path[:n]) for s in suffixes for n in lengths if n <= len(path)]
    return sorted(pairs, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))


def key_hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), SEED)


def level_hash(h: int, level: int) -> int:
    """A hash of its own for each level, else two keys that collide once would collide on all levels. As Spark's xxhash64(h, level)."""
    first = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), SEED)
    return xxhash.xxh64_intdigest(level.to_bytes(8, "little"), first)


@dataclass(frozen=True)
class Bloom:
    bits: np.ndarray  # uint64 words
    size: int  # in bits
    hashes: int
    level: int

    def __contains__(self, h: int) -> bool:
        h = level_hash(h, self.level)
        low, step = h & 0xFFFFFFFF, (h >> 32) | 1
        return all(int(self.bits[(p := (low + i * step) % self.size) >> 6]) >> (p & 63) & 1 for i in range(self.hashes))


def _positions(hashes: int, size: int) -> Column:
    """The bit positions of a level's hash `h`, as in Bloom.__contains__."""
    low, step = F.expr("h & 4294967295L"), F.expr("shiftrightunsigned(h, 32) | 1L")
    return F.array(*((low + i * step) % size for i in range(hashes)))


def bloom(keys: DataFrame, count: int, bits_per_key: float, level: int) -> Bloom:
    """A filter of the hashes in column h. Bits are combined in the cluster; the driver gets the finished words."""
    size = max(64, 64 * math.ceil(count * bits_per_key / 64))
    hashes = max(1, round(bits_per_key * math.log(2)))
    words = (
        keys.select(F.xxhash64("h", F.lit(level).cast("bigint")).alias("h"))
        .select(F.explode(_positions(hashes, size)).alias("p"))
        .groupBy(F.expr("p div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
        .collect()  # size / 64 rows at most; the caller has checked the size
    )
    bits = np.zeros(size // 64, np.int64)
    for w in words:
        bits[w["word"]] = w["bits"]
    return Bloom(bits.view(np.uint64), size, hashes, level)


@dataclass(frozen=True)
class Cascade:
    """levels[0] holds the listed keys, levels[1] wrongly passing corpus keys, levels[2] listed keys again, ..."""

    levels: tuple[Bloom, ...]

    def __contains__(self, h: int) -> bool:
        for k, level in enumerate(self.levels):
            if h not in level:
                return k % 2 == 1
        return len(self.levels) % 2 == 1


def _hashed(rules: DataFrame, action: str) -> DataFrame:
    return rules.where(F.col("action") == action).select(F.xxhash64(F.concat("host", "path")).alias("h")).distinct()


def _passing(urls: DataFrame, lengths: list[int], level: Bloom) -> DataFrame:
    """Distinct hashes of corpus keys that pass a filter."""
    sent = urls.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes = {key_hash(s + p) for host, path in zip(hosts, paths) for s, p in keys_of(host, path, lengths)}
            found = np.array(sorted(h for h in hashes if h in sent.value), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["h"])

    return urls.select("host", "path").mapInArrow(run, "h bigint").distinct()


def build_cascade(urls: DataFrame, listed: DataFrame, count: int, lengths: list[int], bits_per_key: float) -> Cascade:
    """Exact on every key of `urls` and every listed key."""
    levels = [bloom(listed, count, bits_per_key, 0)]
    # Distinct keys, so no key is hot on either side of this join; it runs once, over the errors of level 1.
    inside, outside = listed, cut_lineage(_passing(urls, lengths, levels[0]).join(listed, "h", "left_anti"))
    while n := outside.count():
        levels.append(bloom(outside, n, bits_per_key, len(levels)))
        sent = urls.sparkSession.sparkContext.broadcast(levels[-1])

        def passes(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [h for h in batch.column(0).to_pylist() if (h & (1 << 64) - 1) in sent.value]
                yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64())], ["h"])

        inside, outside = outside, cut_lineage(inside.mapInArrow(passes, "h bigint"))
    return Cascade(tuple(levels))


def apply_rules(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    bits_per_key: float = 6.0,
    max_filter_bytes: int = 64_000_000,
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. rules: action (allow or block), host, path."""
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rules = rules.dropna(subset=["action", "host", "path"]).select("action", F.translate("host", UPPER, LOWER).alias("host"), "path").distinct()
    rules = cut_lineage(rules)
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # at most the longest rule's length
    counts = {a: _hashed(rules, a).count() for a in ACTIONS}
    if sum(counts.values()) * bits_per_key / 8 > max_filter_bytes:
        return _joined(urls, rules, lengths, default)
    cascades = {a: build_cascade(urls, _hashed(rules, a), n, lengths, bits_per_key) for a, n in counts.items() if n}
    sent = pages.sparkSession.sparkContext.broadcast(cascades)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str | None] = {}
        for batch in batches:
            if len(known) > 1_000_000:
                known.clear()
            found, verdicts = [], []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rule, verdict = None, default
                for s, p in keys_of(host, path, lengths):
                    key = s + p
                    if key not in known:
                        h = key_hash(key)
                        known[key] = next((a for a in ACTIONS if a in sent.value and h in sent.value[a]), None)
                    if known[key]:
                        rule, verdict = key, known[key]
                        break
                found.append(rule)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(verdicts, pa.string())], [*batch.schema.names, "rule", "verdict"])

    kind = dict(pages.dtypes)["page_id"]
    return urls.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def _joined(urls: DataFrame, rules: DataFrame, lengths: list[int], default: str) -> DataFrame:
    """The same by a join, for lists too large to send: keys of distinct urls meet the rules, and the best rule returns to the pages."""
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefix = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
    distinct = urls.select("host", "path").distinct()
    keys = distinct.select("host", "path", F.explode(suffix).alias("s")).where("s != ''").select("*", F.explode(prefix).alias("n"))
    keys = keys.select("host", "path", F.concat("s", F.expr("substring(path, 1, n)")).alias("key"), F.length("s").alias("s"))
    listed = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("action").alias("action"))
    best = keys.join(listed, "key").groupBy("host", "path").agg(F.max_by(F.struct("key", "action"), F.struct(F.length("key"), "s")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )
