"""Benchmark decontamination with suffix arrays over the training documents.

Each task turns its documents into shards of at most `shard_words` words (a longer document is a shard of its own), sorts the
suffixes of a shard, and binary-searches every suffix of every benchmark item in it, one word deeper in each round. That yields all
places where a window of `window` words occurs. The ranges of a benchmark suffix at depths 1, 2, ... lie inside one another, so the number of
different ranges around a document suffix is the length of its longest verbatim match with any item; its maximum over a
document is the document's longest match. Documents never leave their task: the operator has no shuffle, and a document is whole in
one shard, so results per document are final. Of several longest matches the first in the document is named.

Benchmark items travel to the tasks in blocks of about `block_bytes` bytes of text. With several blocks, the documents pass through
one scan for each, and every scan adds to the spans and items of the ones before.

Defined cases: words are lower-cased A-Z runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`; NULL and empty texts have no words and are never
contaminated, and items without words match nothing; an item shorter than the window is one window; repeated item ids count
once; a NULL item id is never reported, but its words are hit; repeated documents are judged each for itself; empty tables on either
side work; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reelspark.llm.rows import packed, unpacked

# One byte to one byte: A-Z to a-z, other ASCII that isn't a word character to a space.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)
FOUND = (
    T.StructType()
    .add("n_words", T.LongType())
    .add("spans", T.ArrayType(T.StructType().add("first", T.LongType()).add("last", T.LongType())))
    .add("items", T.ArrayType(T.StringType()))
    .add("longest", T.LongType())
    .add("longest_item", T.StringType())
    .add("longest_at", T.LongType())
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ids in order. Prefix doubling: ranks of twice as many words in each round, and only
    among suffixes that are still tied. Ids must fit into 32 bits."""
    n = len(ids)
    if n == 0:
        return np.empty(0, np.int64)
    _, rank = np.unique(ids, return_inverse=True)
    rank = rank.astype(np.int64)
    padded = np.r_[rank[1:], -1] + 1
    key = rank * (n + 1) + padded
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    width = 2
    tied = np.flatnonzero(~(head & np.r_[head[1:], True]))  # places in the order that share a key
    while len(tied):
        at = order[tied]
        after = at + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        head = np.r_[True, key[1:] != key[:-1]]
        start = np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))
        # rank = first place of the tie; ties that were one before stay next to each other
        rank[at] = tied[start]
        single = head & np.r_[head[1:], True]
        tied = tied[~single]
        width *= 2
    return order


class Shard:
    """Documents laid end to end, each followed by a separator of its own that equals no word."""

    def __init__(self, docs: list[np.ndarray]):
        self.lengths = np.array([len(d) for d in docs], np.int64)
        self.starts = np.cumsum(np.r_[0, self.lengths[:-1] + 1]) if len(docs) else np.empty(0, np.int64)
        n = int(self.lengths.sum()) + len(docs)
        ids = np.empty(n, np.int64)
        for k, (d, s) in enumerate(zip(docs, self.starts)):
            ids[s : s + len(d)] = d
            ids[s + len(d)] = -1 - k
        self.ids, self.order = ids, suffix_array(ids)

    def narrowed(self, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Within ranges of suffixes that agree in `depth` words, the parts whose next word is `word`: two binary searches."""
        ends = []
        for right in (False, True):
            a, b = lo.copy(), hi.copy()
            while (open_ := a < b).any():
                mid = (a + b) // 2
                place = self.order[np.minimum(mid, len(self.order) - 1)] + depth
                value = np.where(place < len(self.ids), self.ids[np.minimum(place, len(self.ids) - 1)], np.iinfo(np.int64).min)
                less = (value <= word) if right else (value < word)
                a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
            ends.append(a)
        return ends[0], ends[1]


def search(shard: Shard, suffixes: np.ndarray, left: np.ndarray, depth_of_interest: np.ndarray):
    """Every test suffix (a start in the word array `suffixes`, with `left` words to the item's end) against the shard.

    Returns the length of the longest match that starts at each place of the shard, and for each test suffix the range of the shard's
    suffixes that share its first depth_of_interest words (empty where they don't occur).
    """
    n = len(left)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(shard.order), np.int64)
    nested = np.zeros(len(shard.order) + 1, np.int64)  # ranges that begin less those that end at each place of the order
    win_lo, win_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    live, depth = np.arange(n), 0
    while len(live):
        live = live[left[live] > depth]
        a, b = shard.narrowed(lo[live], hi[live], depth, suffixes[live + depth])
        found = a < b
        live, a, b = live[found], a[found], b[found]
        depth += 1
        lo[live], hi[live] = a, b
        begin, which = np.unique(a, return_index=True)  # ranges of one depth are equal or apart
        nested[begin] += 1
        nested[b[which]] -= 1
        done = live[depth_of_interest[live] == depth]
        win_lo[done], win_hi[done] = lo[done], hi[done]
    matched = np.empty(len(shard.order), np.int64)
    matched[shard.order] = np.cumsum(nested)[:-1]
    return matched, win_lo, win_hi


class Benchmark:
    """The words of a block of items, laid end to end."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        words = [(i, w) for i, t in items if (w := words_of(t))]
        lengths = [len(w) for _, w in words]
        self.vocabulary = Vocabulary()
        self.words = np.array([self.vocabulary[w] for _, ws in words for w in ws], np.int64)
        self.item = np.repeat(np.arange(len(words)), lengths)
        self.names = [i for i, _ in words]
        # Words from each place to the end of its item, and the window that starts there (0: none).
        self.left = np.concatenate([np.arange(n, 0, -1) for n in lengths]) if words else np.empty(0, np.int64)
        size = np.repeat(np.minimum(lengths, window), lengths).astype(np.int64)
        self.window = np.where(self.left >= size, size, 0)
        self.index = Shard(np.split(self.words, np.cumsum(lengths)[:-1]) if words else [])

    def holders(self, ids: np.ndarray, at: np.ndarray, length: np.ndarray) -> list[str | None]:
        """An item that holds the words ids[at : at + length], for each (at, length); None where length is 0."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(self.index.order), np.int64)
        live, depth = np.flatnonzero(length > 0), 0
        while len(live):
            lo[live], hi[live] = self.index.narrowed(lo[live], hi[live], depth, ids[at[live] + depth])
            depth += 1
            live = live[length[live] > depth]
        of = lambda k: self.names[int(np.searchsorted(self.index.starts, self.index.order[lo[k]], "right")) - 1]
        return [of(k) if length[k] else None for k in range(len(at))]


def scan_shard(docs: list[np.ndarray], bench: Benchmark, earlier: list[dict | None]) -> list[tuple]:
    """FOUND for each document of a shard, with what earlier blocks of the benchmark have found."""
    shard = Shard(docs)
    matched, lo, hi = search(shard, bench.words, bench.left, bench.window)
    owner_of = lambda at: np.searchsorted(shard.starts, at, "right") - 1
    marks = np.zeros(len(shard.ids) + 1, np.int64)
    items = [set(e["items"]) if e else set() for e in earlier]
    for s in np.flatnonzero(hi > lo).tolist():  # windows that occur in this shard
        at = shard.order[lo[s] : hi[s]]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + bench.window[s], -1)
        if (name := bench.names[bench.item[s]]) is not None:
            for d in np.unique(owner_of(at)).tolist():
                items[d].add(name)
    for d, e in enumerate(earlier):
        for span in e["spans"] if e else ():
            marks[shard.starts[d] + span["first"]] += 1
            marks[shard.starts[d] + span["last"] + 1] -= 1
    covered = np.r_[False, np.cumsum(marks) > 0]
    firsts, ends = np.flatnonzero(~covered[:-1] & covered[1:]), np.flatnonzero(covered[:-1] & ~covered[1:])
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    for first, end, d in zip(firsts.tolist(), ends.tolist(), owner_of(firsts).tolist()):
        spans[d].append((first - int(shard.starts[d]), end - 1 - int(shard.starts[d])))
    longest, owner = np.maximum.reduceat(matched, shard.starts), np.repeat(np.arange(len(docs)), shard.lengths + 1)
    longest_at = np.flatnonzero(matched == longest[owner])
    first_of = longest_at[np.unique(owner[longest_at], return_index=True)[1]]
    names, offsets = bench.holders(shard.ids, first_of, longest), (first_of - shard.starts).tolist()
    best = [(n, name, at) if n else (0, None, None) for n, name, at in zip(longest.tolist(), names, offsets)]
    before = [(e["longest"], e["longest_item"], e["longest_at"]) if e else (0, None, None) for e in earlier]
    best = [min(a, b, key=lambda x: (-x[0], x[2] or 0)) for a, b in zip(before, best)]
    return [(len(ws), spans[d], sorted(items[d]), *best[d]) for d, ws in enumerate(docs)]


def _scan(docs: DataFrame, text: str, out: str, bench: Benchmark, shard_words: int) -> DataFrame:
    """docs with a struct column `out` of FOUND, added or brought up to date; all other columns pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(bench)
    fields = [f for f in docs.schema.fields if f.name != out]
    kinds = [to_arrow_type(f.dataType) for f in FOUND.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            before = batch.column(out).to_pylist() if out in batch.schema.names else [None] * len(texts)
            others = batch.select([f.name for f in fields])
            begin = 0
            while begin < len(texts):
                vocabulary, held, size, end = Vocabulary(sent.value.vocabulary), [], 0, begin
                while end < len(texts) and (not held or size + len(texts[end] or "") // 6 <= shard_words):
                    held.append(np.array([vocabulary[w] for w in words_of(texts[end])], np.int64))
                    size, end = size + len(held[-1]), end + 1
                columns = zip(*scan_shard(held, sent.value, before[begin:end]))
                found = pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], FOUND.names)
                part = others.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*part.schema.names, out])
                begin = end

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField(out, FOUND)]))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of about block_bytes; no more than one block is ever on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // block_bytes)
    for k in range(max(n, 1)):
        block = items if n <= 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        yield sorted(((r.id, r.text) for r in block.distinct().collect()), key=lambda x: (x[0] is None, x))


def with_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "found", window: int = 10, shard_words: int = 1_000_000, block_bytes: int = 8_000_000
) -> DataFrame:
    """docs and a struct `out`: n_words, the spans of hit words, items, and the longest match with its item and word offset."""
    for items in _blocks(benchmark, block_bytes):
        docs = _scan(docs, text, out, Benchmark(items, window), shard_words)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a window of a benchmark item; columns as they were."""
    found = with_matches(packed(docs, "text"), benchmark, **options)
    return unpacked(found.where(F.size("found.spans") == 0), docs, "text")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Digest columns of every document row."""
    found = with_matches(docs.select("doc_id", "text"), benchmark, **options)
    items = F.array_join(F.sort_array("found.items"), ",")
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda a, x: a + x["last"] - x["first"] + 1)
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
        F.col("found.longest").alias("longest_match"),
        "found.longest_item",
        "found.longest_at",
    )
