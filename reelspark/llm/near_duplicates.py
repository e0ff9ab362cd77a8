"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

1. Every text becomes a signature of minhash values, BITS bits each, as many as its Shape has positions. Texts with equal shingle sets are one class, known
   by its smallest doc_id; only one text of a class goes on.
2. Pigeonhole: signatures are cut into chunks of equal length. Two signatures that differ in at most max_distance values differ in
   at most one value of some chunk, so they share one of the keys "chunk without its i-th value". All pairs within it are
   therefore found. `shape` derives chunks from the similarity so that a pair at the threshold exceeds the distance with a chance of
   MISSED at most.
3. Classes that share a key and lie within the distance are joined to candidate groups. Keys with equal members are
   looked at once. A crowded key is cut into blocks, and all pairs of blocks are compared in separate tasks.
4. Inside a candidate group links are confirmed on the full shingle sets, in blocks of BLOCK texts. Blocks of one group meet through
   hub texts first; what is then still apart from the group's largest component is compared with every block of the group.
5. Links become components, and classes give them to all their documents.

No pair list is ever made: tasks give one row for each text, with the smallest doc_id that it reached. Texts are read twice: for
signatures, and for the members of candidate groups, which are picked by a Bloom filter while it is small and by a join beyond.

Defined cases: NULL and empty texts, and rows without doc_id, are linked with nothing and stay; rows that share a doc_id are one
document (what one is linked with, all are); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.components import Unions, connected_components
from reelspark.llm.rows import packed, unpacked
from reelspark.session import cut_lineage

SHINGLE = 3
SIMILARITY = (85, 100)  # as a fraction
BITS = 16
MISSED = 4e-7  # chance that a pair at the threshold isn't a candidate
MOST_POSITIONS = 128
KEY_BLOCK = 1024  # members of a key compared in one group of rows
BLOCK = 512  # texts confirmed in one group of rows
HUBS = 8
MAX_BLOOM_BYTES = 32_000_000



@dataclass(frozen=True)
class Shape:
    """Shingles of `size` words, linked at `similarity`; signatures of `chunks` chunks of `chunk` values."""

    size: int
    similarity: tuple[int, int]
    chunk: int
    chunks: int

    @property
    def positions(self) -> int:
        return self.chunk * self.chunks

    @property
    def max_distance(self) -> int:
        return 2 * self.chunks - 1


@cache
def shape(size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> Shape:
    """The longest chunks, hence the most selective keys, for which at most 80 (or else MOST_POSITIONS) positions miss few enough."""
    differ = 1 - similarity[0] / similarity[1]
    for most in (80, MOST_POSITIONS):
        for chunk in (5, 4, 3, 2):
            for chunks in range(1, most // chunk + 1):
                n = chunk * chunks
                if sum(math.comb(n, k) * differ**k * (1 - differ) ** (n - k) for k in range(2 * chunks, n + 1)) <= MISSED and n >= 64:
                    return Shape(size, similarity, chunk, chunks)
    raise ValueError(f"no signature finds pairs at {similarity}")


_RNG = np.random.default_rng(20240115)
_FACTORS = _RNG.integers(1 << 62, (1 << 63) - 1, MOST_POSITIONS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.arange(1, MOST_POSITIONS + 1, dtype=np.uint64) * _MIX
DEFAULT = shape()
CHUNK, CHUNKS, POSITIONS, MAX_DISTANCE = DEFAULT.chunk, DEFAULT.chunks, DEFAULT.positions, DEFAULT.max_distance


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 500_000:
            self[word] = h
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of `size` words; a shorter text is one shingle; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) == 0:
        return h
    if len(h) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    x = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        x = _mixed(x * _MIX + h[k : len(h) - size + 1 + k])
    return np.unique(x)


def signature(shingles: np.ndarray, positions: int = POSITIONS) -> bytes:
    low = np.full(positions, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        np.minimum(low, (shingles[at : at + 4096, None] * _FACTORS[:positions]).min(axis=0), out=low)
    return ((low >> np.uint64(16)) & np.uint64((1 << BITS) - 1)).astype(np.uint16).tobytes()


def sketches(docs: DataFrame, form: Shape = DEFAULT) -> DataFrame:
    """doc_id, n_shingles, set_hash (of the whole set), signature of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, names, signs = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, hashes, form.size)
                sizes.append(len(s))
                names.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                signs.append(signature(s, form.positions) if len(s) else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_hash", "signature"])

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_hash binary, signature binary")


def chunk_keys(classes: DataFrame, form: Shape = DEFAULT) -> DataFrame:
    """key, node: each chunk of a signature with one value left out."""
    chosen = [[c for c in range(form.chunk) if c != skip] for skip in range(form.chunk)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, form.chunks, form.chunk).astype(np.uint64)
                keys = []
                for c, skip in itertools.product(range(form.chunks), range(form.chunk)):
                    x = np.zeros(len(values), np.uint64)
                    for k in chosen[skip]:
                        x = (x << np.uint64(BITS)) | values[:, c, k]
                    keys.append(_mixed(x + _SALTS[c * form.chunk + skip]))
                nodes = np.tile(part.column(0).to_numpy(zero_copy_only=False), form.positions)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(nodes)], ["key", "node"])

    return classes.select("node", "signature").mapInArrow(run, "key bigint, node bigint")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with whole groups of equal keys; input sorted by keys. A group is bounded by how its rows were dealt out."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(change)
        if len(at):
            yield table.slice(0, at[-1])
            held = table.slice(at[-1])
        else:
            held = table
    if held is not None and held.num_rows:
        yield held


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.r_[0, np.flatnonzero(change), table.num_rows]


def _near(form: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """node, root: members of the same group of rows within the distance are joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unions = Unions()
        for table in _groups(batches, ["key", "i", "j"]):
            nodes = table.column("node").to_numpy()
            signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, form.positions)
            bounds = _bounds(table, ["key", "i", "j"])
            size = np.diff(bounds)
            group = np.repeat(np.arange(len(size)), size)
            small = int(size[size <= 16].max(initial=1))
            for d in range(1, small):  # all pairs of small groups at once: rows that are d apart
                same = np.flatnonzero((group[d:] == group[:-d]) & (size[group[d:]] <= 16))
                close = same[(signs[same] != signs[same + d]).sum(axis=1) <= form.max_distance]
                for a, b in set(zip(nodes[close].tolist(), nodes[close + d].tolist())):
                    unions.join(a, b)
            for g in np.flatnonzero(size > 16):
                s, n = signs[bounds[g] : bounds[g + 1]], nodes[bounds[g] : bounds[g + 1]]
                for k in range(len(n) - 1):
                    for m in n[k + 1 :][(s[k + 1 :] != s[k]).sum(axis=1) <= form.max_distance].tolist():
                        unions.join(int(n[k]), m)
        pairs = [(x, unions.find(x)) for x in list(unions)]  # roots have no entry
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def candidate_groups(classes: DataFrame, form: Shape = DEFAULT) -> DataFrame:
    """node, component: classes that are joined by chains of signatures within the distance. classes: node, signature."""
    keys = chunk_keys(classes, form)
    prints = [F.count("*").alias("n"), F.min("node").alias("low"), F.bit_xor(F.xxhash64("node")).alias("mark")]
    shared = keys.groupBy("key").agg(*prints).where("n > 1")
    # Many keys of a group of copies have the same members: one of them is enough.
    single = shared.groupBy("n", "low", "mark").agg(F.min("key").alias("key"))
    members = keys.join(single.select("key", "n"), "key").join(classes, "node")
    blocks = F.ceil(F.col("n") / KEY_BLOCK).cast("int")
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "signature")
    # A task gives one row for each of its nodes, so few large tasks say less twice than many small ones.
    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4, 8)
    members = members.repartition("key", "i", "j").coalesce(parts).sortWithinPartitions("key", "i", "j")
    return cut_lineage(connected_components(members.mapInArrow(_near(form), "a bigint, b bigint")))


def _linked(nodes: list[int], sets: list[np.ndarray], sides: tuple[np.ndarray, np.ndarray] | None, unions: Unions, similarity: tuple[int, int]) -> None:
    """Joins the nodes of linked texts: all pairs, or pairs of a left and a right text. Exact counts of common shingles."""
    lengths = np.array([len(s) for s in sets])
    if not len(sets) or not lengths.sum():
        return
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(lengths)]
    mark = np.zeros(ids.max() + 1, np.int32)
    up, down = similarity
    for a in range(len(sets)) if sides is None else np.flatnonzero(sides[0]).tolist():
        own = ids[starts[a] : starts[a + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[ids], starts[:-1])
        mark[own] = 0
        links = down * common >= up * (lengths[a] + lengths - common)
        if sides is not None:
            links &= sides[1]
        for b in np.flatnonzero(links).tolist():
            if a != b:
                unions.join(nodes[a], nodes[b])


def _confirm(keys: list[str], two_sided: bool, form: Shape) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for table in _groups(batches, keys):
            bounds, out = _bounds(table, keys), []
            nodes, texts = table.column("node").to_pylist(), table.column("text").to_pylist()
            left = table.column("is_left").to_numpy(zero_copy_only=False).astype(bool) if two_sided else None
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                unions = Unions()
                sets = [shingle_set(t, hashes, form.size) for t in texts[lo:hi]]
                full = [k for k, s in enumerate(sets) if len(s)]
                sides = (left[lo:hi][full], ~left[lo:hi][full]) if two_sided else None
                _linked([nodes[lo + k] for k in full], [sets[k] for k in full], sides, unions, form.similarity)
                out.extend((x, unions.find(x)) for x in dict.fromkeys(nodes[lo:hi]) if unions.find(x) != x)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _bloom_filter(ids: DataFrame, n: int) -> np.ndarray | None:
    """Bits (as bytes) of a filter over the ids, or None when it would be too large to send."""
    size = 1 << max(10, int(np.ceil(np.log2(12 * n + 1))))
    if size // 8 > MAX_BLOOM_BYTES:
        return None
    places = ids.select(F.explode(F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(size)) for k in range(4)))).alias("p"))
    bits = np.zeros(size, bool)
    words = places.groupBy(F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
    for r in words.collect():  # size / 64 rows at most
        bits[64 * r["w"] : 64 * r["w"] + 64] = [(r["b"] >> k) & 1 for k in range(64)]
    return np.packbits(bits)


def member_texts(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """node, text, component of the candidate groups' nodes; groups: node, component."""
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("node"), F.col("text").cast("string").alias("text")).where("node is not null")
    bits = _bloom_filter(groups.select("node"), groups.count())
    if bits is not None:
        sent, size = docs.sparkSession.sparkContext.broadcast(bits), len(bits) * 8
        places = F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(size)) for k in range(4)))

        def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = np.unpackbits(sent.value).astype(bool)
            for batch in batches:
                at = np.asarray(batch.column(2).flatten()).reshape(-1, 4)
                yield batch.select([0, 1]).filter(pa.array(known[at].all(axis=1)))

        chosen = chosen.withColumn("places", places).mapInArrow(maybe, "node bigint, text string")
    return chosen.join(groups, "node")


def link_components(docs: DataFrame, groups: DataFrame, form: Shape = DEFAULT) -> DataFrame:
    """node, component by links that are confirmed on the full sets of shingles."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    texts = member_texts(docs, groups).join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    texts = cut_lineage(texts)
    large = groups.join(sizes.where(F.col("n") > BLOCK), "component")
    order = F.row_number().over(_window("component").orderBy(F.xxhash64("node"), "node"))
    hubs = large.withColumn("k", order).where(F.col("k") <= HUBS).select("node", "component", "n")
    hubs = texts.join(hubs.select("node"), "node", "left_semi").withColumn("to", F.explode(F.sequence(F.lit(0), blocks - 1)))
    hubs = hubs.where("to != block").select("component", F.col("to").alias("block"), "node", "text")
    first = texts.select("component", "block", "node", "text").union(hubs)
    links = _dealt(first, "component", "block").mapInArrow(_confirm(["component", "block"], False, form), "a bigint, b bigint")
    links = cut_lineage(links)
    if not large.limit(1).count():  # every group was one block, so roots are final
        return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))  # nodes that are roots are left out
    part = connected_components(links).withColumnRenamed("component", "part")
    state = cut_lineage(large.join(part, "node", "left").select("node", "component", F.coalesce("part", "node").alias("part")))
    counts = state.groupBy("component", "part").agg(F.count("*").alias("m"))
    main = counts.groupBy("component").agg(F.max_by("part", F.struct("m", "part")).alias("main"))
    apart = state.join(main, "component").where("part != main").select("node", "component", F.lit(True).alias("apart"))
    n_apart = apart.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows"))
    left = texts.join(apart.select("node"), "node", "left_semi").join(n_apart, "component")
    left = left.withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("rows")).cast("int"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("is_left", F.lit(True))
    right = texts.join(n_apart, "component").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    right = right.withColumn("j", F.col("block")).withColumn("is_left", F.lit(False))
    columns = ["component", "i", "j", "is_left", "node", "text"]
    rest = _dealt(left.select(*columns).union(right.select(*columns)), "component", "i", "j")
    more = rest.mapInArrow(_confirm(["component", "i", "j"], True, form), "a bigint, b bigint")
    joined = connected_components(links.union(more))
    return groups.select("node").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _window(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    form = shape(size, similarity)
    sketched = cut_lineage(sketches(docs, form))
    listed = sketched.where("doc_id is not null and n_shingles > 0")
    classes = cut_lineage(listed.groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature")))
    # Rows that share a doc_id join the classes of their texts.
    bridges = listed.groupBy("doc_id").agg(F.min("set_hash").alias("x"), F.max("set_hash").alias("y")).where("x != y").limit(1).count()
    found = link_components(docs, candidate_groups(classes.select("node", "signature"), form), form)
    of_class = classes.select("set_hash", "node").join(found, "node", "left").select("set_hash", F.coalesce("component", "node").alias("component"))
    rows = sketched.join(of_class, "set_hash", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )
    if bridges:
        rows = cut_lineage(rows)
        merged = connected_components(rows.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")))
        merged = merged.select(F.col("node").alias("component_id"), F.col("component").alias("merged"))
        rows = rows.join(merged, "component_id", "left").select("doc_id", "n_shingles", F.coalesce("merged", "component_id").alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """docs with one document of each component; of repeated rows (same doc_id and text) one stays."""
    dropped = near_duplicates(docs, size, similarity).where(~F.col("kept")).select(F.col("doc_id").alias("dropped")).distinct()
    rows = packed(docs, "doc_id", "text").withColumn("id", F.col("doc_id").cast("bigint"))
    kept = rows.join(dropped, F.col("id") == F.col("dropped"), "left_anti")
    named, unnamed = kept.where("id is not null").dropDuplicates(["id", "text"]), kept.where("id is null")
    return unpacked(named.union(unnamed), docs, "doc_id", "text")
