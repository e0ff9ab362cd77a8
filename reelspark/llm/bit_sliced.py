"""Exact top-k inner products with a bit-sliced index.

Components are quantised to floor(64 * x). A shard of ROWS vectors keeps one bitmap for each bit of each attribute ("slice"), attributes
counted from their smallest value in the shard. The score of a query is a weighted sum of attributes, so its slices are sums of attribute
slices: a set bit c of the query's weight adds the attribute's slices, shifted by c; a negative weight adds their complements, as
-w * y = w * (M - y) - w * M with M all ones. Bitmaps are added for all rows of a shard at once by carry-save adders (three slices of one
weight give one of that weight and a carry). The k highest rows are then selected from the most significant score slice downward: rows
with the bit stay while they are k or more, else they are taken and the rest goes on. Rows that are still tied after the last slice have
equal scores; the boundary is resolved by vec_id. Scores of the selected rows are read back from the slices, as 64-bit integers.

Shards and blocks of QUERIES queries are dealt evenly, whatever their ids; each (shard, block) cell is a row of a shuffle with a bounded
payload, and gives k rows a query at most. Nothing reaches the driver but counts.

Defined cases: rows without vec_id, NULL vectors and vectors with a NULL, NaN or infinite component take no part; components are clamped
to +-MOST after quantising, so that sums stay within 64 bits; repeated rows (same id and vector) are one row; a vec_id with
several vectors is a candidate, and a query, with each of them, but never a candidate of its own id; only vectors of a query's length
are its candidates; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.session import cut_lineage

SCALE = 64
ROWS = 16_384
QUERIES = 256
MOST = 1 << 26
INDEX = "shard bigint, dim int, n int, ids binary, low binary, width binary, slices binary"
BLOCK = "block bigint, dim int, ids binary, weights binary"
HITS = "query_id bigint, query_hash bigint, vec_id bigint, score bigint"
MANY = 20_000  # partitions of cells at most; a partition may hold several cells


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v: quantised vectors that take part, repeated rows once."""
    x = F.col(f"`{vector}`").cast("array<double>")
    usable = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(MOST))), F.lit(float(-MOST)))).cast("int"))
    chosen = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), v.alias("v"), usable.alias("usable"))
    return chosen.where(F.col("usable") & F.col("vec_id").isNotNull()).select("vec_id", "v").distinct()


def _tables(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and values of up to `most` rows of one dimension, ordered by id."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size: dict[int, int] = {}

    def drained(dim: int) -> tuple[np.ndarray, np.ndarray]:
        ids, values = (np.concatenate([p[k] for p in held[dim]]) for k in (0, 1))
        held[dim], size[dim] = [], 0
        order = np.argsort(ids, kind="stable")
        return ids[order], values[order]

    for batch in batches:
        ids, column = batch.column(0).to_numpy(), batch.column(1)
        lengths = np.diff(column.offsets.to_numpy())
        flat, starts = column.flatten().to_numpy(), np.r_[0, np.cumsum(lengths)]
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            values = flat[starts[rows][:, None] + np.arange(dim)].astype(np.int64)
            for at in range(0, len(rows), most):
                part = (ids[rows[at : at + most]], values[at : at + most])
                if size.get(dim, 0) + len(part[0]) > most:
                    yield drained(dim)
                held.setdefault(dim, []).append(part)
                size[dim] = size.get(dim, 0) + len(part[0])
    for dim in sorted(held):
        if size[dim]:
            yield drained(dim)


def bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 as bitmaps of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def sliced(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest value and number of slices of each attribute, and all slices, least significant first."""
    low = values.min(axis=0)
    y = (values - low).T
    width = np.array([int(m).bit_length() for m in y.max(axis=1, initial=0)], np.uint8)
    parts = [(y[j] >> b) & 1 for j, w in enumerate(width.tolist()) for b in range(w)]
    return low, width, bitmaps(np.array(parts, np.uint8).reshape(len(parts), len(values)))


def build_index(vectors: DataFrame, shards: int, rows: int = ROWS) -> DataFrame:
    """INDEX rows; vectors: vec_id, v. Rows are dealt in turn, so a shard doesn't depend on ids. A partition has one row, and a few more
    only where vectors differ in length; they share the number `shard`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for ids, values in _tables(batches, rows):
            low, width, slices = sliced(values)
            row = [at, values.shape[1], len(ids), ids.tobytes(), low.tobytes(), width.tobytes(), slices.tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], _names(INDEX))

    return vectors.repartition(shards).mapInArrow(run, INDEX)


def query_blocks(queries: DataFrame, blocks: int, rows: int = QUERIES) -> DataFrame:
    """BLOCK rows; queries: vec_id, v."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        for ids, values in _tables(batches, rows):
            row = [at, values.shape[1], ids.tobytes(), values.tobytes()]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], _names(BLOCK))

    return queries.repartition(blocks).mapInArrow(run, BLOCK)


def add_slices(parts: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Score slices, least significant first: carry-save sums of bitmaps, by weight."""
    out, weight = [], 0
    while parts:
        stack = parts.pop(weight, [])
        x = stack[0] if len(stack) == 1 else np.concatenate(stack) if stack else np.zeros((0, words), np.uint64)
        carries = []
        while len(x) > 2:
            t = len(x) // 3
            a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
            ab = a ^ b
            carries.append((a & b) | (ab & c))
            x = np.concatenate([ab ^ c, x[3 * t :]])
        if len(x) == 2:
            carries.append((x[:1] & x[1:]))
            x = x[:1] ^ x[1:]
        out.append(x[0] if len(x) else np.zeros(words, np.uint64))
        if carries:
            parts.setdefault(weight + 1, []).extend(carries)
        weight += 1
    return out


class Shard:
    def __init__(self, n: int, ids: np.ndarray, low: np.ndarray, width: np.ndarray, slices: np.ndarray):
        self.n, self.ids, self.low, self.width = n, ids, low, width.astype(np.int64)
        self.words = -(-n // 64)
        plain = slices.reshape(-1, self.words)
        self.slices = np.concatenate([plain, ~plain])
        self.attribute = np.repeat(np.arange(len(width)), self.width)
        self.bit = np.arange(len(plain)) - np.repeat(np.cumsum(self.width) - self.width, self.width)
        self.ones = (1 << self.width) - 1
        self.all = bitmaps(np.ones((1, n), np.uint8))[0]

    def scores(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Score slices and the constant that is added to them."""
        constant = int(weights @ self.low) - int((-weights * self.ones)[weights < 0].sum())
        of_slice = weights[self.attribute]
        rows = np.arange(len(of_slice)) + len(of_slice) * (of_slice < 0)  # complements stand in the second half
        size, parts = np.abs(of_slice), {}
        for c in range(int(size.max(initial=0)).bit_length()):
            used = (size >> c) & 1 == 1
            for b in np.unique(self.bit[used]).tolist():
                parts.setdefault(b + c, []).append(self.slices[rows[used & (self.bit == b)]])
        return add_slices(parts, self.words), constant

    def top(self, query_id: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and scores of the k best rows (those of the query's own id left out)."""
        slices, constant = self.scores(weights)
        open_, taken = self.all.copy(), np.zeros(self.words, np.uint64)
        for r in range(np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, "right")):
            open_[r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
        n_taken = 0
        if int(np.bitwise_count(open_).sum()) > k:
            for s in reversed(slices):
                with_bit = open_ & s
                n = int(np.bitwise_count(with_bit).sum())
                if n_taken + n > k:
                    open_ = with_bit
                else:
                    taken |= with_bit
                    open_ &= ~s
                    n_taken += n
                    if n_taken == k:
                        break
        places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
        rows = places(taken)
        if len(rows) < k:  # the boundary: equal scores, and rows stand in the order of their ids
            rows = np.r_[rows, places(open_)[: k - len(rows)]]
        score = np.full(len(rows), constant, np.int64)
        for w, s in enumerate(slices):
            score += ((s[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
        return self.ids[rows], score


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for s in left.to_pylist():
            at = lambda name, kind: np.frombuffer(s[name], kind)  # noqa: B023, E731
            shard = Shard(s["n"], at("ids", np.int64), at("low", np.int64), at("width", np.uint8), at("slices", np.uint64))
            for b in right.to_pylist():
                if b["dim"] != s["dim"]:
                    continue
                ids = np.frombuffer(b["ids"], np.int64)
                weights = np.frombuffer(b["weights"], np.int64).reshape(len(ids), b["dim"])
                for q, w in zip(ids.tolist(), weights):
                    found, score = shard.top(q, w, k)
                    mark = xxhash.xxh64_intdigest(w.tobytes()) >> 1
                    for column, x in zip(out, (np.full(len(found), q), np.full(len(found), mark), found, score)):
                        column.append(x)
        return pa.table({c: pa.array(np.concatenate([np.empty(0, np.int64), *x])) for c, x in zip(_names(HITS), out)})

    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, rows: int = ROWS, queries_a_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query, ties to the smaller vec_id. Both: vec_id, v (quantised)."""
    shards = max(1, -(-candidates.count() // rows))
    blocks = max(1, -(-queries.count() // queries_a_block))
    to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))  # noqa: E731  both sides hash the same types
    parts = min(shards * blocks, MANY)
    left = cut_lineage(build_index(candidates, shards, rows)).withColumn("block", to(blocks)).repartition(parts, "shard", "block")
    right = query_blocks(queries, blocks, queries_a_block).withColumn("shard", to(shards)).repartition(parts, "shard", "block")
    hits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_cell(k), HITS)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k highest scores of each row whose vec_id is divisible by `every`, against all rows but its own."""
    values = cut_lineage(quantised(vectors))
    return search(values.where(F.col("vec_id") % every == 0), values, k)
