"""Vector best-fit packing of tokenized documents into training sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths, as attention stays inside
a document). Pieces are placed longest first. Among the sequences in which a piece fits under every capacity, rule "norm" takes the
one whose weighted residual vector is shortest afterwards, and rule "dot" the one whose residual has the largest weighted
dot-product with the demand of the piece.

Pieces are spread over tasks by a hash of their place, so neither a long document nor a hot source gathers anywhere. A task packs
blocks of a fixed number of pieces; sequences that a block leaves poorly filled are dissolved and join the next block. Memory is
bounded by the block, and the loss against one global packing is a few sequences for each task.

Defined cases: a NULL or empty text is one piece that holds the end token alone; a NULL doc_id is kept; repeated rows are packed as
often as they occur; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.tokens import encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
TEXTS_AT_ONCE = 256


@dataclass(frozen=True)
class Capacity:
    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"


def token_pieces(docs: DataFrame, size: int, end_id: int = 2, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: its ids and end_id, cut into pieces of `size` when longer. Only the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).encode, np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, own in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    own += end
                    n = len(own) // 4
                    begin, k = 0, 0
                    while begin < n:
                        stop = begin + ((n % size or size) if k == 0 else size)
                        data = own[4 * begin : 4 * stop]
                        row.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(data))
                        if with_ids:
                            ids.append(np.frombuffer(data, "<u4").astype(np.int32))
                        begin, k = stop, k + 1
                columns = [
                    part.column(0).take(pa.array(row, pa.int32())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each piece, and the residual tokens of each bin. Longest pieces first, ties in the given order."""
    n = len(lengths)
    room = np.zeros((3, max(n, 1)))
    full = np.array([1.0, 1.0, 1.0])
    limit = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    weights = np.asarray(capacity.weights)
    owner, bins = np.empty(n, np.int64), 0
    live = np.empty(max(n, 1), np.int64)  # bins that can still take a piece
    alive = 0
    smallest = np.array([lengths.min(initial=capacity.tokens), 1, 0]) / limit
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1, float(lengths[i]) ** 2]) / limit
        now = room[:, live[:alive]]
        after = now - need[:, None]
        fits = (after >= -1e-12).all(axis=0)
        if fits.any():
            score = weights @ after**2 if capacity.rule == "norm" else -((weights * need) @ now)
            at = int(np.where(fits, score, np.inf).argmin())
            b = live[at]
        else:
            if (need > 1 + 1e-12).any():
                raise ValueError(f"a piece of {lengths[i]} tokens exceeds the capacity of a sequence")
            b, at = bins, alive
            room[:, b] = full
            live[alive] = b
            bins, alive = bins + 1, alive + 1
        room[:, b] -= need
        owner[i] = b
        if (room[:, b] < smallest - 1e-12).any():  # nothing fits any more
            alive -= 1
            live[at] = live[alive]
    return owner, np.rint(room[0, :bins] * capacity.tokens).astype(np.int64)


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), block: int = 8192, slack: float = 0.02) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset. `block` pieces are packed together; sequences with more
    than `slack` of their tokens free are packed again with the next block."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, number = TaskContext.get().partitionId() << 40, 0
        held: pa.Table | None = None

        def emit(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, number
            lengths = rows.column("length").to_numpy()
            owner, free = best_fit(lengths, capacity)
            done = np.ones(len(free), bool) if last else free <= slack * capacity.tokens
            if not last and not done.any():
                done[:] = True
            take = np.flatnonzero(done[owner])
            take = take[np.argsort(owner[take], kind="stable")]
            name = np.cumsum(done) - 1
            own = owner[take]
            ends = np.cumsum(lengths[take])
            new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, int)
            base = np.repeat((ends - lengths[take])[new], np.diff(np.r_[new, len(own)]))
            chosen = rows.take(pa.array(take))
            chosen = chosen.append_column("sequence_id", pa.array(first + number + name[own], pa.int64()))
            chosen = chosen.append_column("offset", pa.array(ends - lengths[take] - base, pa.int64()))
            number += int(done.sum())
            held = rows.take(pa.array(np.flatnonzero(~done[owner])))
            yield from chosen.combine_chunks().to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                table = pa.Table.from_batches([batch.slice(at, block)])
                held = table if held is None else pa.concat_tables([held, table])
                if held.num_rows >= block:
                    yield from emit(held, False)
        if held is not None and held.num_rows:
            yield from emit(held, True)

    placed = pieces.repartition(F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.xxhash64("doc_id", "piece"), "doc_id", "piece", "start")
    return placed.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: Capacity = Capacity(), end_id: int = 2, tokenizer_path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids], sequence_id, offset of every piece of every document."""
    return pack(token_pieces(docs, capacity.tokens, end_id, tokenizer_path, with_ids), capacity)
