"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.session import cut_lineage

EDGES_A_TASK = 100_000
MOST_HELD = 1_000_000  # nodes that a task joins by itself before it starts anew


class Unions(dict):
    """Union-find over numbers; the root is the smallest."""

    def find(self, x: int) -> int:
        root = x
        while (up := self.get(root, root)) != root:
            root = up
        while (up := self.get(x, x)) != root:
            self[x] = root
            x = up
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the edges of a partition as they come, up to MOST_HELD nodes at a time; one edge for each node that isn't a root."""
    unions = Unions()

    def found() -> pa.RecordBatch:
        rows = sorted((x, unions.find(x)) for x in unions)
        return pa.RecordBatch.from_arrays([pa.array(np.array([r[k] for r in rows], np.int64)) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for x, y in zip(*(c.to_pylist() for c in batch.columns)):
            unions.join(x, y)
        if len(unions) > MOST_HELD:
            yield found()
            unions = Unions()
    yield found()


def _least(edges: DataFrame) -> DataFrame:
    """a, least: the smallest b of each a, combined before it is shuffled."""
    return edges.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is led to the smallest node around it (itself included)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    led = both.join(_least(both), F.col("a") == F.col("hub")).where("b > a")
    return led.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is led to the smallest of them."""
    led = edges.join(_least(edges), F.col("a") == F.col("hub"))
    return led.select(F.when(F.col("b") == F.col("least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("least").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node that can be reached) for all nodes of edges (a, b) with two different ends.

    An edge is kept as (larger end, smaller end). A round leads nodes to the smallest neighbour of a node they share: a minimum for each node,
    joined back to its edges, so a round has at most twice the edges and a hub's edges are spread by Spark's skew join. The number of rounds
    grows with the logarithm of the longest path. Rounds end when nothing changes. They are checkpointed, and only a count and a checksum
    reach the driver. Edges with a NULL end are dropped; an empty table gives no rows.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges = edges.dropna(subset=["a", "b"]).where("a != b").select(*ends)
    edges = cut_lineage(edges.mapInArrow(_contract, "a bigint, b bigint").distinct())
    before = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        before = now
        tasks = now[0] // EDGES_A_TASK + 1  # few edges need few tasks, however many partitions a shuffle has
        edges = cut_lineage(_small_star(_large_star(edges.coalesce(tasks)).coalesce(tasks)).coalesce(tasks))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
