"""Conversations repaired by the cheapest edits, ties broken by the least audit.

A repaired conversation's role initials read (s?(ua)+)?. Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only choice for a blank or
repeated row), Insert an empty user or assistant row 2; a truncated row that isn't deleted adds 1. The audit is the string of the edits'
initials; of the cheapest ones the ASCII-least is taken.

Nodes of the search are (row, state), with four states: start, after s, after u, after a. A dynamic programme from the last row backward
gives every node its cost to the end; arcs that lose nothing of it are the optimal arcs. Prefix doubling then ranks the nodes by their least
audits of 1, 2, 4, ... letters: the rank of 2k letters follows from the node's rank of k letters and the rank of the node that its doubled pointer
reaches after k letters. Of a node's optimal arcs the one with the least (letter, rank of its end) is taken, and the doubled pointers of
these arcs give all nodes of the least path at once.

Spark orders the rows of all conversations in one range sort (a long conversation spans several partitions), numbers them, and finds
repeated rows by a minimum for each (conversation, role, text). Only one character for each row is brought together for a conversation, in segments, as many as its
audit has at least; long ones are searched in blocks of BLOCK rows, joined by the four costs at each border. Texts are never held: edits are
applied while the ordered rows stream by.

Defined cases: NULL role or text is one space; a NULL conv_id is a conversation, a NULL turn comes first and is ignored by gaps; rows of
one turn are ordered by role and the text's md5; a role counts by its first character; a conversation without rows has an empty audit;
repeated input rows are repeated rows; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.session import cut_lineage

BLOCK = 65_536  # rows searched at once
SEGMENT = 4096
FEW = 8  # longest conversations of a batch whose costs are counted in plain numbers
BLANKS = " \t\n\x0b\x0c\r"
LETTERS = np.frombuffer(b"DIKR", np.uint8)
DELETE, INSERT, KEEP, REROLE = range(4)
FAR = 1 << 40
ROLES = {2: "user", 3: "assistant"}
INSERTED = np.array([2, 2, 3, 2])  # the state after an inserted (or reroled) row, by state: user, user, assistant, user
STARTS_WITH = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1] * 4])  # the state after a kept row, by role (s, u, a, other) and state
# A row's character is chr(48 + role + 4 * fault); faults:
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after a fixed damage by crc32(`conv_id:turn`) % 20."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    mark = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    marked = rows.select(F.col("`conv_id`").alias("conv_id"), F.col("`turn`").alias("turn"), name("role").alias("role"), name("text").alias("text"), mark.alias("m"))
    text = F.when(F.col("m") == 1, "").when(F.col("m") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("m") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    role = F.when(F.col("m") == 4, "user").otherwise(F.col("role"))
    return marked.where("m != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, pos: rows by conversation and turn, pos growing in that order. Stored, as pos depends on sampled bounds."""
    keys = ["conv_id", F.asc_nulls_first("turn"), "role", "mark", "spread"]  # spread parts rows that are equal in everything
    rows = rows.withColumns({"mark": F.md5(F.col("text").cast("binary")), "spread": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut_lineage(rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")))


def _role(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def row_codes(rows: DataFrame) -> DataFrame:
    """conv_id, pos, code: role and first fault of every row of `ordered`."""
    same = F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))
    first = rows.groupBy("conv_id", same.alias("same")).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    judged = rows.select("conv_id", "pos", _role(F.col("role")).alias("role"), last.alias("last")).join(first, "pos", "left")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("last").isin(*".!?"), TRUNCATED).otherwise(SOUND)
    return judged.select("conv_id", "pos", F.char(48 + F.col("role") + 4 * fault).alias("code"))


def conversation_codes(codes: DataFrame) -> DataFrame:
    """conv_id, codes: one character for each row, in order."""
    joined = lambda by, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, what))), lambda x: x[what]), "")
    parts = codes.groupBy("conv_id", F.expr(f"pos div {SEGMENT}").alias("segment")).agg(joined("pos", "code").alias("part"))
    return parts.groupBy("conv_id").agg(joined("segment", "part").alias("codes"))


def _by_insertion(d: np.ndarray) -> np.ndarray:
    """Costs of nodes (rows of four states) when rows may be inserted there."""
    u, a = np.minimum(d[:, 2], 2 + d[:, 3]), np.minimum(d[:, 3], 2 + d[:, 2])
    return np.stack([np.minimum(d[:, 0], 2 + u), np.minimum(d[:, 1], 2 + u), u, a], axis=1)


END = _by_insertion(np.array([[0, FAR, FAR, 0]]))[0]


def _arcs(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs [row, state, letter] of the arcs that use a row; `after`: costs of the nodes behind it."""
    role, fault = code & 3, code >> 2
    whole, more = (fault == SOUND) | (fault == TRUNCATED), (fault == TRUNCATED).astype(np.int64)
    out = np.full((len(code), 4, 4), FAR, np.int64)
    out[:, :, DELETE] = 3 + after
    to = STARTS_WITH[role]
    kept = np.take_along_axis(after, np.maximum(to, 0), axis=1) + more[:, None]
    out[:, :, KEEP] = np.where((to >= 0) & whole[:, None], kept, FAR)
    out[:, :, REROLE] = np.where(whole[:, None], 2 + more[:, None] + after[:, INSERTED], FAR)
    return out


def _costs_of_one(code: list[int], end: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Costs of the nodes before each row of one conversation, last row first; the same rules as _arcs in plain numbers."""
    s, b, u, a = (int(x) for x in end)  # start, after s, after u, after a
    out = []
    for x in reversed(code):
        role, fault = x & 3, x >> 2
        new = [3 + s, 3 + b, 3 + u, 3 + a]
        if fault in (SOUND, TRUNCATED):
            more = fault == TRUNCATED
            to_user, to_assistant = more + u + 2 * (role != 1), more + a + 2 * (role != 2)
            new = [min(new[0], to_user, more + b if role == 0 else FAR), min(new[1], to_user), min(new[2], to_assistant), min(new[3], to_user)]
        u, a = min(new[2], 2 + new[3]), min(new[3], 2 + new[2])
        s, b = min(new[0], 2 + u), min(new[1], 2 + u)
        out.append((s, b, u, a))
    return out


def costs(code: np.ndarray, last: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cost to the end of every node. Conversations lie end to end; `last` are the places behind their last rows, which hold no row."""
    d = np.empty((len(code), 4), np.int64)
    d[last] = end
    length = np.diff(np.r_[-1, last]) - 1
    order = np.argsort(-length, kind="stable")
    at, length = last[order], length[order]
    together = int(length[FEW]) if len(length) > FEW else 0
    for k in range(min(FEW, len(length))):  # the longest ones by themselves, without arrays
        rows = np.arange(at[k] - 1, at[k] - 1 - length[k], -1)
        d[rows] = np.array(_costs_of_one(code[rows[::-1]].tolist(), d[at[k]]), np.int64).reshape(-1, 4)
    at, length = at[FEW:], length[FEW:]
    for back in range(1, together + 1):
        rows = at[: np.searchsorted(-length, -back, "right")] - back
        d[rows] = _by_insertion(_arcs(code[rows], d[rows + 1]).min(axis=2))
    return d


def least_paths(code: np.ndarray, last: np.ndarray, entry: np.ndarray, end: np.ndarray, whole: bool = True) -> list[tuple[bytes, int, int]]:
    """Audit, exit state and cost of each conversation of a block (see costs) from its entry state on.

    A path ends behind the last row: in a state that may end a conversation, or, where rows of another block follow (not whole), in any."""
    d = costs(code, last, end)
    n = len(code)
    is_last = np.zeros(n, bool)
    is_last[last] = True
    place, state = np.arange(n)[:, None], np.arange(4)[None, :]
    arc = _arcs(code, d[np.minimum(np.arange(n) + 1, n - 1)])
    arc[is_last] = FAR
    arc[:, :, INSERT] = 2 + d[:, INSERTED]
    stops = np.zeros((n, 4), bool)
    stops[last] = END == 0 if whole else True
    arc[stops] = FAR
    optimal = arc == d[:, :, None]
    goes = np.empty((n, 4, 4), np.int64)  # the node at the end of each arc
    behind = (np.minimum(place + 1, n - 1)) * 4
    goes[:, :, DELETE] = behind + state
    goes[:, :, INSERT] = place * 4 + INSERTED
    goes[:, :, KEEP] = behind + np.maximum(STARTS_WITH[code & 3], 0)
    goes[:, :, REROLE] = behind + INSERTED
    optimal, goes = optimal.reshape(-1, 4), goes.reshape(-1, 4)
    nodes = np.arange(4 * n)
    letter = np.where(optimal.any(axis=1), optimal.argmax(axis=1), -1)  # -1: the path has ended
    pointer = np.where(letter < 0, nodes, goes[nodes, np.maximum(letter, 0)])
    start = np.r_[0, last[:-1] + 1] * 4 + entry
    rank, doubled = letter + 1, [pointer]
    while (letter[doubled[-1][start]] >= 0).any():
        key = rank * (int(rank.max()) + 1) + rank[doubled[-1]]
        rank = np.unique(key, return_inverse=True)[1].reshape(-1)
        doubled.append(doubled[-1][doubled[-1]])
    # The arc with the least letter, and among equal letters the least rank of its end.
    choice = np.where(optimal, np.arange(4) * (int(rank.max()) + 1) + rank[goes], np.iinfo(np.int64).max)
    best = choice.argmin(axis=1)
    pointer = np.where(letter < 0, nodes, goes[nodes, best])
    path = start[:, None]
    steps = [pointer]
    for _ in doubled[1:]:
        steps.append(steps[-1][steps[-1]])
    for step in reversed(steps):  # nodes after 0, 1, 2, ... letters, twice as many each time
        path = np.stack([path, step[path]], axis=2).reshape(len(start), -1)
    spelt = np.where(letter[path] >= 0, LETTERS[best[path]], 0).astype(np.uint8)
    leaves = steps[-1][path[:, -1]] % 4
    cost = d.reshape(-1)[start]
    return [(row.tobytes().rstrip(b"\0"), int(s), int(c)) for row, s, c in zip(spelt, leaves, cost)]


def audit(code: np.ndarray, block: int = BLOCK) -> tuple[bytes, int]:
    """Least audit and cost of one conversation of any length, block by block."""
    starts = list(range(0, max(len(code), 1), block))
    borders = [END]
    for at in reversed(starts[1:]):  # costs at the borders of the blocks
        part = np.r_[code[at : at + block], 0].astype(np.uint8)
        borders.append(costs(part, np.array([len(part) - 1]), borders[-1])[0])
    out, state, cost = [], 0, None
    for at, end in zip(starts, reversed(borders)):
        part = np.r_[code[at : at + block], 0].astype(np.uint8)
        spelt, state, c = least_paths(part, np.array([len(part) - 1]), np.array([state]), end, at == starts[-1])[0]
        out.append(spelt)
        cost = c if cost is None else cost
    return b"".join(out), cost


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]
    for batch in batches:
        codes = [np.frombuffer((c or "").encode("ascii"), np.uint8) - 48 for c in batch.column("codes").to_pylist()]
        found: list[tuple[bytes, int] | None] = [None] * len(codes)
        held: list[int] = []

        def search() -> None:
            code = np.concatenate([x for k in held for x in (codes[k], np.zeros(1, np.uint8))])  # noqa: B023
            last = np.cumsum([len(codes[k]) + 1 for k in held]) - 1  # noqa: B023
            for k, (spelt, _, cost) in zip(held, least_paths(code, last, np.zeros(len(held), np.int64), END)):  # noqa: B023
                found[k] = (spelt, cost)  # noqa: B023
            held.clear()  # noqa: B023

        for k in sorted(range(len(codes)), key=lambda k: len(codes[k])):  # noqa: B023  those of about one length together
            if len(codes[k]) >= BLOCK:
                found[k] = audit(codes[k])
                continue
            if (len(held) + 1) * (len(codes[k]) + 1) > BLOCK:
                search()
            held.append(k)
        if held:
            search()
        counts = [[int((c >> 2 == f).sum()) for c in codes] for f in (BLANK, DUPLICATE, TRUNCATED)]
        pairs = ((c[:-1] & 3, c[1:] & 3) for c in codes)
        counts.append([int((~(((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1)))).sum()) for a, b in pairs])
        counts.append([f[1] for f in found])
        others = batch.select([c for c in batch.schema.names if c != "codes"])
        columns = [*others.columns, *(pa.array(c, pa.int64()) for c in counts), pa.array([f[0].decode() for f in found], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*others.schema.names, *names, "audit"])


def _same_key(a: DataFrame, b: DataFrame, how: str = "left") -> DataFrame:
    """a with the columns of b of the same conv_id, NULL included."""
    b = b.withColumnRenamed("conv_id", "__conv")
    return a.join(b, F.col("conv_id").eqNullSafe(F.col("__conv")), how).drop("__conv")


def audits(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conv_id of `conversations`; rows: ordered."""
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    gaps = turns.agg(F.coalesce((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint"), F.lit(0)).alias("gaps"))
    ids = conversations.select(F.col("`conv_id`").alias("conv_id")).distinct()
    known = _same_key(_same_key(ids, gaps), conversation_codes(row_codes(rows))).withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("bigint")))
    counts = [T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    kept = [f for f in known.schema.fields if f.name != "codes"]
    return known.mapInArrow(_judge, T.StructType([*kept, *counts, T.StructField("audit", T.StringType())]))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation in order, its audit before them; gives the repaired rows."""
    conv, letters, at, tail, state, n = None, b"", 0, 0, 0, 0
    out: list[list] = []

    def give(role: str, text: str, edit: str) -> None:
        nonlocal n
        for column, x in zip(out, (conv, n, role, text, edit)):
            column.append(x)
        n += 1

    def insert() -> None:
        nonlocal at, state
        state = int(INSERTED[state])
        give(ROLES[state], "", "Insert")
        at += 1

    for batch in batches:
        out = [[], [], [], [], []]

        for c, pos, role, text, spelt in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "pos", "role", "text", "audit"))):
            if pos < 0:
                conv, letters, at, state, n = c, spelt.encode(), 0, 0, 0
                tail = len(letters.rstrip(b"I"))  # what follows is inserted behind the last row
                continue
            while letters[at] == 73:
                insert()
            letter, at = letters[at], at + 1
            if letter == 75:
                state = int(STARTS_WITH["sua".index(role[0])][state])
                give(role, text, "Keep")
            elif letter == 82:
                state = int(INSERTED[state])
                give(ROLES[state], text, "Rerole")
            while tail <= at < len(letters):
                insert()
        schema = pa.schema([batch.schema.field("conv_id"), ("n", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema)


def repaired(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """conv_id, n (from 0), role, text, edit: the repaired conversations, each in one partition and in order. rows: ordered, judged: audits."""
    heads = judged.select("conv_id", F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    stream = rows.select("conv_id", "pos", "role", "text", F.lit("").alias("audit")).union(heads).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    fields = [stream.schema["conv_id"], T.StructField("n", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("role", "text", "edit"))]
    return stream.mapInArrow(_apply, T.StructType(fields))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, running, schema = None, None, None
    for batch in batches:
        done = []
        schema = pa.schema([batch.schema.field("conv_id"), ("repaired_sha256", pa.string())])
        for c, n, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "n", "role", "text"))):
            if n == 0:
                if running:
                    done.append((conv, running.hexdigest()))
                conv, running = c, hashlib.sha256()
            running.update(f"{chr(10) if n else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(schema)], schema=schema)
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((conv, running.hexdigest()), schema)], schema=schema)


def repair(conversations: DataFrame, of: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The audit table and the repaired rows of conversations (conv_id, turn, role, text). `of`: a table with further conv_ids, which have no rows."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(c)
    rows = ordered(conversations.select(F.col("`conv_id`").alias("conv_id"), F.col("`turn`").alias("turn"), name("role"), name("text")))
    judged = cut_lineage(audits(conversations if of is None else of, rows))
    return judged, repaired(rows, judged)


def damage_report(conversations: DataFrame) -> DataFrame:
    """Audits of the damaged conversations, with repaired_sha256 of their repaired `role:text` lines."""
    judged, lines = repair(damaged(conversations), conversations)
    hashes = lines.mapInArrow(_hash, T.StructType([lines.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())]))
    return _same_key(judged, hashes).withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())))
