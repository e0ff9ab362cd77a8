"""Conversation repair, bit-sliced search and norm buckets against brute force, and their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.llm import bit_sliced, conversation_repair, norm_buckets

# --- conversation repair ---

AFTER_INSERT = {0: 2, 1: 2, 2: 3, 3: 2}
AFTER_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}


def with_insertions(best):
    for _ in range(4):
        for s, (cost, audit) in list(best.items()):
            best[AFTER_INSERT[s]] = min(best.get(AFTER_INSERT[s], (1 << 40, "")), (cost + 2, audit + "I"))
    return best


def cheapest(rows):
    """(cost, audit) of rows (role initial, usable, truncated) by a forward search over whole audits."""
    best = with_insertions({0: (0, "")})
    for role, usable, truncated in rows:
        new = {}
        for s, (cost, audit) in best.items():
            ways = [(s, cost + 3, "D")]
            if usable:
                ways.append((AFTER_INSERT[s], cost + 2 + truncated, "R"))
                if (role, s) in AFTER_KEEP:
                    ways.append((AFTER_KEEP[role, s], cost + truncated, "K"))
            for t, c, letter in ways:
                new[t] = min(new.get(t, (1 << 40, "")), (c, audit + letter))
        best = with_insertions(new)
    return min(best[s] for s in (0, 3) if s in best)


def coded(code):
    return [("sua?"[c & 3], c >> 2 in (0, 3), c >> 2 == 3) for c in code.tolist()]


def test_least_audits_of_batches_and_blocks():
    rng = random.Random(31)
    for _ in range(300):
        codes = [np.array([rng.randrange(16) if rng.random() < 0.6 else rng.choice([1, 2]) for _ in range(rng.randrange(10))], np.uint8) for _ in range(12)]
        code = np.concatenate([x for c in codes for x in (c, np.zeros(1, np.uint8))])
        last = np.cumsum([len(c) + 1 for c in codes]) - 1
        for c, (audit, _, cost) in zip(codes, conversation_repair.least_paths(code, last, np.zeros(12, np.int64), conversation_repair.END)):
            want = cheapest(coded(c))
            assert (cost, audit.decode()) == want
            audit, cost = conversation_repair.audit(c, block=rng.choice([1, 2, 3, 7]))
            assert (cost, audit.decode()) == want


def expected_report(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest())
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        m = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if m:
            text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
            kept[conv] += [(conv, turn, "user" if m == 4 else role, text)] * (2 if m == 3 else 1)
    for conv, own in kept.items():
        own.sort(key=key)
        seen, faults = set(), []
        for _, _, role, text in own:
            left = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not left else "duplicate" if (role, text) in seen else "" if left[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = cheapest([(r[2][:1], f in ("", "truncated"), f == "truncated") for r, f in zip(own, faults)])
        lines, state, at = [], 0, 0
        for letter in audit:
            if letter == "I":
                state = AFTER_INSERT[state]
                lines.append("assistant:" if state == 3 else "user:")
                continue
            _, _, role, text = own[at]
            at += 1
            if letter == "K":
                state = AFTER_KEEP[role[0], state]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = AFTER_INSERT[state]
                lines.append(("assistant:" if state == 3 else "user:") + text)
        turns = {r[1] for r in own if r[1] is not None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        yield (
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )


@pytest.mark.parametrize("segment", [4096, 2])
def test_damage_report(spark, monkeypatch, segment):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rng = random.Random(32)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, None if rng.random() < 0.1 else turn + (turn > 5), role, rng.choice(["Yes.", "no", None, "", " \n", "Ça va?", "x! \t", "other words"])))
    rows += [(1000, i, "user" if i % 2 == 0 else "assistant", f"Long talk {i}.") for i in range(3000)] + [(1001, 5, "user", "Same."), (1001, 5, "user", "Same.")]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit(1) for c in ("pos", "code", "audit", "n", "codes")})
    got = conversation_repair.damage_report(table.repartition(5)).collect()
    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(expected_report(rows), key=str)
    assert conversation_repair.damage_report(table.limit(0)).count() == 0


def test_repaired_rows_follow_the_grammar(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Ok?"), (2, 0, "system", "Be kind."), (2, 1, "user", "Hm."), (2, 2, "user", " "), (2, 3, "assistant", "Yes"), (3, 0, "x", "")]
    judged, lines = conversation_repair.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    found = defaultdict(list)
    for r in sorted(lines.collect(), key=lambda r: (r.conv_id, r.n)):
        found[r.conv_id].append((r.role, r.text, r.edit))
    assert found[2] == [("system", "Be kind.", "Keep"), ("user", "Hm.", "Keep"), ("assistant", "Yes", "Keep")]
    assert found[1] == [("user", "", "Insert"), ("assistant", "Hi.", "Keep"), ("user", "Ok?", "Keep"), ("assistant", "", "Insert")] or len(found[1]) == 2
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in found[c])) for c in (1, 2, 3))
    assert {r.conv_id: r.audit for r in judged.collect()}[3] == "D" and 3 not in [c for c in found if found[c]]


# --- bit-sliced search ---


def nearest_by_hand(rows, k=20, every=20):
    usable = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, q in usable:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,block", [(16_384, 256), (37, 3)])
def test_nearest(spark, monkeypatch, shard_rows, block):
    rng = random.Random(33)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), 0.25, 0.0]) for _ in range(9)]) for i in range(-60, 400)]
    rows += [(500 + i, [0.5] * 9) for i in range(70)]  # ties beyond k
    rows += [(20, None), (40, [None] * 9), (60, [float("nan")] * 9), (80, [float("inf")] + [0.0] * 8), (None, [0.1] * 9), (640, [1.0, 2.0]), (641, [3.0, -1.0]), (660, [])]
    rows += [(500, [0.5] * 9), (520, [-0.5] * 9), (700, [1000.0] * 9)]  # a repeated row, a second vector, a large one
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "shard", "block", "score", "rank", "ids")})
    values = bit_sliced.quantised(table)
    got = bit_sliced.search(values.where(F.col("vec_id") % 20 == 0), values, 20, shard_rows, block)
    assert sorted(tuple(r) for r in got.collect()) == nearest_by_hand(rows)
    assert bit_sliced.nearest(table.limit(0)).count() == 0


def test_slices_add_up():
    rng = np.random.default_rng(34)
    values = rng.integers(-90, 50, (300, 7))
    values[:, 3] = 5  # no slices at all
    low, width, slices = bit_sliced.sliced(values)
    shard = bit_sliced.Shard(300, np.arange(300), low, width, slices)
    for weights in [rng.integers(-70, 70, 7) for _ in range(20)] + [np.zeros(7, np.int64)]:
        sums, constant = shard.scores(weights)
        got = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:300].astype(np.int64) << w for w, s in enumerate(sums)) + constant
        assert (got == values @ weights).all()


# --- norm buckets ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked_by_hand(docs, items, k=10):
    terms = lambda t: TERM.findall((t or "").translate(UPPER))
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, df = sum(sum(c.values()) for _, c in bags), Counter(t for _, c in bags for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in bags:
            m = 100 - 75 + (75 * sum(c.values()) * len(bags)) // total
            s = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_terms_equal_the_pattern():
    rng = random.Random(35)
    alphabet = [chr(i) for i in range(128)] + list("ÉéßΩ日  İ")
    for _ in range(500):
        t = "".join(rng.choices(alphabet, k=rng.randrange(30)))
        assert [w.decode() for w in norm_buckets.terms_of(t)] == TERM.findall(t.translate(UPPER))


@pytest.mark.parametrize("bucket,chunk,block_bytes", [(128, 1_000_000, 1_000_000), (4, 30, 300)])
def test_rank_documents(spark, monkeypatch, bucket, chunk, block_bytes):
    monkeypatch.setattr(norm_buckets, "BUCKET", bucket)
    monkeypatch.setattr(norm_buckets, "CHUNK_TERMS", chunk)
    rng = random.Random(36)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(80))) for _ in range(300)]
    docs = list(enumerate(texts)) + [(1000 + i, texts[0]) for i in range(40)] + [(7, texts[7]), (None, texts[3]), (900, None), (901, ""), (902, "?! --"), (903, "w59 " * 5000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 15)))) for i in range(25)] + [(50, None), (51, ""), (52, "W1,w1;W1 w59"), (52, "W1,w1;W1 w59"), (53, "absent"), (54, texts[0])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("n", "terms", "counts", "score", "rank", "item")})
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = norm_buckets.rank_documents(d.repartition(3), b, block_bytes=block_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_by_hand(docs, [x for x in items if x[1] is not None])
    assert norm_buckets.rank_documents(d.limit(0), b).count() == 0 and norm_buckets.rank_documents(d, b.limit(0)).count() == 0


def test_buckets_are_pruned():
    rng = np.random.default_rng(37)
    words = np.array([f"t{i}" for i in range(400)])
    share = 1 / np.arange(10, 410)
    texts = [" ".join(rng.choice(words, 40, p=share / share.sum())) for _ in range(4000)]
    queries = norm_buckets.Queries([(str(i), texts[i]) for i in range(5)])
    bags = [Counter(norm_buckets.terms_of(t)) for t in texts]
    df = Counter(queries.vocabulary[w] for c in bags for w in c if w in queries.vocabulary)
    queries.weigh(len(texts), 40 * len(texts), df)
    rows = [(d, queries.vocabulary[w], n) for d, c in enumerate(bags) for w, n in sorted(c.items()) if w in queries.vocabulary]
    rows.sort()
    doc, term, tf = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    best = norm_buckets.Best(5, 10)
    scored = norm_buckets.search_chunk(queries, best, np.arange(4000), [40] * 4000, doc, term, tf)
    assert scored < 0.5 * 5 * 4000 and (best.ids[:, 0] == np.arange(5)).all()
