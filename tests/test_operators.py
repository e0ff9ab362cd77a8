"""Operators against brute force, on skewed and degenerate inputs."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelspark.operators import cube
from reelspark.operators.dedupe import first_per_key, top_n_per_group
from reelspark.operators.joins import left_join_sparse
from reelspark.operators.numbering import lazy_serial_key, serial_key
from reelspark.operators.pairs import _shared_scores, named_pair_counts, vocabulary_pair_counts
from reelspark.operators.profile import QUANTILES, completeness_profile, delivery_sketches, merged_profile
from reelspark.operators.quality import judge_rows, split_quarantine
from reelspark.operators.quantiles import _place_in_slice, _slice_of, exact_percentiles
from reelspark.operators.sampling import sample_exactly


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_percentiles_match_interpolation(spark):
    rng = random.Random(5)
    groups = {
        "hot": [rng.uniform(-50, 50) for _ in range(700)],
        "same": [3.25] * 300,
        "one": [-7.0],
        "pair": [1.0, 4.0],
        "zeros": [0.0, -0.0, 0.0, 1e-9, -1e-9],
        "narrow": [1 + i * 1e-12 for i in range(50)],
        "mixed": [1.0, None, 2.0, 10.0, 4.0, None],
        "empty": [None, None],
        None: [5.0, 6.0, 9.0],
    }
    rows = [(g, v, 2) for g, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double, w bigint").repartition(7)
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p100": 1.0}
    got = exact_percentiles(df, ["g"], "v", ps, sums={"total": F.col("w")}).collect()
    assert {r.g for r in got} == set(groups)
    for r in got:
        values = [v for v in groups[r.g] if v is not None]
        assert (r.row_count, r.total) == (len(groups[r.g]), 2 * len(groups[r.g]))
        for name, p in ps.items():
            if values:
                assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)
            else:
                assert r[name] is None


def test_values_with_a_large_offset_are_parted(spark):
    rng = np.random.default_rng(11)
    values = np.unique(np.r_[1_700_000_000 + rng.random(20_000) * 200_000, [5e-324, -5e-324, 1e-310, -1.7e308, 1.7e308]])
    df = spark.createDataFrame([(float(v),) for v in np.r_[values, -values]], "v double")
    cells = df.select("v", _slice_of(F.col("v")).alias("s"), _place_in_slice(F.col("v")).alias("p")).orderBy("v").collect()
    codes = [(r.s, r.p) for r in cells]
    assert codes == sorted(codes) and len({r.s for r in cells}) < 20 and len(set(codes)) > 0.9 * len(codes)
    # The epoch values share one slice and spread over thousands of cells of the first round.
    epochs = [(r.s, r.p) for r in cells if 1.7e9 <= r.v < 1.8e9]
    assert len({s for s, _ in epochs}) <= 2 and len(set(epochs)) > 5000
    got = exact_percentiles(df, [], "v", {"a": 0.1, "b": 0.5, "c": 0.77}).first()
    both = np.r_[values, -values]
    assert [got.a, got.b, got.c] == pytest.approx([np.quantile(both, q) for q in (0.1, 0.5, 0.77)], rel=1e-12)


def test_percentiles_keep_nan_and_infinity(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("n", 1.0), ("n", nan), ("n", 2.0), ("i", -inf), ("i", 5.0), ("i", inf), ("h", 7.0), ("h", 9.0), ("h", None)] + [("h", 7.0)] * 500
    df = spark.createDataFrame(rows, "g string, v double").withColumn("w", F.lit(1 << 62))
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", {"low": 0.0, "mid": 0.5, "top": 1.0}, sums={"total": F.col("w")}).collect()}
    assert (got["n"].row_count, got["n"].low, got["n"].mid) == (3, 1.0, 2.0) and got["n"].top != got["n"].top
    assert (got["i"].low, got["i"].mid, got["i"].top) == (-inf, 5.0, inf)
    assert (got["h"].row_count, got["h"].mid, got["h"].top, got["h"].total) == (503, 7.0, 9.0, 503 * 2**62)


def test_quartiles_of_known_multiples(spark):
    df = spark.createDataFrame([(1, x) for x in (1.0, 2.0, 4.0, 10.0)], "g int, v double")
    r = exact_percentiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    assert (r.a, r.b, r.c) == (1.75, 3.0, 5.5)


@pytest.mark.parametrize("partitions", [1, 5])
def test_serial_key_is_the_global_order(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(partitions)
    got = serial_key(df, [F.col("k").asc_nulls_first(), F.asc("i")], "id").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r.id)] == want
    assert sorted(r.id for r in got) == list(range(1, 3001))


@pytest.mark.parametrize("partitions,ranges", [(1, 1), (5, 7), (3, 64)])
def test_lazy_serial_key_runs_no_job(spark, partitions, ranges):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(partitions)
    group = f"lazy {partitions}"
    spark.sparkContext.setJobGroup(group, group)
    numbered = lazy_serial_key(df, [F.col("k"), F.col("i")], "id", ranges)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    got = numbered.collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r.id)] == want
    assert sorted(r.id for r in got) == list(range(1, 3001))
    assert lazy_serial_key(df.limit(0), [F.col("k"), F.col("i")], "id").count() == 0


def test_judge_rows_equals_plain_python(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([None, 10, 20, 30]), rng.choice([None, "a", "b", *map(str, range(40))])) for _ in range(600)]
    df = spark.createDataFrame(rows, "k int, p int, v string").repartition(5)
    parents = spark.createDataFrame([(10,), (20,), (10,), (None,)], "p int")
    stored = spark.createDataFrame([(4,), (4,), (None,)], "k int")
    got = judge_rows(df, ["k"], [("p", parents, "p")], stored, ~F.col("v").eqNullSafe("7"))
    want, free = Counter(), {}
    for k, p, v in rows:
        why = "does_not_fit" if v == "7" else "null_key" if k is None else "orphan" if p not in (10, 20) else "already_loaded" if k == 4 else None
        want[k, p, v, why or "duplicate_key"] += 1
        if why is None:
            free.setdefault(k, []).append((p is None, p or 0, v is None, v or "", (k, p, v)))
    for options in free.values():
        row = min(options)[-1]
        want[(*row, "loaded")] += 1
        want[(*row, "duplicate_key")] -= 1
    assert {tuple(r)[:4]: r.copies for r in got.collect()} == {k: n for k, n in want.items() if n}
    assert got.where("reason = 'loaded'").count() == 3


def test_serial_key_of_nothing(spark):
    assert serial_key(spark.createDataFrame([], "i int"), [F.asc("i")], "id").count() == 0


def test_dedupe_limits_before_the_shuffle(spark):
    rows = [(0, i % 50, str(i)) for i in range(900)] + [(k, 1, None) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "k int, v int, t string").repartition(6)
    first = first_per_key(df, ["k"])
    got = {r.k: (r.v, r.t) for r in first.collect()}
    assert got[0] == (0, "0") and len(got) == 30
    assert _plan(first_per_key(df, ["k"])).count("WindowGroupLimit") == 2
    top = top_n_per_group(df, ["k"], [F.desc("v"), F.asc("t")], 3).where("k = 0").orderBy("rank").collect()
    assert [(r.v, r.t, r["rank"]) for r in top] == [(49, "149", 1), (49, "199", 2), (49, "249", 3)]


def test_sparse_join_keeps_null_keys_and_spreads_them(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i) for i in range(300)], "id int, k int").repartition(4)
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 150, 3)] + [(None, "bad")], "k int, v string")
    got = {r.id: (r.k, r.v) for r in left_join_sparse(left, right, "k", ["id"]).collect()}
    assert got == {i: (None if i % 3 else i, f"v{i}" if i % 3 == 0 and i < 150 else None) for i in range(300)}


def test_vocabulary_pairs(spark):
    rng = random.Random(3)
    groups = {m: set(rng.sample(range(8), rng.randint(0, 5))) for m in range(200)}
    df = spark.createDataFrame([(m, g) for m, gs in groups.items() for g in gs], "m int, g int").repartition(5)
    want = Counter(p for gs in groups.values() for p in combinations(sorted(gs), 2))
    got = {(r.item1, r.item2): r["count"] for r in vocabulary_pair_counts(df, "m", "g").collect()}
    assert got == dict(want)


@pytest.mark.parametrize("seed,crowd,min_count", [(1, 256, 3), (2, 3, 3), (3, 0, 3), (4, 2, 1), (5, 4, 2), (6, 0, 5)])
def test_named_pairs_match_brute_force(spark, seed, crowd, min_count):
    """Few people and shared names; with a small ``crowd`` nearly every movie takes the crowded way."""
    rng = random.Random(seed)
    names = {p: f"n{p % 9}" for p in range(14)}
    credits = Counter()
    for m in range(25):
        people = range(14) if m % 5 == 0 else rng.sample(range(14), rng.randint(1, 4))
        for p in people:
            credits[(m, p)] += rng.choice([1, 1, 1, 2])
    want = Counter()
    for (m1, p1), n1 in credits.items():
        for (m2, p2), n2 in credits.items():
            if m1 == m2 and p1 < p2:
                want[(names[p1], names[p2])] += n1 * n2
    rows = [(m, p, names[p], n) for (m, p), n in credits.items()]
    df = spark.createDataFrame(rows, "movie_id int, person_id int, name string, n bigint")
    got = {(r.name1, r.name2): r["count"] for r in named_pair_counts(df, min_count, crowd).collect()}
    assert got == {k: v for k, v in want.items() if v >= min_count}
    if crowd < 256:  # the same with names that span several blocks
        got = {(r.name1, r.name2): r["count"] for r in named_pair_counts(df, min_count, crowd, block=2).collect()}
        assert got == {k: v for k, v in want.items() if v >= min_count}


def test_a_name_in_a_third_of_the_movies_leads_no_pair(spark):
    """The star is in all 900 movies, its 40 partners in 3 each: pairs cost the partners' movies, and no join key holds the star's."""
    rows = [(m, 0, "star", 1) for m in range(900)] + [(m, 1 + p, f"p{p}", 1) for p in range(40) for m in range(p, p + 3)]
    big = spark.createDataFrame(rows, "movie_id int, person_id int, name string, n bigint").withColumn("people", F.lit(1))
    candidates = spark.createDataFrame([(min("star", f"p{p}"), max("star", f"p{p}"), 0, 0) for p in range(40)], "low string, high string, forth bigint, back bigint")
    assert {(r.low, r.high, r.forth, r.back) for r in _shared_scores(candidates, big, 4096).collect()} == {(f"p{p}", "star", 0, 3) for p in range(40)}
    found = []
    for block in (10, 4096):  # two stars: the leader is dealt out
        twins = spark.createDataFrame([(m, k, f"s{k}", 1) for m in range(900) for k in range(2)], "movie_id int, person_id int, name string, n bigint")
        pairs = spark.createDataFrame([("s0", "s1", 0, 0)], "low string, high string, forth bigint, back bigint")
        found.append(_shared_scores(pairs, twins, block).collect())
    assert found[0] == found[1] and found[0][0].forth == 900


def test_one_crowded_movie_forms_no_pairs(spark):
    """A single film with everybody in it cannot make anybody meet three times, so it yields no candidates."""
    from reelspark.operators.pairs import _reachable_pairs

    crowd = [(0, p, f"n{p}", 1) for p in range(2000)]
    df = spark.createDataFrame(crowd, "movie_id int, person_id int, name string, n bigint")
    assert _reachable_pairs(df.withColumn("people", F.lit(2000)), 3).count() == 0
    assert named_pair_counts(df, 3).count() == 0


def test_merged_sketches_are_near_exact_counts(spark, tmp_path):
    rng = np.random.default_rng(12)
    values = rng.normal(50, 20, 30_000)
    rows = [(f"d{i % 4}", int(i % 7000), float(v) if i % 10 else None, None, f"n{i % 3}") for i, v in enumerate(values)] + [("d9", None, float("nan"), None, None)]
    df = spark.createDataFrame(rows, "day string, k int, v double, e int, s string").repartition(6)
    for day in ("d0", "d1", "d2", "d3", "d9"):  # a delivery at a time
        delivery_sketches(df.where(F.col("day") == day), "day").write.mode("append").parquet(str(tmp_path))
    stored = spark.read.parquet(str(tmp_path))
    got = {r.column_name: r for r in merged_profile(stored).collect()}
    assert {c: (r.total, r.filled) for c, r in got.items()} == {"k": (30_001, 30_000), "v": (30_001, 27_001), "e": (30_001, 0), "s": (30_001, 30_000)}
    assert abs(got["k"].distinct_values - 7000) < 0.05 * 7000 and got["s"].distinct_values == 3 and got["e"].distinct_values == 0
    kept = np.sort([v for i, v in enumerate(values) if i % 10])
    assert all(abs(np.searchsorted(kept, got["v"][name]) / len(kept) - p) < 0.03 for name, p in QUANTILES.items())
    assert got["e"].median is None and got["s"].median is None
    assert {r.column_name: r.total for r in merged_profile(stored.where("day in ('d0', 'd9')")).collect()} == {c: 7501 for c in "kves"}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    a = {r.id for r in sample_exactly(df, 40, F.col("id"), 1).collect()}
    b = {r.id for r in sample_exactly(df.repartition(9), 40, F.col("id"), 1).collect()}
    c = {r.id for r in sample_exactly(df, 40, F.col("id"), 2).collect()}
    assert len(a) == 40 and a == b and a != c
    assert sample_exactly(df, 900, F.col("id")).count() == 500


def test_quarantine_accounts_for_every_row(spark):
    rows = [(1, 10, "a"), (1, 10, "a"), (1, 10, "b"), (1, 99, "x"), (None, 10, "y"), (2, 20, None), (2, 20, None), (2, 20, None)]
    df = spark.createDataFrame(rows, "m int, p int, t string")
    people = spark.createDataFrame([(10,), (20,)], "id int")
    loaded, rejected = split_quarantine(df, ["m", "p"], [("p", people, "id")])
    assert sorted(map(tuple, loaded.collect()), key=str) == [(1, 10, "a"), (2, 20, None)]
    got = {(r.m, r.p, r.t, r.reason): r.copies for r in rejected.collect()}
    assert got == {
        (1, 10, "a", "duplicate_key"): 1,
        (1, 10, "b", "duplicate_key"): 1,
        (1, 99, "x", "orphan"): 1,
        (None, 10, "y", "null_key"): 1,
        (2, 20, None, "duplicate_key"): 2,
    }
    assert loaded.count() + sum(got.values()) == len(rows)


def test_profile_is_one_scan(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    got = {r.column_name: (r.total, r.filled, r.filled_pct) for r in completeness_profile(df).collect()}
    assert got == {"a": (3, 3, 100.0), "b": (3, 1, 33.33)}


def test_cube_levels(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 7), (2, 1, 1)], "y int, m int, v int")
    total = cube.rollup_query(df, ["y", "m"], {"v": F.sum("v")}).collect()
    assert {(r.level, r.y, r.m): r.v for r in total} == {
        (0, None, None): 13, (1, 1, None): 12, (1, 2, None): 1, (2, 1, 1): 5, (2, 1, 2): 7, (2, 2, 1): 1,
    }
    assert cube.olap_slice(df, "y", 1).count() == 2
    assert cube.olap_dice(df, {"y": (1, 2), "m": [1]}).count() == 2
    assert cube.cube_query(df, ["m"], {"v": F.max("v")}, F.col("y") == 1).count() == 2


def test_judge_rows_ranks_apart_from_its_joins(spark):
    """A join by part of the key has all rows of that part in one task, which then sorted them for both rankings too."""
    df = spark.createDataFrame([(1, i, v) for i in range(40) for v in "ab"], "m int, p int, v string")
    parents = [("m", spark.createDataFrame([(1,)], "id int"), "id")]
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = judge_rows(df, ["m", "p"], parents).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len({r.task for r in got}) > 1
    assert Counter((r.v, r.reason) for r in got) == {("a", "loaded"): 40, ("b", "duplicate_key"): 40}
