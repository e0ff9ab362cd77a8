"""The matcher against the pairwise rule it replaces, and its invariants."""

import random

import pytest

from reelspark.plans import spine

CORE = "ml_id int, title_key string, year int"
RT = "rt_slug string, title_key string, year int"


def _pairwise(core, rt, require_year):
    """Best right per left, then best left per right, over all pairs; a second pass on what is left."""

    def one_pass(left, right, fits):
        chosen = {}
        for ml, t, y in left:
            slugs = [s for s, u, z in right if t is not None and t == u and fits(y, z)]
            if slugs:
                chosen[ml] = min(slugs)
        best = {}
        for ml, slug in chosen.items():
            best[slug] = min(ml, best.get(slug, ml))
        return {(ml, slug) for slug, ml in best.items()}

    def same(y, z):
        return not require_year or (y is not None and y == z)

    def near(y, z):
        return y is not None and z is not None and abs(y - z) <= 1

    exact = one_pass(core, rt, same)
    mls, slugs = {m for m, _ in exact}, {s for _, s in exact}
    fuzzy = one_pass([c for c in core if c[0] not in mls], [r for r in rt if r[0] not in slugs], near)
    return {(*p, spine.EXACT) for p in exact} | {(*p, spine.FUZZY) for p in fuzzy}


@pytest.mark.parametrize("seed,require_year", [(1, True), (2, True), (3, False), (4, False)])
def test_match_equals_pairwise_rule(spark, seed, require_year):
    rng = random.Random(seed)
    titles = ["hot"] * 6 + ["a", "b", "c", "d", None]
    core = [(i, rng.choice(titles), rng.choice([None, *range(1990, 2001)])) for i in range(150)]
    rt = [(f"s{i:03d}", rng.choice(titles), rng.choice([None, *range(1990, 2001)])) for i in range(120)]
    got = spine.match_rt(spark.createDataFrame(core, CORE), spark.createDataFrame(rt, RT), require_year)
    assert {tuple(r) for r in got.collect()} == _pairwise(core, rt, require_year)


def test_a_hot_title_is_not_paired(spark):
    """3000 films and 3000 records of one title: nine million pairs, none of which is formed."""
    core = spark.createDataFrame([(i, "hot", 1990 + i % 3) for i in range(3000)], CORE)
    rt = spark.createDataFrame([(f"s{i:04d}", "hot", 1990 + i % 3) for i in range(3000)], RT)
    matches = spine.match_rt(core, rt)
    got = matches.collect()
    assert {(r.ml_id, r.rt_slug) for r in got if r.rt_match_method == spine.EXACT} == {(0, "s0000"), (1, "s0001"), (2, "s0002")}
    plan = spine.match_exact(core, rt)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 2


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(9)
    links = [(i, str(i * 7), i * 3 if i % 4 else None) for i in range(1, 80)]
    films = [(i, f"T{i % 9} ({1990 + i % 5})", "x") for i in range(1, 80)]
    tmdb = [(i, f"T{i % 9}", "1991-02-03") for i in range(1, 120)]
    basics = [(f"tt{i:07d}", "movie" if i % 5 else "short", f"T{i % 7}", "1992") for i in range(1, 300, 2)]
    rt = [(f"s{i}", f"t{i % 9}", 1990 + i % 6) for i in range(60)]
    for rows in (links, films, tmdb, basics, rt):
        rng.shuffle(rows)

    def run(n, lazy=False):
        def df(rows, schema):
            return spark.createDataFrame(rows, schema).repartition(n)

        inputs = spine.SpineInputs(
            df(links, "movieId int, imdbId string, tmdbId int"),
            df(films, "movieId int, title string, genres string"),
            df(tmdb, "id int, title string, release_date string"),
            df(basics, "tconst string, titleType string, primaryTitle string, startYear string"),
            df(rt, "slug string, title string, release_year int"),
        )
        return sorted(map(tuple, spine.build_entity_spine(inputs, "2024-01-01", lazy=lazy).collect()))

    once = run(1)
    assert once == run(6) == run(3, lazy=True)
    ids = [r[0] for r in once]
    assert ids == list(range(1, len(once) + 1))
    slugs = [r[4] for r in once if r[4]]
    assert len(slugs) == len(set(slugs)) == 60
    assert {r[1] for r in once if r[1]} == {i for i, _, _ in links}
    assert {r[3] for r in once if r[3]} >= {i for i, _, _ in tmdb}
