"""Counts of pairs that share a group: genres of a movie, people of a movie."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.operators.dedupe import top_n_per_group


def vocabulary_pair_counts(memberships: DataFrame, group: str, item: str) -> DataFrame:
    """Groups per pair (item1 < item2) of a small vocabulary, for example genres.

    Groups with the same items are folded into one weighted item set before any pair is formed, so the pairs
    built depend on the distinct combinations of the vocabulary and not on the number of groups.
    """
    item_sets = memberships.groupBy(group).agg(F.array_sort(F.collect_set(item)).alias("items"))
    weighted = item_sets.groupBy("items").agg(F.count("*").alias("weight"))
    firsts = weighted.select("items", "weight", F.posexplode("items").alias("pos", "item1"))
    pairs = firsts.select(
        "item1", F.explode(F.expr("slice(items, pos + 2, size(items))")).alias("item2"), "weight"
    )
    return pairs.groupBy("item1", "item2").agg(F.sum("weight").alias("count"))


def named_pair_counts(members: DataFrame, min_count: int, crowd: int = 256, block: int = 4096) -> DataFrame:
    """Pairs of names with at least ``min_count`` shared credits.

    ``members`` has one row per (movie_id, person_id) with ``name`` and the number of credits ``n``. A pair of
    persons (lower id first) scores n1 * n2 in each shared movie; scores are added up by the two names.

    Movies of up to ``crowd`` people are paired directly: at most ``crowd`` partners per row. In a larger movie
    pairing everybody would be quadratic, so there a pair is only looked at when it can still reach
    ``min_count``: because it already met in a small movie, or because both names keep the movie after
    each name's largest movies are set aside, as far as those alone could not add up to ``min_count``.
    A pair that reaches the count shares at least one movie that neither of them set aside. Such pairs are scored from the crowded movies of
    the rarer name, at most ``block`` of them in one place.
    """
    # max(n) keeps this aggregate on the same columns as the pairing, so both read one shuffle of the credits.
    sizes = members.groupBy("movie_id").agg(F.count("*").alias("people"), F.max("n").alias("most"))
    crowded = sizes.where(F.col("people") > crowd)
    small = members.join(crowded.select("movie_id"), "movie_id", "left_anti")
    big = members.join(crowded.select("movie_id", "people"), "movie_id")

    met = _scored(_one(small).join(_other(small), "movie_id").where(F.col("id1") < F.col("id2")))
    hopeful = _reachable_pairs(big, min_count).select("low", "high", F.lit(0).alias("forth"), F.lit(0).alias("back"))
    candidates = (
        met.unionByName(hopeful).groupBy("low", "high").agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"))
    )
    totals = (
        candidates.unionByName(_shared_scores(candidates, big, block))
        .groupBy("low", "high")
        .agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"))
    )
    directions = F.explode(
        F.array(
            F.struct(F.col("low").alias("name1"), F.col("high").alias("name2"), F.col("forth").alias("count")),
            F.struct(F.col("high").alias("name1"), F.col("low").alias("name2"), F.col("back").alias("count")),
        )
    )
    return (
        totals.select(directions.alias("d"))
        .select("d.name1", "d.name2", "d.count")
        .where((F.col("count") > 0) & (F.col("count") >= min_count))
    )


def _one(members: DataFrame) -> DataFrame:
    return members.select(
        "movie_id", F.col("person_id").alias("id1"), F.col("name").alias("name1"), F.col("n").alias("n1")
    )


def _other(members: DataFrame) -> DataFrame:
    return members.select(
        "movie_id", F.col("person_id").alias("id2"), F.col("name").alias("name2"), F.col("n").alias("n2")
    )


def _scored(pairs: DataFrame) -> DataFrame:
    """Scores per unordered pair of names: ``forth`` where the first name is the lower one, ``back`` otherwise."""
    forth = F.col("name1") <= F.col("name2")
    score = F.col("n1") * F.col("n2")
    return pairs.groupBy(F.least("name1", "name2").alias("low"), F.greatest("name1", "name2").alias("high")).agg(
        F.coalesce(F.sum(F.when(forth, score)), F.lit(0)).alias("forth"),
        F.coalesce(F.sum(F.when(~forth, score)), F.lit(0)).alias("back"),
    )


def _shared_scores(candidates: DataFrame, big: DataFrame, block: int) -> DataFrame:
    """Scores of the candidate pairs in crowded movies.

    The name with fewer credits there leads: its movies are looked up at the other name, so a pair costs the smaller of its two numbers of
    movies. The credits of a leading name are dealt out in blocks of about ``block`` by movie, and its pairs are sent to each of its blocks; light
    names have one block, so only heavy ones are copied.
    """
    credits = big.groupBy("name").agg(F.count("*").alias("credits"))
    known = candidates.select("low", "high").join(credits.select(F.col("name").alias("low"), F.col("credits").alias("c1")), "low")
    known = known.join(credits.select(F.col("name").alias("high"), F.col("credits").alias("c2")), "high")
    leads = F.col("c1") <= F.col("c2")
    blocks = lambda c: F.ceil(c / block).cast("int")
    pairs = known.select(
        "low",
        "high",
        F.when(leads, F.col("low")).otherwise(F.col("high")).alias("leader"),
        F.when(leads, F.col("high")).otherwise(F.col("low")).alias("partner"),
        F.explode(F.sequence(F.lit(0), blocks(F.least("c1", "c2")) - 1)).alias("block"),
    )
    rows = big.join(credits, "name")
    led = rows.select(
        F.col("name").alias("leader"),
        F.pmod(F.xxhash64("movie_id"), blocks(F.col("credits"))).cast("int").alias("block"),
        "movie_id",
        F.col("person_id").alias("id1"),
        F.col("n").alias("n1"),
    )
    others = big.select("movie_id", F.col("name").alias("partner"), F.col("person_id").alias("id2"), F.col("n").alias("n2"))
    found = pairs.join(led, ["leader", "block"]).join(others, ["movie_id", "partner"])
    low_id = F.when(F.col("leader") == F.col("low"), F.col("id1")).otherwise(F.col("id2"))
    high_id = F.when(F.col("leader") == F.col("low"), F.col("id2")).otherwise(F.col("id1"))
    score = F.col("n1") * F.col("n2")
    return found.groupBy("low", "high").agg(
        F.coalesce(F.sum(F.when(low_id < high_id, score)), F.lit(0)).alias("forth"),
        F.coalesce(F.sum(F.when((low_id > high_id) & (F.col("low") < F.col("high")), score)), F.lit(0)).alias("back"),
    )


def _reachable_pairs(big: DataFrame, min_count: int) -> DataFrame:
    """Name pairs of crowded movies that could reach ``min_count`` in crowded movies alone."""
    credits = big.groupBy("movie_id", "name").agg(F.sum("n").alias("n"), F.max("people").alias("people"))
    most = credits.groupBy("movie_id").agg(F.max("n").alias("most"))
    bounded = credits.join(most, "movie_id").select(
        "movie_id", "name", "people", (F.col("n") * F.col("most")).alias("bound")
    )
    # Each bound is at least 1, so a name can set aside fewer than min_count movies: a top-n, not a whole group.
    largest_first = [F.desc("people"), F.asc("movie_id")]
    largest = top_n_per_group(bounded, ["name"], largest_first, max(min_count - 1, 1), "pos")
    running = Window.partitionBy("name").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    set_aside = (
        largest.withColumn("reach", F.sum("bound").over(running))
        .where(F.col("reach") < min_count)
        .select("movie_id", "name")
    )
    kept = bounded.select("movie_id", "name").join(set_aside, ["movie_id", "name"], "left_anti")
    low = kept.select("movie_id", F.col("name").alias("low"))
    high = kept.select("movie_id", F.col("name").alias("high"))
    return low.join(high, "movie_id").where(F.col("low") <= F.col("high")).select("low", "high").distinct()
