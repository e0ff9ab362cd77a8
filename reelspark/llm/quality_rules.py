"""Quality rules as weak supervision: each rule votes good, bad or nothing, and expectation-maximisation weighs the votes.

Everything is DataFrame code. The statistics of a document are computed inside its row. EM needs only how often each
combination of votes occurs: at most 3 ** len(RULES) rows, whatever the number of documents, so they are brought to the driver.

Model: a document is good, or bad in the way that one of the rules looks for. For each class and rule EM estimates the chance
of a "bad" vote given that the rule votes; an abstention says nothing. A rule is assumed to accuse few good documents. The
posterior probability of "good" replaces an all-rules-must-pass filter.

Defined cases: a NULL text counts as empty; an empty text has no votes but the length rule's; an empty table gives an empty
result; repeated rows are judged each for itself; other columns of the input are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.rows import packed, unpacked
from reelspark.session import cut_lineage

BLANKS = " \t\n\x0b\x0c\r"
NOT_BLANK = r"[^\x20\x09-\x0D]"
WINDOW = 3
ENDS = tuple(".!?:;\"'’”»)…。！？")
STATS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_ended_lines",
    "n_distinct_words",
    "n_upper",
)
MAX_FALSE_ALARM = 0.02
RULES = ("symbols", "repeats", "dup_lines", "word_length", "line_ends", "upper_case", "variety", "length")
# Column names used while statistics are computed; they are gone from every result.
_T, _W, _H, _S, _P, _L = "__rules_text", "__rules_words", "__rules_hashes", "__rules_sorted", "__rules_places", "__rules_lines"


def with_stats(df: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """df with one struct column `out` of the fields STATS (all bigint)."""
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    trimmed = F.btrim(_T, F.lit(BLANKS))
    df = df.select(*kept, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(_T))
    df = df.select(
        *kept,
        _T,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias(_W),
        F.filter(F.split(_T, "\n"), lambda x: x.rlike(NOT_BLANK)).alias(_L),
    )
    # 64-bit hashes stand for the windows of a single text; two different windows of one text don't share one in practice.
    hashes = F.transform(_W, lambda w, i: F.xxhash64(w, *(F.get(_W, i + k) for k in range(1, WINDOW))))
    windows = F.slice(hashes, 1, F.greatest(F.size(_W) - (WINDOW - 1), F.lit(0)))  # the last ones are cut short by the end
    df = df.select(*kept, _T, _W, _L, windows.alias(_H))
    by_hash = F.sort_array(F.transform(_H, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(
        *kept,
        _T,
        _W,
        _L,
        F.when(F.size(F.array_distinct(_H)) < F.size(_H), by_hash)
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias(_S),
    )
    repeated = F.filter(
        _S,
        lambda x, k: (F.coalesce(F.get(_S, k - 1)["h"] == x["h"], F.lit(False)))
        | (F.coalesce(F.get(_S, k + 1)["h"] == x["h"], F.lit(False))),
    )
    df = df.select(*kept, _T, _W, _L, F.sort_array(F.transform(repeated, lambda x: x["i"])).alias(_P))
    # A repeated window covers WINDOW words, less what the next one covers again.
    covered = F.transform(_P, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(_P, k + 1) - p, F.lit(WINDOW))))
    values = {
        "n_words": F.size(_W),
        "word_chars": F.length(F.array_join(_W, "")),
        "n_symbols": F.length(F.regexp_replace(_T, "[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(_L) - F.size(F.array_distinct(_L)),
        "n_repeat_words": F.aggregate(covered, F.lit(0), lambda a, x: a + x),
        "n_lines": F.size(_L),
        "n_ended_lines": F.size(F.filter(_L, lambda x: F.substring(F.rtrim(x, F.lit(BLANKS)), -1, 1).isin(*ENDS))),
        "n_distinct_words": F.size(F.array_distinct(_W)),
        "n_upper": F.length(F.regexp_replace(_T, r"[^\p{Lu}]+", "")),
    }
    return df.select(*kept, F.struct(*(values[k].cast("bigint").alias(k) for k in STATS)).alias(out))


def _share(part: Column, whole: Column) -> Column:
    """part / whole, NULL (a rule then abstains) without a whole."""
    return F.when(whole > 0, part / whole)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def rule_votes(s: Column) -> dict[str, Column]:
    """One column of -1 (bad), 0 (abstains), 1 (good) for each rule."""
    words = s["n_words"]
    symbols, repeats = _share(s["n_symbols"], words), _share(s["n_repeat_words"], words)
    dup_lines, ended = _share(s["n_dup_lines"], s["n_lines"]), _share(s["n_ended_lines"], s["n_lines"])
    length, upper = _share(s["word_chars"], words), _share(s["n_upper"], s["word_chars"])
    distinct = _share(s["n_distinct_words"], words)
    return {
        "symbols": _vote(symbols > 0.3, symbols < 0.1),
        "repeats": _vote(repeats > 0.3, repeats < 0.15),
        "dup_lines": _vote(dup_lines > 0.3, (dup_lines < 0.1) & (s["n_lines"] >= 3)),
        "word_length": _vote((length < 2.0) | (length > 15), (length >= 3) & (length <= 10)),
        "line_ends": _vote((ended < 0.2) & (s["n_lines"] >= 3), ended >= 0.6),
        "upper_case": _vote(upper > 0.4, upper < 0.15),
        "variety": _vote((distinct < 0.25) & (words < 2000), distinct > 0.4),
        "length": _vote(words < 5, words >= 50),
    }


@dataclass(frozen=True)
class VoteModel:
    """classes: weight of the good class, then of one bad class for each rule. bad: classes x rules, the chance of a bad vote
    given that the rule votes."""

    classes: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Chance of a good document."""
        total = F.lit(1.0)
        for weight, row in zip(self.classes[1:], self.bad[1:]):
            odds = F.lit(float(np.log(weight / self.classes[0])))
            for name, b, g in zip(RULES, row, self.bad[0]):
                accused, cleared = float(np.log(b / g)), float(np.log((1 - b) / (1 - g)))
                odds += F.when(votes[name] < 0, accused).when(votes[name] > 0, cleared).otherwise(0.0)
            total += F.exp(odds)
        return 1 / total


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Fit on distinct vote combinations (rows of -1/0/1) and how many documents cast them.

    A document is good, or bad in the way that one of the rules looks for. The prior counts are shares of the corpus, so that
    the fit doesn't depend on its size. A rule's chance of accusing a good document is held below MAX_FALSE_ALARM, without
    which a frequent kind of bad document would pass for good.
    """
    m = votes.shape[1]
    accused, cast = votes < 0, votes != 0
    total = max(float(counts.sum()), 1.0)
    # First guess: accused documents belong to the classes of the rules that accuse them, in equal parts.
    clean = ~accused.any(axis=1)
    part = np.column_stack([clean, accused / np.maximum(accused.sum(axis=1, keepdims=True), 1)]).astype(float)
    own = np.vstack([np.full((1, m), 0.01), np.where(np.eye(m, dtype=bool), 0.95, 0.1)])
    for _ in range(rounds):
        w = part * counts[:, None]
        weight = (w.sum(axis=0) + 0.001 * total) / (total * (1 + 0.001 * (m + 1)))
        bad = (w.T @ accused + 0.001 * total * own) / (w.T @ cast + 0.001 * total)
        bad[0] = np.minimum(bad[0], MAX_FALSE_ALARM)
        bad = np.clip(bad, 1e-4, 1 - 1e-4)
        log = np.log(weight) + accused @ np.log(bad).T + (cast & ~accused) @ np.log(1 - bad).T
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - part).max(initial=0)
        part = new
        if moved < 1e-9:
            break
    return VoteModel(tuple(map(float, weight)), tuple(tuple(map(float, r)) for r in bad))


def fit(df: DataFrame, stats: str = "stats") -> VoteModel:
    """Rule accuracies over all rows of df."""
    patterns = df.select(*(c.alias(k) for k, c in rule_votes(F.col(stats)).items())).groupBy(*RULES).count()
    rows = sorted(tuple(r) for r in patterns.collect())  # at most 3 ** len(RULES)
    table = np.array(rows, dtype=np.int64).reshape(len(rows), len(RULES) + 1)
    return expectation_maximisation(table[:, :-1], table[:, -1].astype(float))


def judged(df: DataFrame, model: VoteModel, stats: str = "stats", threshold: float = 0.5) -> tuple[Column, Column, Column]:
    """Columns base_failed, posterior and kept for a frame that has `stats`."""
    s = F.col(stats)
    posterior = model.posterior(rule_votes(s))
    return base_failed(s), posterior, ~base_failed(s) & (posterior >= threshold)


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Statistics, posterior and verdict of every row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, posterior, kept. The statistics are stored once and read twice."""
    stats = cut_lineage(with_stats(docs.select("doc_id", "text")).select("doc_id", "stats"))
    failed, posterior, kept = judged(stats, fit(stats), threshold=threshold)
    return stats.select(
        "doc_id",
        *(f"stats.{k}" for k in STATS[:5]),
        failed.alias("base_failed"),
        posterior.alias("posterior"),
        kept.alias("kept"),
    )


def keep_good(docs: DataFrame, threshold: float = 0.5, with_base: bool = False) -> DataFrame:
    """The rows of docs whose posterior reaches the threshold, with their columns as they were.

    The posterior stands in for a filter that every rule must pass; with_base adds the two hard limits of base_failed, which also drop every
    text of less than 50 words. Statistics are stored with the rows: texts are judged once."""
    stats = cut_lineage(with_stats(packed(docs, "text")))
    failed, posterior, _ = judged(stats, fit(stats))
    good = (posterior >= threshold) & ~failed if with_base else posterior >= threshold
    return unpacked(stats.where(good), docs, "text")
