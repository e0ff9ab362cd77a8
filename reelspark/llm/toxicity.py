"""Toxicity by compression distance: how much shorter a window of text gets with a dictionary of toxic text than with an ordinary one.

Training (on a bounded sample of labelled documents, see MOST) builds two zstandard dictionaries of equal length from toxic and from
ordinary texts. Both hold the commonest ordinary words. The toxic one also holds the spans that toxic texts share: word beginnings and
whole words of any characters whose number of toxic documents chance doesn't explain (a binomial tail over all candidates, Bonferroni's bound)
and that are MIN_RATIO times likelier there; the other one holds further ordinary words in their place.

Windows are raw words, digits and symbols included, with a space on either side; a word beyond WINDOW characters is read in overlapping
pieces. Each character is coded by two bytes of a running hash of its word, so that a match is a common beginning: neither dictionary can piece a
word together from the middles of others, and literals cost the same with both. A fixed prefix known to both makes lengths of short windows comparable.

A window's distance is its net length with the toxic dictionary over that with the ordinary one. A document is scored from its
smallest distance and from the number and share of its distinct windows below a threshold. Threshold and logistic curve are calibrated on a second
sample. Every window of every text is read; words are remembered, as most of them return.

Defined cases: a NULL or empty text has no windows and gets the score of a document without evidence; if
labels hold only one class, all documents get the smoothed share of toxic labels; an empty table gives no rows; rows without doc_id are
scored; a sampled doc_id with several texts is learnt from the least of them; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelspark.llm.labels import held_out, training_ids
from reelspark.llm.rows import packed, unpacked

MOST = (6000, 1500)  # ordinary and toxic documents that training reads at most; two thirds train, one third calibrates
LONGEST = 50_000  # characters; longer documents are not taken into the training sample
SHORTEST, LONGEST_SPAN = 3, 8  # characters of a word beginning
MIN_COUNT, MIN_RATIO = 3, 6.0
ORDINARY_WORDS = 500
CARRIER = b"#0123456789abcdefghijklmnopqrstuvwxyz#"
THRESHOLDS = (0.95, 0.9, 0.85, 0.8, 0.7, 0.6)
WINDOW = 40  # characters; longer words are cut into pieces that overlap by half
REMEMBERED = 200_000


def windows(text: str | None) -> Iterator[str]:
    for w in (text or "").lower().split():
        if len(w) <= WINDOW:
            yield w
        else:
            yield from (w[i : i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2))


def coded(text: str) -> bytes:
    """Two bytes for each character, from a hash of the word up to it."""
    out, h = bytearray(), 0
    for c in text:
        h = 7 if c == " " else (h * 40503 + ord(c) * 2654435761 + 12345) & 0xFFFFFFFF
        out += ((h ^ h >> 15) & 0xFFFF).to_bytes(2, "little")
    return bytes(out)


class Distances(dict):
    """Word -> distance, 1.0 where the toxic dictionary doesn't help."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as z

        # Short windows need an optimal parser; frame decoration is left out.
        settings = z.ZstdCompressionParameters.from_level(
            13, min_match=3, window_log=17, hash_log=14, chain_log=14, write_content_size=0, write_checksum=0, write_dict_id=0, format=z.FORMAT_ZSTD1_MAGICLESS
        )
        self.size = []
        for content in (toxic, ordinary):
            d = z.ZstdCompressionDict(content + CARRIER, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=settings)
            self.size.append(z.ZstdCompressor(dict_data=d, compression_params=settings).compress)
        self.empty = [len(f(CARRIER)) for f in self.size]

    def __missing__(self, word: str) -> float:
        data = CARRIER + coded(f" {word} ")
        toxic, ordinary = (max(len(f(data)) - e, 1) for f, e in zip(self.size, self.empty))
        d = min(toxic / ordinary, 1.0)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = d
        return d


def helped(text: str | None, distances: Distances) -> tuple[list[float], int]:
    """Distances below 1 of the distinct windows, and the number of these windows."""
    distinct = set(windows(text))
    return [d for d in map(distances.__getitem__, distinct) if d < 1.0], len(distinct)


def evidence(found: tuple[list[float], int], threshold: float) -> tuple[float, float, float]:
    near = [d for d in found[0] if d <= threshold]
    return (1 - min(near, default=1.0), float(np.log1p(len(near))), 100 * len(near) / (found[1] + 20))


@dataclass(frozen=True)
class ToxicModel:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # intercept and the three kinds of evidence
    threshold: float = 0.0

    def probability(self, found: np.ndarray) -> np.ndarray:
        x = self.weights[0] + found @ np.asarray(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _candidates(word: str) -> Iterator[str]:
    whole = f" {word} "
    yield from (whole[: k + 1] for k in range(SHORTEST, min(LONGEST_SPAN, len(word)) + 1))
    yield whole


def toxic_spans(toxic: list[str], ordinary: list[str]) -> dict[str, int]:
    """Spans that mark toxic documents, with their number of toxic documents."""
    counts = []
    for texts in (toxic, ordinary):
        c: Counter[str] = Counter()
        for t in texts:
            c.update({s for w in set(windows(t)) for s in _candidates(w)})
        counts.append(c)
    share = len(toxic) / (len(toxic) + len(ordinary))
    seen = np.sort(np.fromiter((counts[0] + counts[1]).values(), np.int64))
    out = {}
    for s, c in counts[0].items():
        o = counts[1].get(s, 0)
        if c < MIN_COUNT or (c + 0.5) / len(toxic) <= MIN_RATIO * (o + 0.5) / len(ordinary):
            continue
        # Chance that a candidate of this frequency is found in so many toxic documents, times the candidates that are as frequent.
        chance = math.lgamma(c + o + 1) - math.lgamma(c + 1) - math.lgamma(o + 1) + c * math.log(share)
        if chance + math.log(len(seen) - np.searchsorted(seen, c + o)) < math.log(0.1):
            out[s] = c
    return out


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    marks = toxic_spans(toxic, ordinary)
    longer = [s for s in marks if not any(t != s and t.startswith(s) and marks[t] >= 0.8 * marks[s] for t in marks)]
    chosen = sorted(longer, key=lambda s: (marks[s], s))  # commonest last, hence nearest
    words = Counter(w for t in ordinary for w in windows(t))
    by_count = sorted(words, key=lambda w: (-words[w], w))
    own = coded("".join(chosen))
    base = coded(" " + " ".join(by_count[:ORDINARY_WORDS][::-1]) + " ")
    other = coded(" ".join(by_count[ORDINARY_WORDS : ORDINARY_WORDS + len(own)]))[: len(own)]
    return base + own, base + other.ljust(len(own), b" ")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept is free."""
    x = np.column_stack([np.ones(len(x)), x])
    w, pull = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, ridge)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST) -> ToxicModel:
    """Learns from labels.toxic of documents that aren't held out."""
    ids = training_ids(labels, "toxic", most)
    sample = docs.select("doc_id", "text").where(F.length("text") <= LONGEST).join(F.broadcast(ids), "doc_id")
    rows = sample.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text")).collect()  # at most sum(most)
    rows = sorted((r["y"], r["doc_id"], r["text"]) for r in rows)
    train, rest = [[], []], [[], []]
    for k, (y, _, text) in enumerate(rows):
        (rest if k % 3 == 2 else train)[y].append(text)
    share = (sum(y for y, _, _ in rows) + 0.5) / (len(rows) + 1)
    flat = (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0)
    if not (train[0] and train[1] and rest[0] and rest[1]):
        return ToxicModel(b"", b"", flat)
    toxic, ordinary = train_dictionaries(train[1], train[0])
    distances = Distances(toxic, ordinary)
    found = [helped(t, distances) for texts in rest for t in texts]
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    fits = []
    for threshold in THRESHOLDS:
        x = np.array([evidence(f, threshold) for f in found])
        w = logistic(x, y)
        margin = np.clip((w[0] + x @ w[1:]) * (2 * y - 1), -30, 30)
        fits.append((float(np.log1p(np.exp(-margin)).sum()), threshold, tuple(map(float, w))))
    _, threshold, weights = min(fits)
    return ToxicModel(toxic, ordinary, weights, threshold)


def with_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with the probability `out`; all other columns pass through."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = Distances(sent.value.toxic, sent.value.ordinary)
        for batch in batches:
            found = np.array([evidence(helped(t, distances), sent.value.threshold) for t in batch.column(at).to_pylist()]).reshape(-1, 3)
            scores = pa.array(sent.value.probability(found), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = fit(docs, labels)
    scored = with_toxicity(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """docs without the rows found toxic; columns as they were."""
    scored = with_toxicity(packed(docs, "text"), fit(docs, labels))
    return unpacked(scored.where(F.col("toxicity") < threshold), docs, "text")
