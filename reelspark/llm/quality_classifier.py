"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text becomes a vector of transformed statistics (logarithms and log-odds of shares). Each class has its mean and its own
covariance, shrunk towards the pooled covariance and towards a multiple of the identity; the shrinkage is the one that predicts a second
sample best. The Cholesky factors and their inverses are computed once and sent to the tasks, so a score costs two small
matrix products: the difference of the log-densities (Mahalanobis distances and determinants). A logistic curve fitted on
the second sample turns it into a probability.

Defined cases: a NULL or empty text has the statistics of no words and gets a score like any other; if labels hold only one class,
all documents get the smoothed share of label 1; NULL and contradictory labels are left out; an empty table gives no rows; rows without
doc_id are scored; other columns are not read.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelspark.llm.labels import held_out, training_ids
from reelspark.llm.toxicity import logistic

MOST = (8000, 8000)  # documents of label 0 and 1 that training reads at most; only their statistics reach the driver
SHRINKAGE = (0.01, 0.05, 0.1, 0.2, 0.4, 0.7)
_EVERY = bytes(range(256))
_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SYMBOL, _STOP, _BANG = b"#*$%&|<>{}[]\\^~=+_@", b".,;:", b"!?"


def _without(chars: bytes) -> bytes:
    return bytes(set(_EVERY) - set(chars))


_OTHERS = [_without(c) for c in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _BANG)]
N_STATS = 16


def statistics(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), len(data)
    upper, lower, digits, symbols, stops, bangs = (len(data.translate(None, o)) for o in _OTHERS)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    trigrams = len(set(zip(words, islice(words, 1, None), islice(words, 2, None))))
    odds = lambda part, whole: float(np.log((part + 0.5) / (whole - part + 0.5))) if whole >= part else 0.0
    return [
        float(np.log1p(n)),
        float(np.log((size + 1) / (n + 1))),
        odds(upper, upper + lower),
        odds(digits, size),
        odds(symbols, max(size, symbols)),
        odds(stops, max(size, stops)),
        odds(bangs, max(size, bangs)),
        odds(upper + lower, size),
        odds(len(counts), n),
        float(np.log(len(counts) + 1) - 0.75 * np.log1p(n)),
        odds(max(counts.values(), default=0), n),
        odds(sum(map(operator.eq, words, islice(words, 1, None))), n),
        odds(max(n - 2, 0) - trigrams, max(n - 2, 0)),
        odds(len(lines) - len(set(lines)), len(lines)),
        odds(sum(x.rstrip()[-1:] in b".!?\"'" for x in lines), len(lines)),
        float(np.log((max(map(len, words), default=0) + 1) / (size / (n + 1) + 1))),
    ]


@dataclass(frozen=True)
class Discriminant:
    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]  # Cholesky factors of the class covariances
    inverses: tuple[np.ndarray, np.ndarray]
    curve: tuple[float, float]

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 minus that of class 0."""
        z = np.clip((x - self.center) / self.scale, -8, 8)
        log = [
            -0.5 * (((z - m) @ inv.T) ** 2).sum(axis=1) - np.log(np.diag(f)).sum()
            for m, f, inv in zip(self.means, self.factors, self.inverses)
        ]
        return log[1] - log[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.arcsinh(self.difference(x)), -30, 30)))


def _constant(share: float) -> Discriminant:
    zero, one = np.zeros(N_STATS), np.eye(N_STATS)
    return Discriminant(zero, zero + 1, (zero, zero), (one, one), (one, one), (float(np.log(share / (1 - share))), 0.0))


def discriminant(x: np.ndarray, y: np.ndarray, shrinkage: float) -> Discriminant:
    center, scale = np.median(x, axis=0), x.std(axis=0) + 1e-3
    z = np.clip((x - center) / scale, -8, 8)
    means = tuple(z[y == k].mean(axis=0) for k in (0, 1))
    own = [np.atleast_2d((z[y == k] - means[k]).T @ (z[y == k] - means[k])) / max((y == k).sum(), 1) for k in (0, 1)]
    pooled = sum(c * (y == k).mean() for k, c in enumerate(own))
    factors = []
    for c in own:
        mixed = (1 - shrinkage) * c + 0.5 * shrinkage * pooled
        mixed += (0.5 * shrinkage * np.trace(pooled) / len(c) + 1e-4) * np.eye(len(c))
        factors.append(np.linalg.cholesky(mixed))
    return Discriminant(center, scale, means, tuple(factors), tuple(np.linalg.inv(f) for f in factors), (0.0, 1.0))


def learn(x: np.ndarray, y: np.ndarray) -> Discriminant:
    """Means and covariances from two thirds of the rows; shrinkage and curve from the rest."""
    second = np.arange(len(y)) % 3 == 2
    share = (y.sum() + 0.5) / (len(y) + 1)
    if min((y[s] == k).sum() for s in (second, ~second) for k in (0, 1)) < 2:
        return _constant(float(share))
    best = None
    for s in SHRINKAGE:
        d = discriminant(x[~second], y[~second], s)
        v = np.arcsinh(d.difference(x[second]))[:, None]
        w = logistic(v, y[second].astype(float), ridge=0.5)
        p = 1 / (1 + np.exp(-np.clip(w[0] + v[:, 0] * w[1], -30, 30)))
        loss = -np.log(np.where(y[second] == 1, p, 1 - p) + 1e-12).mean()
        if best is None or loss < best[0]:
            best = (loss, Discriminant(d.center, d.scale, d.means, d.factors, d.inverses, (float(w[0]), float(w[1]))))
    return best[1]


def _with(docs: DataFrame, out: str, kind, make) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(at).to_pylist()], float).reshape(-1, N_STATS)
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*columns, f(x)], [*names, out])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(run, StructType([*fields, StructField(out, kind)]))


def fit(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST) -> Discriminant:
    from pyspark.sql.types import ArrayType

    ids = training_ids(labels, "quality", most)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = _with(rows, "x", ArrayType(DoubleType()), lambda: lambda x: pa.array(list(x), pa.list_(pa.float64())))
    rows = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect()  # one row for each sampled id
    rows = sorted((r["doc_id"], r["y"], tuple(r["x"])) for r in rows)
    x = np.array([r[2] for r in rows], float).reshape(-1, N_STATS)
    return learn(x, np.array([r[1] for r in rows], int))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    scored = _with(docs.select("doc_id", "text"), "score", DoubleType(), lambda: lambda x: pa.array(sent.value.probability(x), pa.float64()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
