"""Exact ranked lexical search in norm buckets, in the style of LEMP.

A document is a vector of integer impacts over the terms of the benchmark: weight of the term times saturated frequency. A query is the
vector of its term counts, and a score is their inner product.

1. One pass over the texts stores the length of every document and how often it has each benchmark term. Document counts of terms, the
   number of documents and of all terms are sums over it.
2. Each task orders its impact vectors by length (Euclidean norm), chunk by chunk, and cuts them into buckets of BUCKET vectors. A bucket is passed to a
   query only if query norm x largest norm (Cauchy-Schwarz) reaches the query's threshold: the K-th best score that the task has found so
   far. As norms fall and thresholds rise, a chunk ends at the first bucket that no query wants.
3. Inside a bucket the coordinates of a query are split: the focus, those with the largest weights, is summed from short posting lists; for the others
   stands the smaller one of two bounds, rest norm x residual norm of the document and the bucket's largest impacts of these terms.
4. Pairs whose bound reaches the threshold are scored anew, over all coordinates, in 64-bit integers.
5. Tasks give K rows a query; a window keeps the K best of all.

Bounds are widened by more than what doubles can round off, and equal scores pass, so no row is lost. Items are sent to the tasks in blocks of
block_bytes; a larger benchmark takes one pass over the documents for each block.

Defined cases: a NULL text has no terms; documents and items without terms give no rows; a repeated document row is a document of its own;
repeated item rows (same id and text) are one item, different texts under one item_id are ranked each for itself; doc_id NULL comes last among
equal scores; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.decontamination import _blocks as item_blocks
from reelspark.session import cut_lineage

K = 10
K1, B = 1000, 75  # saturation and length normalisation, in thousandths and per cent
UNIT = 1_000_000_000
BUCKET = 128
FOCUS = 80  # per cent of a query's terms, the heaviest ones, that are summed before the bound
CHUNK_TERMS = 1_000_000
BLOCK_BYTES = 1_000_000
SLACK = 1 + 1e-9
NO_ID = np.iinfo(np.int64).max
# Bytes that aren't in a term become spaces; A-Z become a-z.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTED = "doc_id bigint, n bigint, terms binary, counts binary"
FOUND = "item_no int, item string, doc_id bigint, score bigint"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """COUNTED rows of all documents with terms: their length, and numbers and counts of the terms in the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                counts = Counter(words)
                shared = [(known[w], counts[w]) for w in counts.keys() & known.keys()]
                table = np.array(sorted(shared), np.int64).reshape(-1, 2)
                for column, x in zip(out, (doc_id, len(words), table[:, 0].astype(np.int32).tobytes(), table[:, 1].tobytes())):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["doc_id", "n", "terms", "counts"])

    chosen = docs.select(F.col("`doc_id`").cast("bigint").alias("doc_id"), F.col("`text`").cast("string").alias("text"))
    return chosen.where("text is not null").mapInArrow(run, COUNTED)


def document_frequencies(counted: DataFrame, size: int) -> dict[int, int]:
    """Term number -> documents that hold it; at most `size` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df[term])], ["term", "df"])

    parts = counted.select("terms").mapInArrow(run, "term bigint, df bigint")
    return {r.term: r.df for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _csr(owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by owner, and where each owner's run starts."""
    order = np.argsort(owner, kind="stable")
    return order, np.r_[0, np.cumsum(np.bincount(owner, minlength=size))]


def _runs(starts: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of `of`, the places of its run: (index of the entry, place)."""
    size = starts[of + 1] - starts[of]
    entry = np.repeat(np.arange(len(of)), size)
    return entry, np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size) + starts[of][entry]


class Queries:
    """Items of one block as count vectors over the block's vocabulary."""

    def __init__(self, items: list[tuple[str | None, str]]):
        listed = [(name, c) for name, text in items if (c := Counter(terms_of(text)))]
        self.names = [name for name, _ in listed]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, c in listed for w in c}))}
        flat = [(q, self.vocabulary[w], n) for q, (_, c) in enumerate(listed) for w, n in c.items()]
        self.query, self.term, self.count = (np.array([x[k] for x in flat], np.int64) for k in range(3))

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms, size = n_docs, n_terms, len(self.names)
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.vocabulary))], np.int64)
        potential = self.count * self.weight[self.term]
        order = np.lexsort((self.term, -potential, self.query))
        self.query, self.term, self.count, potential = self.query[order], self.term[order], self.count[order], potential[order]
        self.starts = np.r_[0, np.cumsum(np.bincount(self.query, minlength=size))]
        place = np.arange(len(order)) - self.starts[self.query]
        focus = place < np.maximum(np.diff(self.starts)[self.query] * FOCUS // 100, 1)
        square = lambda chosen: np.bincount(self.query[chosen], self.count[chosen].astype(float) ** 2, size)
        self.norm, self.rest_norm = np.sqrt(square(np.ones(len(order), bool))), np.sqrt(square(~focus))
        self.rest = np.flatnonzero(~focus)
        of_term = np.flatnonzero(focus)
        by, self.focus_starts = _csr(self.term[of_term], len(self.vocabulary))
        self.focus = of_term[by]

    def impacts(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, lengths: list[int]) -> np.ndarray:
        m = np.array([100 - B + B * n * self.n_docs // self.n_terms for n in lengths], np.int64)
        return self.weight[term] * (UNIT * tf // (K1 * tf + 8 * m[doc]))


class Best:
    """The k best documents of each query so far, and its threshold: the k-th score, 0 while there are fewer."""

    def __init__(self, queries: int, k: int):
        self.k, self.score, self.ids = k, np.zeros((queries, k), np.int64), np.full((queries, k), NO_ID)

    @property
    def threshold(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(query)
        q = np.r_[np.repeat(touched, self.k), query]
        i, s = np.r_[self.ids[touched].ravel(), ids], np.r_[self.score[touched].ravel(), score]
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.k
        self.ids[touched], self.score[touched] = i[kept].reshape(-1, self.k), s[kept].reshape(-1, self.k)


def search_chunk(queries: Queries, best: Best, ids: np.ndarray, lengths: list[int], doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> int:
    """Adds what a chunk of documents has to `best`; entries (doc, term, tf) are ordered by doc and term. Returns the pairs scored."""
    impact = queries.impacts(doc, term, tf, lengths)
    square = np.bincount(doc, impact.astype(float) ** 2, len(ids))
    starts = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(ids)))]
    norm = np.sqrt(square)
    by_norm = np.argsort(-norm, kind="stable")
    width, size, scored = len(queries.names), len(queries.vocabulary), 0
    for at in range(0, len(ids), BUCKET):
        docs = by_norm[at : at + BUCKET]
        longest = norm[docs[0]]
        if longest == 0:
            break
        active = queries.norm * longest * SLACK >= best.threshold
        if not active.any():
            break
        local, entry = _runs(starts, docs)
        t, y = term[entry], impact[entry]
        which, posting = _runs(queries.focus_starts, t)
        of = queries.focus[posting]
        used = active[queries.query[of]]
        which, of = which[used], of[used]
        cell = local[which] * width + queries.query[of]
        partial = np.bincount(cell, (queries.count[of] * y[which]).astype(float), len(docs) * width).reshape(-1, width)
        seen = np.bincount(cell, y[which].astype(float) ** 2, len(docs) * width).reshape(-1, width)
        rest = np.sqrt(np.maximum(square[docs][:, None] - seen, 0) + 1e-9 * square[docs][:, None])
        highest = np.zeros(size, np.int64)
        np.maximum.at(highest, t, y)
        most = np.bincount(queries.query[queries.rest], (queries.count * highest[queries.term])[queries.rest].astype(float), width)
        bound = (partial + np.minimum(queries.rest_norm * rest, most)) * SLACK
        d, q = np.nonzero((bound >= best.threshold) & (bound > 0) & active)
        if not len(d):
            continue
        scored += len(d)
        # Whole scores of what is left: look every coordinate of the query up in the document.
        pair, coordinate = _runs(queries.starts, q)
        key, wanted = local * size + t, d[pair] * size + queries.term[coordinate]
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        value = np.where(key[place] == wanted, y[place], 0) * queries.count[coordinate]
        score = np.add.reduceat(value, np.searchsorted(pair, np.arange(len(d))))
        good = (score > 0) & (score >= best.threshold[q])
        if good.any():
            best.add(q[good], ids[docs[d[good]]], score[good])
    return scored


def _search(sent, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        best = Best(len(queries.names), k)
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            lengths, terms, counts = (batch.column(c).to_pylist() for c in (1, 2, 3))
            sizes = np.array([len(t) // 4 for t in terms], np.int64)
            chunk = (np.cumsum(sizes) - sizes) // CHUNK_TERMS
            for c in np.unique(chunk).tolist():
                lo, hi = np.searchsorted(chunk, [c, c + 1])
                doc = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                term = np.frombuffer(b"".join(terms[lo:hi]), np.int32).astype(np.int64)
                tf = np.frombuffer(b"".join(counts[lo:hi]), np.int64)
                search_chunk(queries, best, ids[lo:hi], lengths[lo:hi], doc, term, tf)
        q, place = np.nonzero(best.score > 0)
        found, names = best.ids[q, place], [queries.names[x] for x in q.tolist()]
        columns = [pa.array(q.astype(np.int32)), pa.array(names, pa.string()), pa.array(found, mask=found == NO_ID), pa.array(best.score[q, place])]
        yield pa.RecordBatch.from_arrays(columns, ["item_no", "item", "doc_id", "score"])

    return scan


def rank_documents(docs: DataFrame, benchmark: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest scores above 0 of each item, equal scores by doc_id."""
    results = []
    for items in item_blocks(benchmark, block_bytes):
        queries = Queries(items)
        counted = cut_lineage(term_counts(docs, queries.vocabulary))
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        queries.weigh(n_docs, n_terms or 1, document_frequencies(counted, len(queries.vocabulary)))
        scan = _search(docs.sparkSession.sparkContext.broadcast(queries), k)
        order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = counted.where(F.octet_length("terms") > 0).mapInArrow(scan, FOUND).withColumn("rank", F.row_number().over(order))
        results.append(best.where(F.col("rank") <= k).select(F.col("item").alias("item_id"), "rank", "doc_id", "score"))
    ranked = results[0]
    for more in results[1:]:
        ranked = ranked.union(more)
    return ranked.withColumn("item_id", F.col("item_id").cast(benchmark.schema["item_id"].dataType))
