"""Cases in which an operator once did less than its whole job."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext

from reelspark.llm import html_text, near_duplicates, stupid_backoff


def test_window_sums_decide_inside_and_outside_of_an_article():
    body = "A long paragraph of the page's own text. " * 8
    teaser = '<article class="teaser"><h3><a href="/n">Read the next one</a></h3></article>'
    page = f"<body><div><p>{body}</p><p>{body}</p></div>{teaser}<div>Short line</div></body>"
    assert html_text.main_text(page) == f"{body.strip()} {body.strip()}"
    links = "".join(f'<li><a href="/{i}">Linked headline {i}</a></li>' for i in range(6))
    page = f"<article><h1>T</h1><p>{body}</p><ul>{links}</ul></article><p>Imprint</p>"
    assert html_text.main_text(page) == f"T {body.strip()}"


@pytest.mark.parametrize("order,min_count", [(3, 1), (2, 1), (3, 2), (2, 2), (4, 1)])
def test_backoff_of_every_order(spark, monkeypatch, order, min_count):
    monkeypatch.setattr(stupid_backoff, "CHUNK_WORDS", 50)
    rng = random.Random(21)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30))) for _ in range(60)] + [None, "", "A a", "x y z"]
    words = [(t or "").lower().split() for t in texts]
    counts = Counter(tuple(w[i : i + m]) for w in words for m in range(1, order + 1) for i in range(len(w) - m + 1))
    total = sum(map(len, words))

    def score(gram):
        if len(gram) == 1:
            return counts[gram] / total
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= min_count else 0.4 * score(gram[1:])

    got = stupid_backoff.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), min_count=min_count, order=order)
    for r in got.collect():
        grams = [tuple(words[r.doc_id][max(0, i - order + 1) : i + 1]) for i in range(len(words[r.doc_id]))]
        assert (r.n_words, r.n_known) == (len(grams), sum(len(g) > 1 and counts[g] >= min_count for g in grams))
        assert abs(r.log_prob - sum(math.log(score(g)) for g in grams)) < 1e-9


def test_a_frequent_ngram_is_one_row_a_chunk():
    ask = stupid_backoff._ask(3)
    TaskContext._getOrCreate()._partitionId = 0
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["same " * 5000, "same " * 5000])], ["doc_id", "text"])
    assert sum(len(k) for b in ask(iter([batch])) for k in b.column(4).to_pylist()) == 4  # total, and one n-gram of each order


def test_copies_with_an_appended_passage_go_at_a_lower_similarity(spark):
    words = [f"v{i}" for i in range(121)]
    docs = spark.createDataFrame([(1, " ".join(words[:100])), (2, " ".join(words[:120])), (3, "else " * 9)], "doc_id bigint, text string")
    assert {r.doc_id for r in near_duplicates.keep_one(docs, 5, (80, 100)).collect()} == {1, 3}
    assert {r.doc_id for r in near_duplicates.near_duplicates(docs).where("kept").collect()} == {1, 2, 3}


def test_shapes_miss_few_pairs():
    assert near_duplicates.shape(3, (85, 100)) == near_duplicates.Shape(3, (85, 100), 5, 14)
    form = near_duplicates.shape(5, (80, 100))
    rng = np.random.default_rng(22)
    assert (rng.binomial(form.positions, 0.2, 1_000_000) > form.max_distance).sum() <= 5


def test_tasks_count_equal_shares_of_the_ngrams(monkeypatch):
    monkeypatch.setattr(TaskContext, "_taskContext", None)  # so that none is left after the test
    TaskContext._getOrCreate()._partitionId = 0
    text = " ".join(f"w{i}" for i in np.random.default_rng(3).integers(0, 40_000, 60_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    tasks, share, rows = 300, 14, []
    for b in stupid_backoff._ask(2, tasks * share)(iter([batch])):
        rows += [r for r in b.to_pylist() if r["payload"] is None]
    assert [r["first"] for r in rows] == np.cumsum([0] + [len(r["k"]) for r in rows])[:-1].tolist()
    words = np.unique(text.split()).size, len(set(zip(text.split(), text.split()[1:])))
    assert len({(r["bucket"], h, x) for r in rows for h, x in zip(r["high"], r["low"])}) == sum(words) + 1
    held = np.bincount([r["bucket"] // share for r in rows], [len(r["k"]) for r in rows], tasks)
    assert len(held) == tasks and held.max() < 1.4 * held.mean()


def test_a_counting_task_sorts_little():
    assert stupid_backoff.TASK_BYTES <= 8_000_000  # 24 000 000 took 400 MB a task and all of an executor's memory
