"""Every operator on NULLs, empty and very long texts, repeated rows, an empty table and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import (
    decontamination,
    html_text,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    revisits,
    stupid_backoff,
    toxicity,
    url_filter,
)

CLASHING = ("stats", "n_words", "score", "node", "component", "key", "found", "kept", "posterior", "words", "text_", "y", "row", "id", "toxicity", "dropped", "__rules_text")


def document_rows():
    long = " ".join(f"word{i % 997} and then some." for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "two words"), (6, long), (7, long), (7, long), (None, "no id here at all"),
        (None, None), (8, "Grüße 日本語 テキスト   x\0y <|endoftext|>"), (9, "a" * 60_000), (10, "same same " * 4000), (-3, "$$$ ### !!!"),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(document_rows(), "doc_id bigint, text string")
    return df.withColumns({c: F.lit(1) for c in CLASHING})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(None, 1, 1), (4, None, None), (5, 0, 1), (5, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "one"), (2, None), (3, ""), (4, "word5 and then some word6 and then some word7 and then some word8"), (4, "two words"), (None, "no id here")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def per_row(labels, bench):
    return {
        "op1": lambda d: quality_classifier.score_documents(d, labels),
        "op2": near_duplicates.near_duplicates,
        "op3": lambda d: decontamination.contamination_report(d, bench),
        "op4": stupid_backoff.score_documents,
        "op6": quality_rules.quality_rules,
        "op7": lambda d: toxicity.score_documents(d, labels),
    }


@pytest.mark.parametrize("op", ["op1", "op2", "op3", "op4", "op6", "op7"])
def test_one_row_for_each_row(docs, labels, bench, op):
    f = per_row(labels, bench)[op]
    rows = f(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in document_rows())
    twice = [tuple(r) for r in rows if r.doc_id == 7]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert f(docs.limit(0)).count() == 0


def test_defined_values(docs, labels, bench):
    by = lambda rows: {r.doc_id: r for r in rows if r.doc_id is not None}
    near = by(near_duplicates.near_duplicates(docs).collect())
    assert [near[i].n_shingles for i in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert near[7].component_id == 6 and not near[7].kept and near[6].kept and near[1].kept
    leak = by(decontamination.contamination_report(docs, bench).collect())
    assert (leak[1].n_words, leak[1].n_hit, leak[1].contaminated) == (0, 0, False)
    assert (leak[4].n_words, leak[4].n_hit, leak[4].n_items) == (1, 1, 1) and leak[5].n_items == 1
    lm = by(stupid_backoff.score_documents(docs).collect())
    assert lm[1].score is None and lm[2].log_prob == 0 and lm[10].n_words == 8000
    rules = by(quality_rules.quality_rules(docs).collect())
    assert rules[10].n_repeat_words == 8000 and rules[1].n_words == 0 and rules[-3].n_symbols == 6 and not rules[1].kept


def test_sizes_of_empty_sides(spark, docs, labels, bench):
    assert decontamination.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0
    for label in (labels.limit(0), labels.where("quality = 1 and toxic = 1")):
        assert {r.predicted for r in quality_classifier.score_documents(docs, label).collect()} <= {0, 1}
        assert toxicity.score_documents(docs, label).where("score is null").count() == 0


def test_a_repeated_id_is_one_training_row(spark):
    docs = spark.createDataFrame([(3, "a b c"), *[(3, f"other {i}") for i in range(500)], (4, "x y")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)], "doc_id bigint, quality int, toxic int")
    for module in (toxicity, quality_classifier):
        rows = module.score_documents(docs, labels)
        assert rows.count() == 502 and rows.where("score is null").count() == 0


def test_packing(docs):
    rows = packing.pack_documents(docs).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in document_rows()}
    assert sum(r.length == 1 for r in rows) >= 3  # the empty ones hold the end token alone
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (2, "x", ""), (None, "HTTP://A.com", "<p>text"), (3, "https://b.net/es/", "plain"), (4, "//c", "<div" * 5000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "text", "rule", "time", "kind")})
    out = html_text.extract_pages(pages).collect()
    assert len(out) == 6 and {r.n_chars for r in out if r.page_id in (1, 2)} == {0}
    assert [r.text for r in out if r.page_id is None] == ["text"]
    rules = spark.createDataFrame([("allow", "com", "/"), ("block", "net", "/es/"), (None, "a", "/")], "action string, host string, path string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.apply_rules(pages, rules).collect()}
    assert got == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "a.com", "", None, "allow"), (3, "b.net", "/es/", "net/es/", "block"), (4, "", "", None, "allow")}
    assert url_filter.apply_rules(pages, rules.limit(0)).where("verdict != 'allow'").count() == 0
    found = revisits.resolve_revisits(revisits.captures_of_pages(pages))
    assert found.count() == 12
    for df in (html_text.extract_pages(pages.limit(0)), url_filter.apply_rules(pages.limit(0), rules), revisits.resolve_revisits(revisits.captures_of_pages(pages.limit(0)))):
        assert df.count() == 0


def test_pipeline_stages_keep_columns(spark, docs, labels, bench, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    kept = corpus_pipeline.keep_distinct(spark, docs, str(tmp_path)).collect()
    assert sum(r.doc_id in (6, 7) for r in kept) == 1 and sum(r.doc_id is None for r in kept) == 2
