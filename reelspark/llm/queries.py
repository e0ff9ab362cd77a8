"""Registered queries of this subpackage, each over its whole tables, and DuckDB statements for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import bit_sliced, conversation_repair, decontamination, html_text, near_duplicates, norm_buckets, packing, quality_classifier, quality_rules, revisits, stupid_backoff, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.drop("longest_match", "longest_item", "longest_at")


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stupid_backoff.score_documents(table(spark, sf_dir, "documents"), order=2)
    return scored.select("doc_id", "n_words", "n_known", F.round("score", 4).alias("score"))


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op5_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.apply_rules(table(spark, sf_dir, "pages"), rules)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op7_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(revisits.captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op10_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_path_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_report(table(spark, sf_dir, "conversations"))


def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.nearest(table(spark, sf_dir, "embeddings"))


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quadratic_discriminant": op1_quadratic_discriminant,
    "op2_hamming_join": op2_hamming_join,
    "op3_suffix_arrays": op3_suffix_arrays,
    "op4_stupid_backoff": op4_stupid_backoff,
    "op5_bloom_cascade": op5_bloom_cascade,
    "op6_quality_rules": op6_quality_rules,
    "op7_compression_distance": op7_compression_distance,
    "op8_vector_packing": op8_vector_packing,
    "op9_revisits": op9_revisits,
    "op10_line_blocks": op10_line_blocks,
    "op11_path_ranking": op11_path_ranking,
    "op12_bit_sliced": op12_bit_sliced,
    "op13_norm_buckets": op13_norm_buckets,
}


def _repair_sql() -> str:
    """A forward search: the least (cost, audit, lines) for each conversation, row and state."""
    far = 1 << 40
    arc = lambda b, cost, letter, line: f"{{'c': {b}.c + {cost}, 'a': {b}.a || '{letter}', 't': {f'list_append({b}.t, {line})' if line else f'{b}.t'}}}"
    insert = lambda b, role: arc(b, 2, "I", f"'{role}:'")
    delete = lambda b: arc(b, 3, "D", "")
    keep = lambda b, initial: arc(b, f"CASE WHEN usable AND role LIKE '{initial}%' THEN more ELSE {far} END", "K", "role || ':' || text")
    rerole = lambda b, role: arc(b, f"CASE WHEN usable THEN 2 + more ELSE {far} END", "R", f"'{role}:' || text")
    to_user = ", ".join(x for b in ("b0", "b1", "b3") for x in (keep(b, "u"), rerole(b, "user")))
    return f"""
        WITH RECURSIVE marked AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
                flatten(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                    lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, 4294967295::BIGINT)) % 20 AS m
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
                CASE m WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN m = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM marked WHERE m <> 0
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM damaged
        ), judged AS (
            SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
            FROM numbered
        ), ready AS (
            SELECT *, fault NOT IN ('blank', 'duplicate') AS usable, (fault = 'truncated')::BIGINT AS more FROM judged
        ), steps AS (
            SELECT conv_id, 0::BIGINT AS i, b0, {{'c': {far}::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS b1, b2, {insert("b2", "assistant")} AS b3
            FROM (SELECT conv_id, b0, {insert("b0", "user")} AS b2
                FROM (SELECT DISTINCT conv_id, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS b0 FROM conversations))
            UNION ALL
            SELECT conv_id, i, b0, b1, b2, list_min([b3, {insert("b2", "assistant")}]) AS b3
            FROM (SELECT conv_id, i, b0, b1, list_min([b2, {insert("b0", "user")}, {insert("b1", "user")}, {insert("b3", "user")}]) AS b2, b3
                FROM (SELECT s.conv_id, r.i, {delete("b0")} AS b0, list_min([{delete("b1")}, {keep("b0", "s")}]) AS b1,
                        list_min([{delete("b2")}, {to_user}]) AS b2, list_min([{delete("b3")}, {keep("b2", "a")}, {rerole("b2", "assistant")}]) AS b3
                    FROM steps s JOIN ready r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1))
        ), best AS (
            SELECT conv_id, arg_max(list_min([b0, b3]), i) AS b FROM steps GROUP BY conv_id
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM ready GROUP BY conv_id
        )
        SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, b.b.c AS cost, b.b.a AS audit, sha256(array_to_string(b.b.t, chr(10))) AS repaired_sha256
        FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id
    """


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE: dict[str, str] = {
    "op2_hamming_join": rf"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i:i + 2] END AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM texts WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
        ), reach(a, b) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), components AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
        FROM components LEFT JOIN sizes USING (doc_id)
    """,
    "op3_suffix_arrays": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), item_windows AS (
            SELECT DISTINCT item_id, n, w[i:i + n - 1] AS win
            FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM b) WHERE n > 0)
        ), doc_windows AS (
            SELECT doc_id, i, n, w[i:i + n - 1] AS win
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                FROM d JOIN (SELECT DISTINCT n FROM item_windows) ON len(w) >= n)
        ), hits AS (
            SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)
        ), places AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits)
            GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op4_stupid_backoff": r"""
        WITH texts AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), places AS (
            SELECT doc_id, words[i] AS w, CASE WHEN i > 1 THEN words[i - 1] END AS v
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM texts)
        ), unigrams AS (
            SELECT w, count(*) AS c FROM places GROUP BY w
        ), bigrams AS (
            SELECT v, w, count(*) AS c2 FROM places WHERE v IS NOT NULL GROUP BY v, w
        ), sums AS (
            SELECT doc_id, count(c2) AS n_known,
                sum(ln(CASE WHEN p.v IS NULL THEN u.c / (SELECT sum(c) FROM unigrams)
                    WHEN c2 IS NOT NULL THEN c2 / x.c ELSE 0.4 * u.c / (SELECT sum(c) FROM unigrams) END)) AS log_prob
            FROM places p JOIN unigrams u ON p.w = u.w LEFT JOIN unigrams x ON p.v = x.w
            LEFT JOIN bigrams b ON p.v = b.v AND p.w = b.w
            GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_known, 0) AS n_known, round(log_prob / len(words), 4) AS score
        FROM texts LEFT JOIN sums USING (doc_id)
    """,
    "op5_bloom_cascade": r"""
        WITH urls AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), rules(action, h, p) AS (
            VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                ('block', 'net', '/es/'), ('block', 'net', '/fr/')
        ), best AS (
            SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS verdict
            FROM (SELECT DISTINCT host, path FROM urls)
            JOIN rules ON (host = h OR suffix(host, '.' || h)) AND prefix(path, p)
            GROUP BY host, path
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM urls LEFT JOIN best USING (host, path)
    """,
    "op9_revisits": r"""
        WITH urls AS (
            SELECT page_id, md5(coalesce(html, '')) AS digest, length(coalesce(html, ''))::VARCHAR AS size, page_id * 7919 % 1000000 AS t,
                regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, digest, size, t, '"' || digest[1:12] || '"' AS tag,
                regexp_replace(lower(regexp_extract(rest, '(?s)^([^/?]*)', 1)), ':(80|443)$', '') AS host,
                regexp_replace(regexp_extract(rest, '(?s)^[^/?]*([^?]*)', 1), '/+$', '') AS path,
                array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&'),
                    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|msclkid|sessionid)(=.*)?$'))), '&') AS query
            FROM urls
        ), pages_at AS (
            SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url, 'day ' || (t // 1000) AS day FROM parts
        ), revisits AS (
            SELECT page_id * 3 + 1 AS record_id, url, t + 5000 AS time, tag AS etag, NULL AS last_modified, NULL AS digest,
                'cache-control: max-age=60' || chr(10) AS cache, tag AS new_tag
            FROM pages_at
            UNION ALL
            SELECT page_id * 3 + 2, url, t + 90000, CASE WHEN page_id % 4 = 1 THEN '"changed"' END, CASE WHEN page_id % 4 = 2 THEN day END,
                CASE WHEN page_id % 4 = 3 THEN digest END, '', NULL
            FROM pages_at
        ), found AS (
            SELECT r.record_id, arg_max(p, p.t * 1000000000000 + p.page_id) AS p
            FROM revisits r LEFT JOIN pages_at p ON p.url = r.url AND p.t < r.time GROUP BY r.record_id
        ), judged AS (
            SELECT r.*, p, CASE WHEN p IS NULL THEN 'no_earlier_response'
                WHEN etag IS NOT NULL THEN CASE WHEN etag = p.tag THEN 'resolved' ELSE 'validator_mismatch' END
                WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = p.day THEN 'resolved' ELSE 'validator_mismatch' END
                WHEN digest IS NOT NULL THEN CASE WHEN digest = p.digest THEN 'resolved' ELSE 'validator_mismatch' END
                ELSE 'unverified' END AS status
            FROM revisits r JOIN found USING (record_id)
        )
        SELECT record_id, url AS canonical_url, time, status,
            CASE WHEN status IN ('resolved', 'unverified') THEN p.page_id * 3 END AS source_id,
            CASE WHEN status IN ('resolved', 'unverified') THEN cache || 'content-length: ' || p.size || chr(10) || 'content-type: text/html' ||
                chr(10) || 'date: day ' || (time // 1000) || chr(10) || 'etag: ' || coalesce(new_tag, p.tag) END AS headers
        FROM judged
    """,
    "op11_path_ranking": _repair_sql(),
    "op12_bit_sliced": r"""
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 20
    """,
    "op13_norm_buckets": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
        ), sizes AS (
            SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_all FROM d WHERE len(w) > 0
        ), counts AS (
            SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL
        ), items AS (
            SELECT row_number() OVER () AS i, item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), asked AS (
            SELECT i, item_id, t, count(*) AS c FROM (SELECT i, item_id, unnest(w) AS t FROM items) GROUP BY ALL
        ), weights AS (
            SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM counts, sizes GROUP BY t, n_docs
        ), scores AS (
            SELECT i, item_id, r, doc_id,
                sum(c * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_all))))::BIGINT AS score
            FROM asked JOIN weights USING (t) JOIN counts USING (t), sizes GROUP BY ALL
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
        ) WHERE rank <= 10
    """,
}
