"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlens.llm import (alignment, embedding_dedup, hard_negatives, language_model, licences, merkle, packing,
                          quality, simhash, substring, suffixes, tiling, warc)

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f
    return add


_LICENCES = ", ".join(
    f"({i}, {str(base).lower()}, '{label}', {max(1, len(text.split()) - 2)}, {len(text.split())}, {text.split()})"
    for i, (base, label, text) in enumerate([(True, v, k) for k, v in licences.BASE.items()]
                                            + [(False, *x) for x in licences.NOTICES]))

#: The same votes in SQL: word k-grams as strings, joined to the templates' and counted by diagonal.
LICENCE_SQL = rf"""
WITH templates(template, is_base, label, grams, words, ws) AS (VALUES {_LICENCES}),
texts AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    '{licences.UPPER}', '{licences.LOWER}'), '{licences.NOT_WORD}'), lambda x: x <> '') AS ws FROM documents),
places AS (SELECT r, unnest(range(len(ws))) AS pos, ws FROM texts WHERE len(ws) > 1),
grams AS (SELECT r, pos, array_to_string(ws[pos + 1:pos + 3], ' ') AS gram FROM places
          UNION ALL SELECT r, pos, array_to_string(ws[pos + 1:pos + 2], ' ') FROM places
          WHERE ws[pos + 1] IN ('mit', 'apache') AND pos + 2 < len(ws)),
marks AS (SELECT * EXCLUDE (ws), array_to_string(ws[t + 1:t + 3], ' ') AS gram
          FROM (SELECT *, unnest(range(grams)) AS t FROM templates)),
diagonals AS (SELECT r, template, is_base, label, grams, words, pos - t AS diagonal, list(DISTINCT t) AS ts,
                     min(pos) AS a FROM grams JOIN marks USING (gram) GROUP BY ALL),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal)
                    <= CASE WHEN is_base THEN 0 ELSE {licences.MAX_SHIFT} END THEN 0 ELSE 1 END AS apart FROM diagonals),
chains AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal) AS chain FROM steps),
merged AS (SELECT f.r, f.template, f.is_base, f.label, f.grams, f.words, f.diagonal, f.a,
                  len(list_distinct(flatten(list(n.ts)))) AS covered
           FROM chains f JOIN chains n ON n.r = f.r AND n.template = f.template AND n.chain = f.chain
            AND n.diagonal >= f.diagonal AND n.diagonal < f.diagonal + f.words GROUP BY ALL),
found AS (SELECT *, covered / grams AS coverage FROM merged
          WHERE CASE WHEN is_base THEN covered = grams ELSE covered / grams >= {licences.MIN_COVERAGE} END)
SELECT doc_id, CAST(any_value(len(ws)) AS BIGINT) AS n_words, CAST(count(*) FILTER (is_base) AS BIGINT) AS n_base,
       CAST(min(a) FILTER (is_base) AS BIGINT) AS first_word, CAST(max(a) FILTER (is_base) AS BIGINT) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(coverage), 0) AS DOUBLE) AS score
FROM texts LEFT JOIN found USING (r) GROUP BY r, doc_id
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, coalesce(url, '') AS url FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
             lower(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', '')) AS plain FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id,
             regexp_replace(regexp_extract(plain, '^([^/?#]*)', 1), '^www[0-9]*[.]|:[0-9]+$|^[^@]*@', '', 'g') AS host,
             regexp_replace(regexp_replace(plain, '^[^/?#]*', ''), '#.*$', '') AS path FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to,
       CASE WHEN plain = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
            || CASE WHEN path = '' THEN '/' ELSE path END END AS url_key,
       strftime(TIMESTAMP '2020-01-01' + to_seconds(page_id % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at,
       row_number() OVER (PARTITION BY url_key ORDER BY captured_at, page_id NULLS FIRST) - 1 AS capture
FROM f
"""

SUBSTRING_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
windows AS (SELECT r, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
            FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS i FROM t WHERE len(ws) >= 50)),
repeated AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY h) AS first_id FROM windows)
             WHERE doc_id > first_id),
gone AS (SELECT DISTINCT r, i + unnest(range(50)) AS i FROM repeated),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
         FROM (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM t) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (r)
"""


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def align_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@_query("op1_license_scan", LICENCE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    return licences.scan(_table(spark, sf_dir, "documents"))


@_query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op3_warc", WARC_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives."""
    return warc.capture_histories(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "capture")


@_query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


@_query("op5_suffix_array_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that a document shares with an earlier one."""
    return suffixes.repeated_passages(_table(spark, sf_dir, "documents"))


@_query("op6_substring_dedup", SUBSTRING_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows that an earlier document has."""
    return substring.removal_digest(_table(spark, sf_dir, "documents"))


@_query("op7_document_fingerprints")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return merkle.edited_likeness(_table(spark, sf_dir, "documents"))


@_query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold test items, with the items."""
    return tiling.contaminated_pairs(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op10_lm_scoring")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by add-one unigrams and by the trie."""
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


@_query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document overlap."""
    return alignment.align(_table(spark, sf_dir, "documents"), *align_paths())


DEDUP_SQL = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT r, vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.r, b.r AS s, b.vec_id FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dedup.LEAST_COSINE}),
reach(r, s) AS (SELECT r, r FROM v UNION SELECT reach.r, links.s FROM reach JOIN links ON links.r = reach.s),
least AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
counts AS (SELECT r, count(*) AS n FROM links GROUP BY r)
SELECT v.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN counts USING (r)
"""


@_query("op13_embedding_dedup", DEDUP_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and representative of every vector."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


NEGATIVES_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                 CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
positives AS (SELECT r, anchor_id, id, score, row_number() OVER (PARTITION BY r ORDER BY score DESC, id) AS p
              FROM pairs WHERE same QUALIFY p <= {hard_negatives.POSITIVES}),
negatives AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.r, p.p ORDER BY n.score DESC, n.id) AS rank,
                     n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
              FROM positives p JOIN pairs n ON n.r = p.r AND NOT n.same
               AND {hard_negatives.LOW} * p.score <= 100 * n.score AND 100 * n.score <= {hard_negatives.HIGH} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {hard_negatives.NEGATIVES}
"""


@_query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positives of every anchor, and rows of other labels in each one's score window."""
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))
