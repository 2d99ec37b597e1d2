"""One query per operator over its whole table, and the SQL it must match where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.llm import (
    centroids, conversations, decontaminate, discriminant, html_text, langid, masked_lm, near_dup, oracles, packing,
    paragraphs, secrets, warc, winnow,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, folder, "documents")).drop("value")


def op2_masked_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return masked_lm.pseudo_likelihood(_table(spark, folder, "documents"))


def op3_tree_scored_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.page_texts(_table(spark, folder, "pages"))


def op4_chosen_path_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.near_duplicates(_table(spark, folder, "documents"), shingle=3, percent=85)
    return found.drop("text_hash")


def op5_warc_capture_index(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, folder, "pages"), least_bytes=0)


def op6_winnowing_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.edited_fingerprints(_table(spark, folder, "documents"))


def op7_wu_manber_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_paragraph_banding(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_passages(_table(spark, folder, "documents"))


def op9_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1
    )


def op10_naive_bayes_langid(spark: SparkSession, folder: str) -> DataFrame:
    found = langid.identify(_table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", F.col("score").cast("double").alias("score"))


def op11_quadratic_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return discriminant.score_quality(documents, _table(spark, folder, "labels"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.damage_and_repair(_table(spark, folder, "conversations"))


def op13_hadamard_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_report(_table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_masked_pseudo_likelihood, op3_tree_scored_text, op4_chosen_path_near_dup,
        op5_warc_capture_index, op6_winnowing_fingerprints, op7_wu_manber_decontamination, op8_paragraph_banding,
        op9_sum_of_squares_packing, op10_naive_bayes_langid, op11_quadratic_discriminant, op12_conversation_repair,
        op13_hadamard_clustering,
    )
}

_WORDS4 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_WORDS7 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::INTEGER >> {k}) & 31) + 1, 1)"
    for g in range(8) for k in (15, 10, 5, 0)
)

ORACLES = {
    "op12_conversation_repair": oracles.conversation_repair(),
    "op13_hadamard_clustering": oracles.centroid_clusters(),
    "op5_warc_capture_index": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT page_id, n, h, max(page_id) OVER (PARTITION BY n, h) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM m
""",
    "op4_chosen_path_near_dup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2]) END) AS s
    FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
""",
    "op7_wu_manber_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS7} AS w FROM documents),
i AS (SELECT item_id, {_WORDS7} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS m FROM i WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[k + 1 : k + least(len(w), 10)], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS k FROM i WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, m, k, array_to_string(w[k + 1 : k + m], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(0, len(w) - m + 1)) AS k FROM d, lengths WHERE len(w) >= m)),
found AS (SELECT doc_id, item_id, d.m, k FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.m = i.m),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(range(k, k + m)) AS p FROM (SELECT DISTINCT doc_id, m, k FROM found)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',')) AS items_sha256
  FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
