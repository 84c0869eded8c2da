"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm import (decontaminate, exact_dedup, hard_negatives, html_text, language_id, pii, quality_rules,
                          sentencepiece_tokens, simhash, suffix_dedup, toxicity, url_filter, whitening)
from leadlens.llm.tables import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id").withColumn("spans", F.to_json("spans"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), F.col("all").alias("spans"), "scores")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.fit(pages)
    return (url_filter.judged(pages, model, urls=model.urls)
            .withColumn("words", F.array_join("words", " ")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = sentencepiece_tokens.tokens(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n_tokens",
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), "roundtrip", "parity")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document (by a hash of its id) arrives as a batch at a
    snapshot of the others."""
    arrives = F.pmod(F.xxhash64("id"), F.lit(2)) == 1
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), arrives).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("sha").alias("text_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identified(docs, language_id.fit(docs)).withColumnRenamed("id", "doc_id")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).withColumnRenamed("id", "doc_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of six batches (by a hash of the id) are indexed one after the other, so
    levels merge and two of them stay; the last is scanned against them."""
    done = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"),
                                     F.pmod(F.xxhash64("id"), F.lit(6)), batches=6)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; where it is divisible
    by 7, the label is the next one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, model).withColumnRenamed("id", "doc_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_decontamination": op2_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_url_filter": op4_url_filter,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op6_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, text_sha256
FROM t WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scores AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.rid, b.vec_id,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id, n.rid) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
     AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""",
}
