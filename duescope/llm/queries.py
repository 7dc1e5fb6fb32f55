"""Registered queries of the operators, each over its whole tables, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duescope.llm import (
    chat, decontaminate, language, licenses, negatives, neighbours, packing, quality_model, quality_rules, ranked, simhash,
    tokenbin, toxicity,
)
from duescope.llm.common import held_out, table
from duescope.storage import new_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "links")


@query
def op3_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predicted(docs, language.fitted(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op4_benchmark_decontamination"] = r"""
WITH doc AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), item AS (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
), win AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS size, unnest([list_slice(words, i, i + least(len(words), 10) - 1) for i in range(1, len(words) - least(len(words), 10) + 2)]) AS w
    FROM item WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM win
), spot AS (
    SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS pos, words FROM doc, sizes WHERE len(words) >= size
), hit AS (
    SELECT s.doc_id, s.pos, s.size, w.item_id FROM spot s JOIN win w ON w.size = s.size AND w.w = list_slice(s.words, s.pos, s.pos + s.size - 1)
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hit) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.word_tokens(table(spark, sf_dir, "documents")))


@query
def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    tokenbin.write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return tokenbin.digests(spark, path)


@query
def op8_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", F.round("d2", 6).alias("d2"))


@query
def op10_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op7_chat_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(stored(chat.formatted(rows)))


@query
def op11_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op11_block_nearest"] = """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10
"""


@query
def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return negatives.mined(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, lambda x: F.floor(x.cast("double") * 256))


ORACLES["op13_strassen_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op12_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_max_sketch_search"] = r"""
WITH doc AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), item AS (
    SELECT item_id, unnest(list_distinct(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> ''))) AS term
    FROM benchmark
), totals AS (
    SELECT count(*) AS docs, CAST(sum(len(words)) AS BIGINT) AS words FROM doc WHERE len(words) > 0
), tf AS (
    SELECT doc_id, n, term, count(*) AS tf
    FROM (SELECT doc_id, CAST(len(words) AS BIGINT) AS n, unnest(words) AS term FROM doc) GROUP BY ALL
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
    FROM item JOIN w USING (term) JOIN tf USING (term), totals GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
