"""The text operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.llm import (
    common, cross_align, decontaminate, fingerprints, hard_negatives, html_text, language, line_dedup, near_dedup, packing, sharding, substring_dedup,
    suffix_dedup, token_counts,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.sample_edits())
    return counted.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_digest(sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=40))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = cross_align.align(table(spark, sf_dir, "documents"))
    return aligned.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_language_id, op3_substring_dedup, op4_decontamination, op5_token_counts,
        op6_fingerprints, op7_best_fit_packing, op8_line_dedup, op9_html_extraction, op10_suffix_array_dedup,
        op11_hard_negatives, op12_sharding, op13_cross_tokenizer_alignment,
    )
}

# Where SQL can express a query and is quick enough on whole tables.
ORACLE: dict[str, str] = {
    "op1_near_dedup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
          FROM documents),
        s AS (
          SELECT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_distinct([array_to_string(list_slice(ws, k, k + 3), ' ') FOR k IN range(1, len(ws) - 2)])
            WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
          FROM w),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (
          SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
        SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, a = min(b) AS kept
        FROM reach LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a""",
    "op3_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        windows AS (
          SELECT doc_id, k, array_to_string(list_slice(ws, k, k + 12), ' ') AS words
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w)),
        starts AS (SELECT words, min(doc_id) AS first FROM windows GROUP BY 1),
        gone AS (
          SELECT DISTINCT doc_id, k + j AS p
          FROM (SELECT doc_id, k, unnest(range(0, 13)) AS j FROM windows JOIN starts USING (words) WHERE doc_id > first)),
        each_word AS (SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
        left_over AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN left_over USING (doc_id)""",
    "op11_hard_negatives": r"""
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
          other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10""",
}
