"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, language_model, license_scan, near_dedup, packing, quality_rules, rans, set_join, sharding, url_filters, warc, whitening
from .common import table
from .oracles import SQL

#: Rules of op5: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    out = sharding.assign_shards(docs, ["doc_id"], 8, grown=9, order=["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op3_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality_rules.judge(docs, labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op4_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op5_url_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.captures_of(table(spark, sf_dir, "pages"))
    out = warc.resolve_revisits(records)
    headers = F.array_join(F.transform("merged_headers", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return out.select("record_id", "page_id", "kind", "canonical_url", "source_id", "status", headers.alias("headers"))


def op8_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op9_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rans.scratch_path(spark)
    rans.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return rans.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op11_heavy_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.similar_sets(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=label)


def op13_bidiagonal_qd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_jump_shards, op2_log_bilinear, op3_risk_rules, op4_leaks, op5_url_ranges, op6_sum_of_squares, op7_warc_revisits, op8_license_diagonals, op9_rans, op10_setsketch, op11_heavy_light, op12_cover_tree, op13_bidiagonal_qd)}

__all__ = ["QUERIES", "SQL"]
