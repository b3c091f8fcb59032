"""The operators' queries over the whole test tables, by name, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.llm import (
    best_fit,
    jump_sharding,
    license_scan,
    line_dedup,
    line_rules,
    merkle_manifest,
    mixing,
    pivot_search,
    projected_search,
    quote_links,
    repair_store,
    signature_trees,
    whitening,
)
from adlytics.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quote_links.link_quotes(table(spark, sf_dir, "conversations"))
    return linked.withColumnRenamed("conversation", "conv_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, sized, entries = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken_words(mixed, sized, entries).select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = jump_sharding.shard_rows(table(spark, sf_dir, "documents"), "doc_id", "text", 16)
    return placed.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op4_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signature_trees.similar_documents(
        table(spark, sf_dir, "documents"), width=3, percent=90
    )
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "__doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("doc", "doc_id")


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = best_fit.token_pieces(table(spark, sf_dir, "documents"), path, 2, 1024)
    return best_fit.pack(pieces, 1024)


def op8_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.nearest(table(spark, sf_dir, "embeddings"), 100, 10)


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.clean_lines(table(spark, sf_dir, "documents"))
    return judged.select(
        "__doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lost_words",
    )


def op10_repair_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = repair_store.fresh_path(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    repair_store.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary, 1)
    return repair_store.read_documents(spark, path)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What is checked: a seventh of the documents with one character more than they have.
    return merkle_manifest.manifest(
        table(spark, sf_dir, "documents"),
        "doc_id",
        "lang",
        ["doc_id", "source", "lang", "n_chars", "text"],
        {"n_chars": F.col("n_chars") + 1},
        F.crc32(F.col("doc_id").cast("string")) % 7 == 0,
    )


def op12_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_products(table(spark, sf_dir, "embeddings"), 50, 5)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quote_links": op1_quote_links,
    "op2_mixing": op2_mixing,
    "op3_jump_sharding": op3_jump_sharding,
    "op4_signature_trees": op4_signature_trees,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_best_fit": op7_best_fit,
    "op8_projected_search": op8_projected_search,
    "op9_line_rules": op9_line_rules,
    "op10_repair_store": op10_repair_store,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_pivot_search": op12_pivot_search,
    "op13_whitening": op13_whitening,
}
