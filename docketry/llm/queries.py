"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import decontaminate, gnat, kdtree, kneser, lines, mixing, oracle, pages, passages, ranked, rules, secrets, simhash, toxicity
from docketry.llm.common import table


def _listed(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secrets(table(spark, folder, "documents"))
    digest = F.sha2(_listed("base_spans"), 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, _listed("spans").alias("spans"), "n_crf")


def op2_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return kneser.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.substring_dedup(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.line_dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_cut", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "flagged")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return kdtree.exact_topk(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return gnat.hard_negatives(table(spark, folder, "embeddings"), relabel=7)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
