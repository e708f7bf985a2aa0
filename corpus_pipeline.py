"""Corpus pipeline over `documents`: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import decontaminate, lines, mixing, rules, simhash
from docketry.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, cross-site boilerplate lines cut from their texts."""
    return lines.cut_boilerplate(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest doc_id within reach of links of 3 bits."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row per draw, with the pass, the output shard and the words taken."""
    return mixing.mixed_corpus(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing to target weights", mixing_to_targets),
]

#: The learned rules, XXH64 fingerprints and hash-driven draws have no SQL form; tests hold run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
