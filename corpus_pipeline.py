"""A training corpus from raw documents: rules, line dedup, near dedup, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleswright import workspace
from saleswright.llm import lines, neardup, packing, quality, secrets, tokens


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go out of the text; documents that the rules reject go altogether."""
    return quality.clean_lines(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go out of the text. All documents stay, even one that is left without lines."""
    return lines.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the least id stays."""
    return neardup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text. All documents stay."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 tokens: one row per piece."""
    return packing.pack(docs, tokens.vocabulary_path(tokens.VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]
#: The first and last stages count repeated windows and tokenize, which SQL can't follow at this size.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
