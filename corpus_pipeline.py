"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing, over ``documents``.

Each stage takes what its predecessor kept, written as Parquet in the shared folder, and returns rows with
the columns of its input; the last one adds those of the mix. Stages handle empty tables, nulls,
repeated rows and further columns as the operators they call state it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.bagminhash import keep_one_of_each
from rivulet.llm.common import read, staged
from rivulet.llm.decontaminate import drop_contaminated
from rivulet.llm.line_dedup import dedup_lines
from rivulet.llm.mixing import mix_sources
from rivulet.llm.quality_rules import apply_rules

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and every rule proven safe for their language."""
    return apply_rules(docs, read(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated line runs; a document of which nothing but blanks is left goes; ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_deleted") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.where("n_deleted = 0 OR n_deleted < n_lines").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one_of_each(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that a document is read in the mix of sources."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# BagMinHash classes and their exact verification can't be said in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
