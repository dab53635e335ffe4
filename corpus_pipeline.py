"""The corpus pipeline: each stage reads what the one before it kept, as Parquet.

Every stage takes the documents that are left, works on all of them, and returns the columns
of ``documents`` (extra columns, whatever their names, are carried along); the last returns
the packed pieces. Rows without an id, repeated rows, null and empty texts pass through every
stage as its operator's docstring says, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assetlens.llm import decontamination, exact_dedup, packing, quality, queries, simhash_dedup
from assetlens.llm.common import keep_marked, read_table, rows_against
from assetlens.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_accepted(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return keep_marked(docs, materialize(exact_dedup.dedup_once(docs), "exact-report"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return keep_marked(docs, materialize(simhash_dedup.near_duplicates(docs), "simhash-report"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    found = decontamination.contaminations(docs, read_table(spark, sf_dir, "benchmark"))
    flagged = materialize(found.select("doc_id", "text_key").distinct(), "contaminated")
    return rows_against(docs, docs, flagged, "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences."""
    return packing.with_digest(packing.pack_documents(docs, queries.BYTE_BPE))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # a learned model, 64-bit hashing and token ids are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what each returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
