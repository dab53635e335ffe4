"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE_RUN = r"[\x20\x09-\x0D]+"
"""A run of the six ASCII white-space characters, as every contract here names them."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark (the folder may be on any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) only: extra columns, whatever their names,
    neither reach the operator nor clash with its own columns."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 3, is 1 (a null id counts as the text '')."""
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % 3 == 1


def text_slices(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cuts record batches with a ``text`` column into runs of rows with at most
    ``max_bytes`` of text (one longer row stays alone), so a task's working memory
    follows this bound and not the batch's row count."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


def text_key(text: Column) -> Column:
    """A 64-bit hash of the text (null: empty) that, with the id, names a row."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def rows_against(docs: DataFrame, frame: DataFrame, ids: DataFrame, kind: str) -> DataFrame:
    """Semi or anti join of ``frame`` (rows of ``docs``) with the rows that the written table
    ``ids`` names by doc_id (null-safe) and text_key. Columns of ``docs`` can have any names."""
    ids = ids.select(F.col("doc_id").alias("right_id"), F.col("text_key").alias("right_key"))
    return frame.join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["right_id"])
                      & (text_key(docs["text"]) == ids["right_key"]), kind)


def keep_marked(docs: DataFrame, report: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the written ``report`` (doc_id, text_key, kept) keeps, with
    all their columns. Of several kept rows with the same id and text, one stays."""
    kept = rows_against(docs, docs, report.filter(~F.col("kept")), "left_anti")
    repeated = report.filter("kept").groupBy("doc_id", "text_key").count().filter("count > 1")
    if repeated.isEmpty():
        return kept
    once = rows_against(docs, kept, repeated, "left_anti")
    several = rows_against(docs, docs, repeated, "left_semi")
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))
