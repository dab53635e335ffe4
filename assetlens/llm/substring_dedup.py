"""Substring dedup by line hashing (operator 1).

Every non-empty line is a unit, whatever its length. Units are normalised (lower case, runs of ASCII
white space one space, ends trimmed) and hashed; equal digests are grouped over the whole corpus, the occurrence of smallest
rank (document id, then place) stays, and every other one is removed, with its character offsets
in the original text. The sentences of the lines that stay, of any length too, are a second kind of unit, so a passage
that was pasted into the middle of other lines is found as well.

Only units that occur twice or more take part in the join that finds the removed ones; a unit
that is in a third of all documents is one row on the group side, and its occurrences are
rows of a plain equi-join of two written tables, whose large partitions adaptive execution
splits.

Defined cases: null and empty texts have no units; null ids rank last; rows that repeat an id
are ranked by the hash of their text as well, and equal rows keep the unit in each of them;
columns other than doc_id and text are not read, whatever their names; an empty table has no units.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text, text_key, text_slices
from assetlens.session import materialize

SENTENCE_CUT = re.compile(r"(?<=[.!?]) |(?<=[。！？])")
"""What ends a sentence: a space after a stop, or a full-width stop itself."""
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
                      "\U00020000-\U0003ffff]")
"""Letters of scripts written without spaces."""
SLICE_BYTES = 4 << 20


def sentences(line: str) -> list[tuple[int, int, int]]:
    """(start, length, characters of the cut after it) of each sentence of a line; nothing
    is cut after the last one, so that the line's end stays with what is kept of the line."""
    out, at = [], 0
    for cut in SENTENCE_CUT.finditer(line):
        out.append((at, cut.start() - at, cut.end() - cut.start()))
        at = cut.end()
    if at < len(line):
        out.append((at, len(line) - at, 0))
    return out


def digest_of(text: str) -> bytes | None:
    """Digest of the normalised text; none if it is white space only. (Bytes split at ASCII white space.)"""
    words = text.lower().encode("utf-8", "replace").split()
    return blake2b(b" ".join(words), digest_size=16).digest() if words else None


def spans(docs: DataFrame) -> DataFrame:
    """One row per line (``whole``) and per sentence (``sentence``) that is not white space only; a line of one sentence is one
    row. ``unit`` is the number of the line, ``cut`` the number of characters that go with the unit."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            rows = []
            for r, text in enumerate(batch.column("text").to_pylist()):
                at = 0
                for n, line in enumerate(text.split("\n")):
                    digest = digest_of(line)
                    if digest:
                        parts = sentences(line)
                        rows.append((r, n, at, len(line), 1, digest, True, len(parts) == 1))
                        for start, length, cut in parts if len(parts) > 1 else ():
                            digest = digest_of(line[start:start + length])
                            if digest:
                                rows.append((r, n, at + start, length, cut, digest, False, True))
                    at += len(line) + 1
            row, *columns = zip(*rows) if rows else [()] * 8
            row = pa.array(row, pa.int64())
            types = [pa.int64()] * 4 + [pa.binary(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("text_key").take(row),
                 *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "text_key", "unit", "start", "length", "cut", "digest", "whole", "sentence"])

    rows = id_and_text(docs).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(found, "doc_id long, text_key long, unit long, start long, length long, cut long, "
                                  "digest binary, whole boolean, sentence boolean")


def repeats(found: DataFrame, kind: str) -> DataFrame:
    """All but the first occurrence of each digest in the written table ``found``."""
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "start", "unit")
    groups = materialize(found.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies"))
                         .filter("copies > 1"), f"{kind}-groups")
    first = F.col("first")
    return found.join(groups, "digest").filter(
        ~(F.col("doc_id").eqNullSafe(first["doc_id"]) & (F.col("text_key") == first["text_key"])
          & (F.col("start") == first["start"]))).select(
        "doc_id", "text_key", F.lit(kind).alias("kind"), "unit", "start", "length", "cut",
        first["doc_id"].alias("first_doc_id"), first["unit"].alias("first_unit"),
        first["start"].alias("first_start"), "copies")


def removed_spans(docs: DataFrame) -> DataFrame:
    """One row per removed line or sentence: doc_id, text_key, kind, unit (number of the
    line), start, length, cut, where the kept occurrence is, copies. Lines come first; the
    sentences of the lines that stay (the kept occurrence of a repeated line included) are
    compared with each other, so no removed span is inside another one, and the kept
    occurrence of a line can lose only sentences that an earlier text keeps."""
    found = materialize(spans(docs), "line-spans")
    lines = materialize(repeats(found.filter("whole"), "line"), "line-copies")
    gone = lines.select(F.col("doc_id").alias("right_id"), F.col("text_key").alias("right_key"),
                        F.col("unit").alias("right_unit"))
    left = materialize(found.filter("sentence").join(
        gone, F.col("doc_id").eqNullSafe(F.col("right_id")) & (F.col("text_key") == F.col("right_key"))
        & (F.col("unit") == F.col("right_unit")), "left_anti"), "line-sentences")
    return lines.unionByName(repeats(left, "sentence"))


def cleaned(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the removed units cut from the text, each with the ``cut`` characters that go
    with it; other columns, and texts without removed units, as they are."""
    spans = removed.groupBy(F.col("doc_id").alias("right_id"), F.col("text_key").alias("right_key")) \
        .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("length") + F.col("cut")).alias("length"))))
             .alias("right_spans"))
    joined = docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(spans["right_id"])
                       & (text_key(docs["text"]) == spans["right_key"]), "left")
    at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                kept, done = [], 0
                for span in gone or ():
                    kept.append(text[done:span["start"]])
                    done = span["start"] + span["length"]
                texts.append("".join([*kept, text[done:]]) if kept else text)
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.select(*[docs[c] for c in docs.columns], spans["right_spans"]).mapInArrow(cut, docs.schema)
