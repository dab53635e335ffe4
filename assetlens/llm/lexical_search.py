"""Ranked lexical search with exact sparse ball trees (operator 13).

Queries are taken in blocks of bounded text, whose terms (the only ones a score depends on) go to
all tasks. A first pass over the whole texts counts these terms per document and writes narrow
rows; corpus counts (documents, terms, document frequencies) are aggregates of them. Then each
task builds ball trees over the impact vectors of its documents (``ball_tree``), searches them for
every query of the block best-first, keeping its k best so far from tree to tree, and gives these
to a top-k per query. No document meets another, no text moves, and a task hands on at most k rows a
query, so neither equal documents nor common words make a group.

A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))`` and its impact on a document with tf
occurrences ``10^9 tf div (1000 tf + 8 m)``, where ``m = 10 + (90 n N) div L`` for n terms in
the document, N documents with terms and L terms in all. Scores are exact integers.

Defined cases: null and empty texts have no terms and are found by no query, nor counted; rows that
repeat an id are documents of their own, each with its rank; a null id ranks last among equal
scores; rows of the query table with the same id are one query with the terms of all, a null
id included; a query without terms, or whose terms are in no document, gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlens.llm.ball_tree import BallTree
from assetlens.llm.common import id_and_text, text_slices
from assetlens.session import materialize, remove_folder

K = 10
BLOCK_BYTES = 64 << 10
"""Text of the queries that are searched for together."""
SLICE_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
"""Terms of a long text are counted piece by piece."""
TREE_ROWS, TREE_ENTRIES, TREE_TERMS = 8192, 1 << 21, 1 << 26
"""Bounds of a tree: rows, entries, and rows times terms of the block."""
LAST_ID = 1 << 63

# What is no part of a term becomes a space, A-Z become a-z, bytes of other characters stay.
_TERM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of about ``PIECE_BYTES``."""
    plain, begin = text.translate(_TERM), 0
    while begin < len(plain):
        end = plain.find(b" ", begin + PIECE_BYTES) if len(plain) - begin > PIECE_BYTES else -1
        end = len(plain) if end < 0 else end
        yield plain[begin:end].split()
        begin = end


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Documents with terms: doc_id, n (terms), terms (numbers in the vocabulary), counts."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in text_slices(batches, SLICE_BYTES):
            ids, sizes, terms, counts = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, found = 0, Counter()
                for piece in terms_of(text.as_py()):
                    n += len(piece)
                    found.update(map(known.get, piece))
                if n:
                    found.pop(None, None)
                    ids.append(doc)
                    sizes.append(n)
                    terms.append(list(found))
                    counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"])

    rows = id_and_text(docs).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def query_blocks(queries: DataFrame) -> Iterator[dict[int | None, set[bytes]]]:
    """The queries' terms by id, about ``BLOCK_BYTES`` of text at a time."""
    rows = id_and_text(queries.select(F.col("item_id").alias("doc_id"), "text")).where("text <> ''")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    for b in range(blocks):
        items: dict[int | None, set[bytes]] = {}
        for row in rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == b).collect():
            for piece in terms_of(row["text"].encode()):
                items.setdefault(row["doc_id"], set()).update(piece)
        items = {i: terms for i, terms in items.items() if terms}
        if items:
            yield items


class Queries:
    """The queries of a block as weight vectors over the block's terms."""

    def __init__(self, items: dict[int | None, set[bytes]], vocabulary: list[bytes], frequency: dict[int, int],
                 documents: int, terms: int):
        self.item_ids, self.documents, self.terms = list(items), documents, terms
        df = np.array([frequency.get(t, 0) for t in range(len(vocabulary))], np.int64)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        number = {t: i for i, t in enumerate(vocabulary)}
        self.weights = np.zeros((len(items), len(vocabulary)), np.int64)
        for i, own in enumerate(items.values()):
            at = [number[t] for t in own]
            self.weights[i, at] = weight[at]

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        m = 10 + (90 * n * self.documents) // self.terms
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def search_task(queries: Queries, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The k best documents among ``batches`` (doc_id, n, terms, counts) for each query."""
    wanted = queries.weights.T.astype(np.float64)
    best: list[list[tuple[int, int]]] = [[] for _ in queries.item_ids]

    def search(parts: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        terms, counts = (rows.column(c).combine_chunks() for c in ("terms", "counts"))
        size = np.diff(terms.offsets.to_numpy())
        ids = np.array([LAST_ID if d is None else d for d in rows.column("doc_id").to_pylist()], object)
        values = queries.impacts(np.repeat(rows.column("n").to_numpy(), size), counts.flatten().to_numpy())
        tree = BallTree(ids, np.append(0, np.cumsum(size)), terms.flatten().to_numpy().astype(np.int64), values, len(wanted))
        bounds = tree.bounds(wanted)
        for q, own in enumerate(best):
            tree.search(queries.weights[q], bounds, q, k, own)

    waiting: list[pa.RecordBatch] = []
    rows = entries = 0
    most = max(256, min(TREE_ROWS, TREE_TERMS // len(wanted)))
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            waiting.append(part)
            rows += part.num_rows
            entries += len(part.column("terms").flatten())
            if rows >= most or entries >= TREE_ENTRIES:
                search(waiting)
                waiting, rows, entries = [], 0, 0
    if waiting:
        search(waiting)
    found = [(item, None if -d == LAST_ID else -d, score) for item, own in zip(queries.item_ids, best) for score, d in own]
    columns = list(zip(*found)) or [[]] * 3
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The k highest-scoring documents of each item (item_id, text): item_id, rank (int, from 1),
    doc_id, score."""
    spark, out = docs.sparkSession, None
    for block in query_blocks(items):
        vocabulary = sorted(set().union(*block.values()))
        scratch: list[str] = []
        counts = materialize(count_terms(docs, vocabulary), "lexical-counts", scratch)
        whole = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if whole[0]:
            # At most one row per term of the block comes to the driver.
            df = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
            queries = spark.sparkContext.broadcast(
                Queries(block, vocabulary, {r["term"]: r["count"] for r in df}, whole[0], whole[1]))
            found = counts.where(F.size("terms") > 0).mapInArrow(
                lambda batches, q=queries: search_task(q.value, k, batches), "item_id long, doc_id long, score long")
            order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
            top = materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                              .select("item_id", "rank", "doc_id", "score"), "lexical-top")
            queries.unpersist()
            out = top if out is None else out.unionByName(top)
        for folder in scratch:
            remove_folder(spark, folder)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
