"""Cost-balanced packing of documents into fixed-length token sequences (operator 6).

A piece of n tokens costs ``n + n * n / QUADRATIC_AT`` (linear layers plus attention). The
documents of a group, longest first, go to the sequence of lowest cost so far that has room
for them. Documents beyond the sequence length first give up their full-length pieces; a
document that no sequence has room for is cut at the room of the emptiest sequence.

A group is the documents that one task has read up to GROUP_TOKENS, so packing moves no
data. Each group opens as many full sequences as its tokens fill, and its remainder as
sequences with the powers of two of its binary form as lengths, which need no padding.

Defined cases: a null text is an empty document (one piece holding the end id); repeated
rows are packed each; an empty table gives no piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text, text_slices
from assetlens.llm.tokenizing import encoder

SEQUENCE_TOKENS = 2048
GROUP_TOKENS = 1 << 20
QUADRATIC_AT = 1024
SLICE_BYTES = 2 << 20
SEQUENCES_PER_TASK = 1 << 40


def piece_cost(n: np.ndarray | int):
    return n + n * n / QUADRATIC_AT


def capacities(tokens: int, length: int) -> np.ndarray:
    """Full sequences, then the remainder's powers of two: together exactly ``tokens``."""
    rest = tokens % length
    return np.array([length] * (tokens // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1)
                                                     if rest >> b & 1], np.int64)


def assign(counts: np.ndarray, length: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document index, start, length, sequence, offset) of a group of documents."""
    room = capacities(int(counts.sum()), length)
    cost = np.zeros(len(room))
    size = room.copy()
    pieces = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, int(size[seq] - room[seq])))
        room[seq] -= n
        cost[seq] += piece_cost(n)

    seq = 0
    left = counts.copy()
    for doc in np.flatnonzero(counts >= length):  # full-length pieces are sequences of their own
        for _ in range(int(counts[doc]) // length):
            put(int(doc), int(counts[doc] - left[doc]), length, seq)
            left[doc] -= length
            seq += 1
    for doc in np.argsort(-left, kind="stable"):
        while left[doc]:
            n = int(left[doc])
            fits = np.flatnonzero(room >= n)
            if len(fits):
                to = int(fits[np.argmin(cost[fits])])
            else:
                to = int(np.argmax(room))
                n = int(room[to])
            put(int(doc), int(counts[doc] - left[doc]), n, to)
            left[doc] -= n
    return pieces


def pack_documents(docs: DataFrame, tokenizer_path: str, keeps_space: bool = True,
                   length: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids
    (binary, little-endian unsigned 32-bit)."""
    if length & (length - 1):
        raise ValueError("the sequence length must be a power of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc = encoder(tokenizer_path, keeps_space)
        next_sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        keys: list = []
        counts: list[np.ndarray] = []
        flats: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal next_sequence
            n, flat = np.concatenate(counts), np.concatenate(flats).astype("<u4")
            first = np.cumsum(n) - n
            doc, start, size, seq, offset = (np.array(x, np.int64) for x in zip(*assign(n, length)))
            order = np.lexsort((start, doc))
            doc, start, size, seq, offset = doc[order], start[order], size[order], seq[order], offset[order]
            # In document order the pieces' ids are the group's ids one after another.
            bounds = pa.py_buffer(np.concatenate([[0], 4 * np.cumsum(size)]).astype("<i4"))
            assert (first[doc] + start == np.cumsum(size) - size).all()
            out = pa.RecordBatch.from_pydict({
                "doc_id": pa.array([keys[i] for i in doc.tolist()], pa.int64()),
                "start": pa.array(start), "length": pa.array(size), "doc_tokens": pa.array(n[doc]),
                "sequence_id": pa.array(seq + next_sequence), "offset": pa.array(offset),
                "ids": pa.Array.from_buffers(pa.binary(), len(doc), [None, bounds, pa.py_buffer(flat.tobytes())])})
            next_sequence += int(seq.max()) + 1
            keys.clear(), counts.clear(), flats.clear()
            return out

        held = 0
        for batch in text_slices(batches, SLICE_BYTES):
            flat, n = enc.encode(batch.column("text").to_pylist())
            keys += batch.column("doc_id").to_pylist()
            counts.append(n)
            flats.append(flat)
            held += len(flat)
            if held >= GROUP_TOKENS:
                yield flush()
                held = 0
        if keys:
            yield flush()

    return id_and_text(docs).mapInArrow(
        pack, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def with_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
