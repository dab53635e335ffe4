"""Token-id files with fixed-width bit packing (operator 9).

Every id takes the minimum number of bits that holds the vocabulary. A shard is one
self-describing byte string; shards are rows of a Spark table (``part, shard, earlier,
n_ids, blob``; ``earlier`` counts the ids of the part before the shard), so Spark's writer commits them on whatever store the folder is on, and a task that
is lost and run again leaves no half-written file. Layout of a shard, little-endian:

    4s  magic "BPK1"      u32 bits per id     u32 ids per block     u32 documents
    u64 ids               u64 blocks
    i64 x documents       ids of the documents (the smallest i64 stands for null)
    u64 x documents       tokens of each document, end id included
    u64 x (blocks + 1)    byte offset of each block in the payload
    payload               blocks of packed ids, lowest bit first; each block starts on a byte

Block offsets give random access: id i is in block i // ids_per_block, and only that block's
bytes are unpacked, with numpy. Documents stand in ascending id order over all shards and
never straddle two shards.

Defined cases: null text is an empty document (its only token is the end id); null ids come
first; rows with equal ids stand in the order of their text's hash; an empty table gives no
shard and no row.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text, text_slices
from assetlens.llm.tokenizing import encoder
from assetlens.session import materialize

MAGIC = b"BPK1"
HEAD = struct.Struct("<4sIIIQQ")
BLOCK_IDS = 4096
SHARD_IDS = 1 << 18
NULL_ID = np.iinfo(np.int64).min
SLICE_BYTES = 2 << 20


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive ``bits``-wide fields, lowest bit first, padded to a whole byte."""
    if bits in (8, 16, 32):  # the same layout, without the detour over single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    fields = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(fields.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_ids(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    fields = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (fields.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(1).astype(np.uint32)


def write_shard(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"token id {int(ids.max())} needs more than {bits} bits")
    blocks = [pack_ids(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    keys = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join([HEAD.pack(MAGIC, bits, block_ids, len(doc_ids), len(ids), len(blocks)),
                     keys.tobytes(), np.asarray(counts, "<u8").tobytes(), offsets.tobytes(), *blocks])


class ShardReader:
    """Random access to one shard."""

    def __init__(self, blob: bytes):
        self.view = memoryview(blob)
        magic, self.bits, self.block_ids, n_docs, self.n_ids, n_blocks = HEAD.unpack_from(self.view)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size
        self.doc_ids = np.frombuffer(self.view, "<i8", n_docs, at)
        self.counts = np.frombuffer(self.view, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(self.view, "<u8", n_blocks + 1, at + 16 * n_docs).astype(np.int64)
        self.payload = self.view[at + 16 * n_docs + 8 * (n_blocks + 1):]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; unpacks the blocks that hold them only."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError((start, stop, self.n_ids))
        if start == stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        whole = np.concatenate([
            unpack_ids(self.payload[self.offsets[b]:self.offsets[b + 1]],
                       min(self.block_ids, self.n_ids - b * self.block_ids), self.bits)
            for b in range(first, last + 1)])
        return whole[start - first * self.block_ids:stop - first * self.block_ids]


def write_token_files(docs: DataFrame, tokenizer_path: str, vocabulary: int, keeps_space: bool = False) -> DataFrame:
    """Encodes the texts, appends the end id to each, and writes the shards in ascending
    document order. Returns the written table ``part, shard, earlier, n_ids, blob``."""
    bits = bits_for(vocabulary)
    ordered = id_and_text(docs).repartitionByRange("doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, earlier = encoder(tokenizer_path, keeps_space), 0, 0
        keys: list = []
        counts: list[np.ndarray] = []
        flats: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, earlier, held
            ids = np.concatenate(flats)
            blob = write_shard(keys, np.concatenate(counts), ids, bits)
            row = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                 "earlier": pa.array([earlier], pa.int64()),
                 "n_ids": pa.array([len(ids)], pa.int64()), "blob": pa.array([blob], pa.binary())})
            shard, earlier, held = shard + 1, earlier + len(ids), 0
            keys.clear(), counts.clear(), flats.clear()
            return row

        for batch in text_slices(batches, SLICE_BYTES):
            part = batch.column("part")[0].as_py()
            flat, n = enc.encode(batch.column("text").to_pylist())
            doc_ids, ends = batch.column("doc_id").to_pylist(), np.cumsum(n)
            begin = 0
            while begin < len(n):  # documents up to the one that fills the shard
                before = ends[begin - 1] if begin else 0
                stop = min(len(n), int(np.searchsorted(ends, before + SHARD_IDS - held)) + 1)
                keys += doc_ids[begin:stop]
                counts.append(n[begin:stop])
                flats.append(flat[before:ends[stop - 1]])
                held += int(ends[stop - 1] - before)
                begin = stop
                if held >= SHARD_IDS:
                    yield flush()
        if keys:
            yield flush()

    return materialize(ordered.mapInArrow(encode, "part int, shard int, earlier long, n_ids long, blob binary"), "token-files")


def read_token_files(shards: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids
    (binary, little-endian unsigned 32-bit)."""
    spark = shards.sparkSession
    # One row per written partition reaches the driver, as Spark's own task list does.
    parts = sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before, bases = 0, []
    for row in parts:
        bases.append((row["part"], before))
        before += row["n"]
    bases = spark.createDataFrame(bases, "base_part int, base long")
    placed = shards.join(bases, shards["part"] == bases["base_part"]).select(
        (F.col("base") + F.col("earlier")).alias("first"), "blob")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, blob in zip(batch.column("first").to_pylist(), batch.column("blob")):
                reader = ShardReader(blob.as_buffer())
                ids = reader.ids(0, reader.n_ids).astype("<u4")
                ends = np.cumsum(reader.counts)
                offsets = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype("<i4"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.doc_ids, pa.int64(), mask=reader.doc_ids == NULL_ID),
                    "start": pa.array(first + ends - reader.counts, pa.int64()),
                    "n_tokens": pa.array(reader.counts, pa.int64()),
                    "ids": pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(ids.tobytes())])})

    return placed.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")


def with_digest(documents: DataFrame) -> DataFrame:
    """The documents with crc32 of their ids in place of the ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
