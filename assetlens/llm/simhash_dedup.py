"""SimHash near-dedup by anchor-point covering (operator 2).

Anchors are the words of a covering code: the product of two binary Golay codes [23, 12] on
46 of the 64 fingerprint bits. The Golay code is perfect with covering radius 3, so each half
has exactly one code word within 3 bits. Of two fingerprints at distance d at most, the first
is within the covering radius (3 in each half) of its home anchor, and the second is beyond
that radius by d bits at most, both halves together. So each distinct fingerprint is sent to
its home anchor and, for comparison, to every anchor within covering radius plus threshold;
an equi-join on the anchor compares all 64 bits. No pair within the threshold is missed.

The two Golay codes give 2**24 anchors, of which a fingerprint reaches about 61 at two bits: up to
that many distinct fingerprints, random ones hardly ever meet. Beyond, a third code joins the
product, the perfect Hamming code [15, 11] (radius 1) on 15 more bits: 2**35 anchors, of which
a fingerprint reaches about 153, so what is compared at an anchor stays small. Both products find
the same pairs. Equal fingerprints are one row (pre-aggregated), and a fingerprint has at
most 2,080 others within two bits, so links grow with the distinct fingerprints, not with
the square of a group of copies. Groups are the connected components of the links.

Defined cases: a null text is empty and has fingerprint zero; null ids rank last; repeated
rows share their group; ties between equal ids go to the smaller hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text, text_key, text_slices
from assetlens.llm.components import components
from assetlens.session import materialize

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
SLICE_BYTES = 4 << 20


class Code(NamedTuple):
    """A perfect cyclic code on the fingerprint bits from ``at`` on."""
    generator: int
    bits: int
    check_bits: int
    radius: int
    at: int


# Generator polynomials and parameters of the Golay code and the Hamming code [15, 11].
GOLAY = [Code(0xC75, 23, 11, 3, 0), Code(0xC75, 23, 11, 3, 23)]
HAMMING = Code(0b10011, 15, 4, 1, 46)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles (A-Z lower-cased, repeats included)."""
    tokens = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII case and white space only
    if not tokens:
        return 0
    n = len(tokens) - words + 1
    line = b" ".join(tokens)
    if n <= 1:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):  # a long text's hashes and bits are held in part only
        j = min(n, i + (1 << 14))
        hashes = np.array([digest(line[a:b], SEED) for a, b in
                           zip(starts[i:j].tolist(), (ends[i + words - 1:j + words - 1] - 1).tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and text_key (a hash of the text that,
    with the id, names the row)."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, SLICE_BYTES):
            fps = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(fps.view(np.int64)),
                                              "text_key": batch.column("text_key")})

    rows = id_and_text(docs).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(compute, "doc_id long, fp long, text_key long")


def codes_for(fingerprints: int) -> list[Code]:
    """The codes whose product gives the anchors: at least as many anchors as distinct fingerprints, as far as 64 bits go."""
    anchors = 1 << sum(c.bits - c.check_bits for c in GOLAY)
    return GOLAY if fingerprints <= anchors else [*GOLAY, HAMMING]


class Cover:
    """Code words of a code around a word, by how far beyond the covering radius they lie: 0
    (exactly one), 1, ..., up to the threshold."""

    def __init__(self, code: Code, threshold: int):
        def remainder(word: int) -> int:
            for bit in range(code.bits - 1, code.check_bits - 1, -1):
                if word >> bit & 1:
                    word ^= code.generator << (bit - code.check_bits)
            return word

        self.code = code
        of_bit = [remainder(1 << b) for b in range(code.bits)]
        self.low, self.high = np.zeros(1 << 12, np.int64), np.zeros(1 << (code.bits - 12), np.int64)
        for b in range(code.bits):
            table, at = (self.low, b) if b < 12 else (self.high, b - 12)
            table[np.arange(len(table)) >> at & 1 == 1] ^= of_bit[b]
        # A word plus any pattern of the same remainder is a code word.
        patterns: list[dict[int, list[int]]] = [{} for _ in range(threshold + 1)]
        for weight in range(code.radius + threshold + 1):
            for bits in combinations(range(code.bits), weight):
                rest = 0
                for b in bits:
                    rest ^= of_bit[b]
                patterns[max(0, weight - code.radius)].setdefault(rest, []).append(sum(1 << b for b in bits))
        self.around = []
        for by_rest in patterns:
            table = np.full((1 << code.check_bits, max(map(len, by_rest.values()))), -1, np.int64)
            for rest, own in by_rest.items():
                table[rest, :len(own)] = own
            self.around.append(table)

    def word(self, fps: np.ndarray) -> np.ndarray:
        """The bits of the fingerprints that the code is on."""
        return fps >> self.code.at & (1 << self.code.bits) - 1

    def anchors(self, word: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
        """Code words ``beyond`` bits outside the radius of each word, and which are real."""
        pattern = self.around[beyond][self.low[word & 0xFFF] ^ self.high[word >> 12]]
        return word[:, None] ^ pattern, pattern >= 0


def anchors_of(fps: np.ndarray, covers: list[Cover], beyond: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors at ``beyond`` bits outside each code's radius, and the row of ``fps`` each belongs to."""
    anchor, real = np.zeros((len(fps), 1), np.int64), np.ones((len(fps), 1), bool)
    for cover, far in zip(covers, beyond):
        part, is_real = cover.anchors(cover.word(fps), far)
        anchor = (anchor[:, :, None] | (part << cover.code.at)[:, None, :]).reshape(len(fps), -1)
        real = (real[:, :, None] & is_real[:, None, :]).reshape(len(fps), -1)
    return anchor[real], np.nonzero(real)[0]


def anchor_rows(distinct: DataFrame, reach: int, codes: list[Code] = GOLAY) -> DataFrame:
    """``fp`` to ``anchor, fp`` for all anchors within covering radius plus ``reach``."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covers = [Cover(code, reach) for code in codes]
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                fp = batch.column("fp").slice(i, 4096).to_numpy(zero_copy_only=False)
                for beyond in product(range(reach + 1), repeat=len(covers)):
                    if sum(beyond) <= reach:
                        anchor, row = anchors_of(fp, covers, beyond)
                        yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor), "fp": pa.array(fp[row])})

    return distinct.select("fp").mapInArrow(send, "anchor long, fp long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, codes: list[Code] = GOLAY) -> DataFrame:
    """Pairs a < b of different fingerprints at ``max_bits`` or fewer differing bits."""
    home = anchor_rows(distinct, 0, codes)
    visitors = anchor_rows(distinct, max_bits, codes).withColumnRenamed("fp", "other")
    # Each pair meets at the home of either end, so one order of the two is enough. Spark takes either side for as
    # small as the fingerprints it is made from and would broadcast 61 or 153 rows for each, so the join is named.
    return home.join(visitors.hint("merge"), "anchor").filter(
        (F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits)) \
        .select(F.col("fp").alias("a"), F.col("other").alias("b"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, fp, component_id (smallest id of the
    component) and kept (whether this row stands for its component)."""
    fps = materialize(fingerprints(docs, words), "simhash-fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    distinct = materialize(fps.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-distinct")
    roots = materialize(components(links(distinct, max_bits, codes_for(distinct.count()))), "simhash-components")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    decided = materialize(rooted.drop("first").join(firsts, "root").select("fp", "first"), "simhash-decided")
    return fps.join(decided, "fp").select(
        "doc_id", "text_key", "fp", F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
         & (F.col("text_key") == F.col("first.text_key"))).alias("kept"))


def with_hex(report: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return report.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
