"""Benchmark decontamination by greedy string tiling (operator 7).

A document and a benchmark item that share a seed (a few words in a row, found by a hash) are
tiled by running Karp-Rabin: at a falling search length, the hash of every run of so many unmarked
words is rolled along the item into a table and along the document past it, hits are verified and extended, and the
longest matches are marked first, so tiles never overlap and reordered passages count as well as
verbatim ones. An item whose marked share reaches what its length demands contaminates the document.

Benchmark items go to the tasks in blocks of about BLOCK_BYTES of text; a larger benchmark
takes more passes, none is left out. A seed is necessary for any tile, so tiling runs only
over the words of a document that lie in seeds, and finds the same tiles as over all words.

Words are runs of ASCII letters and digits and of other than ASCII characters, in lower case;
in scripts written without spaces each letter is a word. Short items say little about where
words come from, so the share demanded of an item of n words is ``COVERAGE + (1 - COVERAGE) * MIN_MATCH / n``:
all of five words, two thirds of fifteen, and towards half of longer ones. The least tile has
MIN_MATCH words, for items under fifteen words a third of the item, but three; a tile under MIN_MATCH words counts
only within n words of another tile. An item of fewer than MIN_MATCH words must be there as a whole and
begin and end where a line or sentence of the text does.
Defined cases: null or empty texts and items match nothing; repeated rows are judged alike; an empty benchmark flags nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text, text_key, text_slices
from assetlens.llm.substring_dedup import UNSPACED

MIN_MATCH, COVERAGE = 5, 0.5
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
BASE, PRIME = 0x9E3779B97F4A7C15, (1 << 61) - 1
TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WIDE_MARKS = re.compile("[\u3000-\u303f\uff01-\uff0f\uff1a-\uff20]")
LINE_OR_SENTENCE = re.compile(r"[\n\r]|(?<=[.!?])\s|(?<=[。！？])")


def words_of(text: str) -> list[bytes]:
    text = text.lower()
    if not text.isascii():
        text = UNSPACED.sub(r" \g<0> ", WIDE_MARKS.sub(" ", text))
    return text.encode("utf-8", "replace").translate(TO_SPACE).split()


def least_tile(words: int, min_match: int = MIN_MATCH) -> int:
    """Words of the least tile of an item; of an item under ``min_match`` words, all."""
    return min(min_match, max(3, words // 3)) if words > min_match else words


def demanded(words: int, coverage: float = COVERAGE, min_match: int = MIN_MATCH) -> float:
    """The share of an item's words that must be in tiles."""
    return min(1.0, coverage + (1 - coverage) * min_match / max(words, 1))


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` ids, modulo 2^64, as the difference of two hashes of prefixes
    (they may collide; matches are verified)."""
    if len(ids) < length:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        ones = np.ones(len(ids) + 1, np.uint64)
        powers, inverses = ones.copy(), ones.copy()
        powers[1:], inverses[1:] = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
        powers, inverses = np.cumprod(powers), np.cumprod(inverses)
        terms = (ids.astype(np.uint64) + np.uint64(1)) * inverses[1:]
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
        out = (prefix[length:] - prefix[:-length]) * powers[length:]
    return out ^ (out >> np.uint64(29))


def run_hashes(words: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(start, hash) of each run of ``length`` unmarked words, rolled from one to the next."""
    top = pow(BASE, length, PRIME)
    value = size = 0
    for at, word in enumerate(words):
        if word < 0 or not free[at]:
            value = size = 0
            continue
        value = (value * BASE + word + 1) % PRIME
        size += 1
        if size > length:
            value = (value - (words[at - length] + 1) * top) % PRIME
        if size >= length:
            yield at - length + 1, value


def scan(text: list[int], item: list[int], free_t: list[bool], free_i: list[bool], length: int) -> list[tuple]:
    """Maximal matches (size, text start, item start) of ``length`` or more unmarked words: one running
    Karp-Rabin pass."""
    table: dict[int, list[int]] = defaultdict(list)
    for i, value in run_hashes(item, free_i, length):
        table[value].append(i)
    found = []
    for t, value in run_hashes(text, free_t, length):
        for i in table.get(value, ()):
            if t and i and text[t - 1] == item[i - 1] and free_t[t - 1] and free_i[i - 1]:
                continue  # not the start of a maximal match
            n = 0
            while (t + n < len(text) and i + n < len(item) and text[t + n] == item[i + n]
                   and free_t[t + n] and free_i[i + n]):
                n += 1
            if n >= length:  # else the hashes collided
                found.append((n, t, i))
    return found


def tile(text: list[int], item: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (text start, item start, size) by greedy string tiling, longest first. Words of
    ``text`` below zero match nothing."""
    free_t, free_i = [True] * len(text), [True] * len(item)
    tiles = []
    length = len(item)
    while length >= min_match:
        matches = sorted(scan(text, item, free_t, free_i, length), key=lambda m: (-m[0], m[1], m[2]))
        again = 0
        for n, t, i in matches:
            if all(free_t[t:t + n]) and all(free_i[i:i + n]):
                tiles.append((t, i, n))
                free_t[t:t + n] = [False] * n
                free_i[i:i + n] = [False] * n
            else:
                again = max(again, n)  # what is left of it may still reach this length
        if again and any(free_i):
            left = scan(text, item, free_t, free_i, length)
            if left:
                continue
        if length == min_match:
            break
        length = max(min_match, length // 2)
    return tiles


def bounds_of(text: str) -> set[int]:
    """The word numbers at which a line or sentence of the text begins or ends."""
    at, bounds = 0, {0}
    for part in LINE_OR_SENTENCE.split(text):
        at += len(words_of(part))
        bounds.add(at)
    return bounds


class Block:
    """Some benchmark items and the seeds that lead to them."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int = MIN_MATCH):
        self.min_match = min_match
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | None, list[int]]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if ids:
                self.items.append((item_id, ids))
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, ids) in enumerate(self.items):
            length = least_tile(len(ids), min_match)
            seeds[length] += [(int(h), k) for h in set(rolling(np.array(ids, np.int64), length).tolist())]
        self.seeds = []
        for length, pairs in sorted(seeds.items()):
            pairs.sort()
            hashes = np.array([h for h, _ in pairs], np.uint64)
            owner = np.array([k for _, k in pairs], np.int64)
            distinct, first = np.unique(hashes, return_index=True)
            self.seeds.append((length, distinct, np.append(first, len(pairs)), owner))

    def matches(self, text: str, coverage: float = COVERAGE) -> Iterator[tuple[int | None, float, list[tuple[int, int, int]]]]:
        """Items of which the text has enough: item id, coverage and tiles (first word in
        the text, first word in the item, words)."""
        words = words_of(text)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        known = ids >= 0
        spots: dict[int, list[np.ndarray]] = defaultdict(list)
        for length, distinct, first, owner in self.seeds:
            if len(ids) < length:
                continue
            inside = np.concatenate([[0], np.cumsum(known)])
            at = np.flatnonzero(inside[length:] - inside[:-length] == length)
            if not len(at):
                continue
            keys = rolling(ids, length)[at]
            slot = np.minimum(np.searchsorted(distinct, keys), len(distinct) - 1)
            hit = distinct[slot] == keys
            for t, s in zip(at[hit].tolist(), slot[hit].tolist()):
                for k in owner[first[s]:first[s + 1]].tolist():
                    spots[k].append((t, length))
        bounds = None
        for k, hits in sorted(spots.items()):
            item_id, item = self.items[k]
            if len(item) < self.min_match:
                bounds = bounds_of(text) if bounds is None else bounds
                at = next((t for t, n in hits if t in bounds and t + n in bounds and ids[t:t + n].tolist() == item), None)
                if at is not None:
                    yield item_id, 1.0, [(at, 0, len(item))]
                continue
            covered = sorted({t + n for t, length in hits for n in range(length)})
            dense, where = [], []  # the words in seeds, with a word that matches nothing at each gap
            for p in covered:
                if where and p != where[-1] + 1:
                    dense.append(-1)
                    where.append(-1)
                dense.append(int(ids[p]))
                where.append(p)
            tiles = sorted((where[t], i, n) for t, i, n in tile(dense, item, least_tile(len(item), self.min_match)))
            near = [b[0] - a[0] - a[2] <= len(item) for a, b in zip(tiles, tiles[1:])]
            tiles = [x for x, before, after in zip(tiles, [False, *near], [*near, False])
                     if x[2] >= self.min_match or before or after]
            share = sum(n for _, _, n in tiles) / len(item)
            if share >= demanded(len(item), coverage, self.min_match):
                yield item_id, share, tiles


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        yield sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def contaminations(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it contains: doc_id, text_key, item_id, coverage, tiles
    (array of first word in the document, first word in the item, words). ``coverage`` is the share
    that a long item must have, see ``demanded``."""
    spark = docs.sparkSession
    rows = id_and_text(docs).withColumn("text_key", text_key(F.col("text")))
    schema = ("doc_id long, text_key long, item_id long, coverage double, "
              "tiles array<struct<doc_word: long, item_word: long, words: long>>")
    tile_type = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))

    def search(block) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, SLICE_BYTES):
                found = [(d, key, item, share, tiles)
                         for d, key, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text")))
                         for item, share, tiles in block.value.matches(t, coverage)]
                columns = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(columns[0], pa.int64()), "text_key": pa.array(columns[1], pa.int64()),
                    "item_id": pa.array(columns[2], pa.int64()), "coverage": pa.array(columns[3], pa.float64()),
                    "tiles": pa.array([[dict(zip(("doc_word", "item_word", "words"), x)) for x in tiles]
                                       for tiles in columns[4]], tile_type)})

        return rows.mapInArrow(run, schema)

    out = None
    for items in _blocks(benchmark):
        found = search(spark.sparkContext.broadcast(Block(items)))
        out = found if out is None else out.union(found)
    return out
