"""Suffix dedup: distributed merge sort of front-coded suffix runs (operator 4).

Removes every byte covered by a LENGTH-byte string that also starts in a document with a
smaller id. Strings are bytes of UTF-8, never cross documents, and are judged on the input.

Which suffixes are sorted. Of each window of LENGTH bytes, the GRAM-byte string of smallest
hash (the leftmost of equals) is its anchor. Equal windows have the same anchor at the same
place, so it is enough to sort the suffixes that start at anchors: one entry stands for the
stretch of consecutive windows that share an anchor, about one in sixteen positions. An entry
is the suffix from the anchor to the end of the last window, then the bytes before the anchor
back to the first window, reversed.

1. Runs: the documents of a task, up to RUN_BYTES of text, become a run; runs are written to
   a table bucketed by run, so later steps meet them without moving text again.
2. Distinguishing prefixes: each run sends the distinct hashes of its anchor grams; a gram
   that occurs in one document only cannot start a repeated window, and its suffixes stay.
3. Each run sorts its remaining entries, merges equal ones (smallest id kept), and sends them
   front-coded (length of the common prefix with the entry before, and the rest), compressed,
   to the bucket of their gram.
4. A bucket merges the sorted runs with a loser tree whose players carry the length of the
   prefix they share with the last winner: unequal lengths decide a match without looking at
   a byte, equal lengths compare from there on, so a known prefix is never compared again.
   Entries that share an anchor gram come out next to each other; equal ones settle all their
   windows at once, others window by window.
5. The smallest ids go back to the runs that have larger ones, which mark the bytes.

A passage that a third of all documents share is one entry per run, whatever its copies. A
gram that stands in many different contexts (more than HOT_GRAM anchors in all) would gather
them in one bucket: its windows are sent one by one instead, dealt by the whole window. A
bucket holds about as many bytes as a run, and more than MAX_STREAMS runs are merged in
passes. All tables are written to the shared folder; nothing but counts reaches the driver.

Defined cases: a null text is empty (nothing removed); null ids rank last and are equal to
each other; rows that repeat an id never remove each other's bytes; an empty table gives an
empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.llm.common import id_and_text
from assetlens.session import fresh_dir, materialize

LENGTH, GRAM = 50, 20
RUN_BYTES = 6 << 20
SEGMENT_BYTES = 1 << 16
MAX_STREAMS = 256
HOT_GRAM = 1 << 15
NO_ID = np.iinfo(np.int64).max
_POSITION = np.uint64((1 << 22) - 1)
_BYTE_HASH = np.random.default_rng(50).integers(1, 1 << 63, 256, np.uint64)
_FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                   0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]

Entry = tuple[int, bytes, int, int, int]
"""Common prefix with the entry before, key, smallest id, flags, run. Flag 1: the run has
several ids with the key; flag 2: the key is one window of a hot gram."""
SEVERAL, HOT = 1, 2


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays one after another with their sizes, compressed."""
    parts = [a.tobytes() for a in arrays]
    return zstandard.compress(struct.pack(f"<{len(parts)}Q", *map(len, parts)) + b"".join(parts), 1)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    sizes = struct.unpack_from(f"<{len(kinds)}Q", data)
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


# --- anchors -----------------------------------------------------------------------------

def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM (20) bytes from each position on."""
    one = _BYTE_HASH[data]
    two = one[:-1] * _FACTORS[0] + one[1:]
    four = two[:-2] * _FACTORS[1] + two[2:]
    eight = four[:-4] * _FACTORS[2] + four[4:]
    sixteen = eight[:-8] * _FACTORS[3] + eight[8:]
    h = sixteen[:-4] * _FACTORS[4] + four[16:]
    h ^= h >> np.uint64(31)
    h *= _FACTORS[5]
    h ^= h >> np.uint64(29)
    return h


class Run:
    """Documents of a run: their ids, where each ends, and all their bytes."""

    def __init__(self, blob: bytes):
        self.ids, self.ends, self.data = _unpacked(blob, "<i8", "<i8", "u1")

    @staticmethod
    def blob(ids: list[int], texts: list[bytes]) -> bytes:
        return _packed(np.array(ids, "<i8"), np.cumsum([len(t) for t in texts]).astype("<i8"),
                       np.frombuffer(b"".join(texts), "u1"))

    def anchors(self, length: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Per segment of the run: first window, last window, anchor (positions in the run),
        document number and 47-bit gram hash of each stretch of windows with one anchor."""
        wide = length - GRAM + 1  # grams in a window
        for begin in range(0, len(self.data), SEGMENT_BYTES):
            piece = self.data[begin:begin + SEGMENT_BYTES + length - 1]
            windows = len(piece) - length + 1
            if windows <= 0:
                break
            h = gram_hashes(piece)
            order = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
            size = 1
            while 2 * size <= wide:
                order, size = np.minimum(order[:-size], order[size:]), 2 * size
            if size < wide:
                order = np.minimum(order[:len(order) - (wide - size)], order[wide - size:])
            at = (order & _POSITION).astype(np.int64)
            valid = np.ones(windows, bool)
            first, last = np.searchsorted(self.ends, [begin + 1, begin + len(piece) - 1], "left")
            for e in (self.ends[first:last + 1] - begin).tolist():  # windows that cross a document's end
                valid[max(0, e - length + 1):max(0, e)] = False
            start = np.flatnonzero(valid)
            if not len(start):
                continue
            at = at[start]
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            s1, s2, p = start[new], start[np.append(new[1:], len(start)) - 1], at[new]
            yield (s1 + begin, s2 + begin, p + begin, np.searchsorted(self.ends, s1 + begin, "right"),
                   h[p] >> np.uint64(17))


def keys_of(data: bytes, s1: np.ndarray, s2: np.ndarray, p: np.ndarray, length: int) -> Iterator[bytes]:
    """Sort keys: the suffix from the anchor, the bytes before it reversed, their number."""
    for a, b, c in zip(s1.tolist(), (s2 + length).tolist(), p.tolist()):
        yield data[c:b] + data[a:c][::-1] + bytes((c - a,))


def one_by_one(s1: np.ndarray, s2: np.ndarray, p: np.ndarray, doc: np.ndarray,
               hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of windows with those of hot grams cut into single windows, and which."""
    windows = np.where(hot, s2 - s1 + 1, 1)
    row = np.repeat(np.arange(len(s1)), windows)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = s1[row] + nth
    return first, np.where(hot[row], first, s2[row]), p[row], doc[row], hot[row]


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


# --- front coding and the loser tree -----------------------------------------------------

def front_coded(keys: list[bytes], ids: list[int], flags: list[int]) -> bytes:
    lens = np.array([len(k) for k in keys], np.uint8)
    width = int(lens.max())
    rows = np.array(keys, f"S{width}").view(np.uint8).reshape(len(keys), width)
    same = np.ones((len(keys), width + 1), bool)
    same[1:, :width] = rows[1:] == rows[:-1]
    same[:, width] = False
    common = same.argmin(1)
    common[0] = 0
    common[1:] = np.minimum(common[1:], np.minimum(lens[1:], lens[:-1]))
    rest = b"".join([k[c:] for k, c in zip(keys, common.tolist())])
    return _packed(common.astype(np.uint8), lens, np.array(ids, "<i8"), np.array(flags, np.uint8),
                   np.frombuffer(rest, np.uint8))


def entries_of(blob: bytes, run: int) -> Iterator[Entry]:
    common, lens, ids, flags, rest = _unpacked(blob, "u1", "u1", "<i8", "u1", "u1")
    rest, at, key = rest.tobytes(), 0, b""
    for c, n, doc, flag in zip(common.tolist(), lens.tolist(), ids.tolist(), flags.tolist()):
        key = key[:c] + rest[at:at + n - c]
        at += n - c
        yield c, key, doc, flag, run


def _common_from(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two keys that agree on the first ``at`` bytes."""
    end = min(len(a), len(b))
    while at < end and a[at:at + 8] == b[at:at + 8]:
        at += 8
    if at >= end:
        return end
    while at < end and a[at] == b[at]:
        at += 1
    return at


def merge(streams: list[Iterator[Entry]]) -> Iterator[Entry]:
    """Merges sorted streams; the first field of each entry that comes out is its common
    prefix with the one before. An ended stream plays None, which loses every match."""
    while len(streams) > MAX_STREAMS:
        streams = [iter(list(merge(streams[i:i + MAX_STREAMS]))) for i in range(0, len(streams), MAX_STREAMS)]
    size = 1
    while size < len(streams):
        size *= 2
    players: list[Entry | None] = [next(s, None) for s in streams] + [None] * (size - len(streams))
    shared = [0] * size  # of each player, with the last winner that it met
    losers = [0] * size

    def play(node: int) -> int:
        """Winner of the subtree at a node: all players start without known prefixes."""
        if node >= size:
            return node - size
        one, two = play(2 * node), play(2 * node + 1)
        a, b = players[one], players[two]
        if a is None or b is None:
            losers[node] = two if b is None else one
            return one if b is None else two
        common = _common_from(a[1], b[1], 0)
        if a[1][common:common + 1] <= b[1][common:common + 1]:
            losers[node], shared[two] = two, common
            return one
        losers[node], shared[one] = one, common
        return two

    winner = play(1) if size > 1 else 0
    shared[winner] = 0
    while (best := players[winner]) is not None:
        yield (shared[winner], *best[1:])
        player = players[winner] = next(streams[winner], None)
        if player is not None:
            shared[winner] = player[0]
        node = (winner + size) >> 1
        while node:
            rival = losers[node]
            other = players[rival]
            if other is not None:
                if player is None or shared[rival] > shared[winner]:
                    losers[node], winner, player = winner, rival, other
                elif shared[rival] == shared[winner]:
                    a, b, at = player[1], other[1], shared[winner]
                    common = _common_from(a, b, at)
                    if a[common:common + 1] <= b[common:common + 1]:
                        shared[rival] = common
                    else:
                        shared[winner] = common
                        losers[node], winner, player = winner, rival, other
            node >>= 1


# --- which windows have a smaller id elsewhere -------------------------------------------

def smallest_ids(merged: Iterator[Entry], length: int) -> Iterator[tuple[int, bytes, int, int, int, int]]:
    """run, key, flags, first and last left reach, smallest id: windows of a run's entry that
    start that many bytes before the anchor and whose smallest id is below one of the run's
    own."""
    group: list[tuple[bytes, list[tuple[int, int, int]]]] = []  # keys with one anchor gram, and their holders

    def settle() -> Iterator[tuple[int, bytes, int, int, int, int]]:
        if len(group) == 1:
            key, holders = group[0]
            if len(holders) > 1 or holders[0][2] & SEVERAL:
                least = min(h[1] for h in holders)
                for run, doc, flags in holders:
                    if flags & SEVERAL or doc > least:
                        yield run, key, flags, 0, length, least
            return
        parts = []  # bytes before the anchor (nearest last), suffix from it, smallest id, holders
        for key, holders in group:
            cut = len(key) - 1 - key[-1]
            parts.append((key[cut:-1][::-1], key[:cut], min(h[1] for h in holders), key, holders))
        open_spans: dict[tuple[int, bytes], list[int]] = {}
        for reach in range(length - GRAM + 1):  # one reach at a time: windows of one are held at once
            least_of: dict[bytes, int] = {}
            windows = []
            for left, right, least, key, holders in parts:
                if reach <= len(left) and length - reach <= len(right):
                    w = left[len(left) - reach:] + right[:length - reach]
                    windows.append((w, key, holders))
                    if least < least_of.get(w, NO_ID + 1):
                        least_of[w] = least
            for w, key, holders in windows:
                least = least_of[w]
                for run, doc, flags in holders:
                    if flags & SEVERAL or doc > least:
                        span = open_spans.get((run, key))
                        if span and span[1] == reach - 1 and span[2] == least:
                            span[1] = reach
                            continue
                        if span:
                            yield run, key, flags, *span[:3]
                        open_spans[run, key] = [reach, reach, least, flags]
        for (run, key), span in open_spans.items():
            yield run, key, span[3], *span[:3]

    for common, key, doc, flags, run in merged:
        if group and common < GRAM:
            yield from settle()
            group.clear()
        if group and group[-1][0] == key:
            group[-1][1].append((run, doc, flags))
        else:
            group.append((key, [(run, doc, flags)]))
    if group:
        yield from settle()


# --- the distributed steps ---------------------------------------------------------------

def _rows(schema: dict, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_pydict({name: pa.array(c, kind) for (name, kind), c in zip(schema.items(), columns)})


_TO_BUCKET = {"bucket": pa.int32(), "run": pa.int64(), "blob": pa.binary()}
_TO_RUN = {"run": pa.int64(), "blob": pa.binary()}


def write_runs(docs: DataFrame, name: str) -> DataFrame:
    """Runs of documents (run, blob) as a table bucketed by run."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        run = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode("utf-8", "replace")
                if held and held + len(data) > RUN_BYTES:
                    yield _rows(_TO_RUN, [(run, Run.blob(ids, texts))])
                    run, held = run + 1, 0
                    ids.clear(), texts.clear()
                ids.append(NO_ID if doc is None else doc)
                texts.append(data)
                held += len(data)
        if ids:
            yield _rows(_TO_RUN, [(run, Run.blob(ids, texts))])

    spark = docs.sparkSession
    folder = fresh_dir(spark, name)
    table = name.replace("-", "_") + "_" + folder[-12:]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE TABLE {table} (run BIGINT, blob BINARY) USING parquet "
              f"CLUSTERED BY (run) INTO {buckets} BUCKETS LOCATION '{folder}'")
    id_and_text(docs).mapInArrow(cut, "run long, blob binary").write.insertInto(table)
    return spark.table(table)


def _with_messages(runs: DataFrame, messages: DataFrame) -> DataFrame:
    """Each run with the blobs sent to it (a run's messages are about as large as its text)."""
    sent = messages.groupBy("run").agg(F.collect_list("blob").alias("messages"))
    return runs.join(sent.hint("merge"), "run", "left")


def _by_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "run")


def _buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, bytes]]]:
    """The (run, blob) rows of one bucket after another."""
    bucket, rows = None, []
    for batch in batches:
        for b, run, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "run", "blob"))):
            if b != bucket and rows:
                yield rows
                rows = []
            bucket = b
            rows.append((run, blob))
    if rows:
        yield rows


def _six_bytes(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six_bytes(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = data.reshape(-1, 6)
    return out.view("<u8").ravel()


def repeated_grams(runs: DataFrame, buckets: int, length: int) -> DataFrame:
    """(run, blob): hashes of the run's anchor grams that occur in two documents or more,
    and whether they are hot."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, blob in zip(batch.column("run").to_pylist(), batch.column("blob")):
                r = Run(blob.as_py())
                grams, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for _, _, _, doc, gram in r.anchors(length):
                    grams.append(gram)
                    docs.append(doc)
                gram, doc = np.concatenate(grams), np.concatenate(docs)
                order = np.argsort(gram, kind="stable")  # the documents of a gram stay ascending
                gram, doc = gram[order], doc[order]
                new = np.flatnonzero(np.concatenate([np.ones(min(1, len(gram)), bool), gram[1:] != gram[:-1]]))
                last = np.append(new[1:], len(gram)) - 1
                value = gram[new] << np.uint64(1) | (doc[new] != doc[last[:len(new)]]).astype(np.uint64)
                bucket = (gram[new] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
                times = (last[:len(new)] - new + 1).astype("<u4")
                yield _rows(_TO_BUCKET, [(b, run, _packed(_six_bytes(value[order[i:j]]), times[order[i:j]]))
                                         for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:])) if j > i])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _buckets_of(batches):
            parts = [_unpacked(blob, "u1", "<u4") for _, blob in rows]
            sent = [_from_six_bytes(values) for values, _ in parts]
            value = np.concatenate(sent)
            gram, at, runs_with = np.unique(value >> np.uint64(1), return_inverse=True, return_counts=True)
            several = np.bincount(at, value & np.uint64(1), len(gram)) > 0
            hot = np.bincount(at, np.concatenate([times for _, times in parts]), len(gram)) > HOT_GRAM
            use = (runs_with > 1) | several
            repeated, answers = gram[use], gram[use] << np.uint64(1) | hot[use].astype(np.uint64)
            out = []
            for (run, _), own in zip(rows, sent):
                own = own >> np.uint64(1)
                own = own[_member(own, repeated)]
                if len(own):
                    out.append((run, _packed(_six_bytes(answers[np.searchsorted(repeated, own)]))))
            yield _rows(_TO_RUN, out)

    sent = runs.mapInArrow(send, "bucket int, run long, blob binary")
    return materialize(_by_bucket(sent, buckets).mapInArrow(answer, "run long, blob binary"), "suffix-grams")


def smaller_elsewhere(runs: DataFrame, grams: DataFrame, buckets: int, length: int) -> DataFrame:
    """(run, blob): entries of the run that a smaller id has too (gram hash, 128-bit key hash,
    flags, first and last reach, smallest id)."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, blob, sent in zip(batch.column("run").to_pylist(), batch.column("blob"), batch.column("messages")):
                messages = sent.as_py()
                if not messages:
                    continue
                r = Run(blob.as_py())
                told = np.sort(np.concatenate([_from_six_bytes(_unpacked(m, "u1")[0]) for m in messages]))
                repeated, hot = told >> np.uint64(1), told[(told & np.uint64(1)) == 1] >> np.uint64(1)
                single: set[bytes] = set()  # keys of hot grams
                least: dict[bytes, int] = {}
                several: set[bytes] = set()
                data = r.data.tobytes()
                for s1, s2, p, doc, gram in r.anchors(length):
                    use = _member(gram, repeated)
                    s1, s2, p, doc, one = one_by_one(s1[use], s2[use], p[use], doc[use], _member(gram[use], hot))
                    for key, d, h in zip(keys_of(data, s1, s2, p, length), r.ids[doc].tolist(), one.tolist()):
                        if h:
                            single.add(key)
                        before = least.setdefault(key, d)
                        if before != d:
                            several.add(key)
                            if d < before:
                                least[key] = d
                parts: dict[int, list[bytes]] = {}
                for key in sorted(least):
                    parts.setdefault(zlib.crc32(key if key in single else key[:GRAM]) % buckets, []).append(key)
                for b, keys in parts.items():
                    yield _rows(_TO_BUCKET, [(b, run, front_coded(
                        keys, [least[k] for k in keys],
                        [SEVERAL * (k in several) + HOT * (k in single) for k in keys]))])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for rows in _buckets_of(batches):
            streams = [entries_of(blob, run) for run, blob in rows]
            out: dict[int, list[tuple]] = {}
            for run, *found in smallest_ids(merge(streams), length):
                out.setdefault(run, []).append(found)
            messages = []
            for run, found in out.items():
                grams = np.frombuffer(b"".join(k[:GRAM] for k, *_ in found), np.uint8)
                messages.append((run, _packed(
                    gram_hashes(grams)[::GRAM] >> np.uint64(17),
                    *np.frombuffer(b"".join(digest(k) for k, *_ in found), "<u8").reshape(-1, 2).T.copy(),
                    *[np.array([x[i] for x in found], np.uint8) for i in (1, 2, 3)],
                    np.array([x[4] for x in found], "<i8"))))
            yield _rows(_TO_RUN, messages)

    sent = _with_messages(runs, grams).mapInArrow(send, "bucket int, run long, blob binary")
    return materialize(_by_bucket(sent, buckets).mapInArrow(answer, "run long, blob binary"), "suffix-answers")


def marked(runs: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start and length of each maximal removed
    stretch, in bytes) and kept (the remaining bytes)."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for blob, sent in zip(batch.column("blob"), batch.column("messages")):
                r, messages = Run(blob.as_py()), sent.as_py()
                edges = np.zeros(len(r.data) + 1, np.int32)
                if messages:
                    parts = [_unpacked(m, "<u8", "<u8", "<u8", "u1", "u1", "u1", "<i8") for m in messages]
                    grams = np.unique(np.concatenate([x[0] for x in parts]))
                    hot = np.unique(np.concatenate([x[0][x[3] & HOT > 0] for x in parts]))
                    told: dict[bytes, list[tuple[int, int, int]]] = {}
                    for _, begin, end, _, one, last, ids in parts:
                        keys = np.stack([begin, end], axis=1).view("V16").ravel()
                        for k, *span in zip(keys.tolist(), one.tolist(), last.tolist(), ids.tolist()):
                            told.setdefault(k, []).append(tuple(span))
                    data = r.data.tobytes()
                    begins, ends = [], []
                    for s1, s2, p, doc, gram in r.anchors(length):
                        use = _member(gram, grams)
                        s1, s2, p, doc, _ = one_by_one(s1[use], s2[use], p[use], doc[use], _member(gram[use], hot))
                        for key, a, b, c, d in zip(keys_of(data, s1, s2, p, length), s1.tolist(), s2.tolist(),
                                                   p.tolist(), r.ids[doc].tolist()):
                            for one, last, least in told.get(digest(key), ()):
                                if d > least:
                                    begins.append(max(a, c - last))
                                    ends.append(min(b, c - one) + length)
                    np.add.at(edges, begins, 1)
                    np.add.at(edges, ends, -1)
                gone = np.cumsum(edges[:-1]) > 0
                yield _documents(r, gone)

    def _documents(r: Run, gone: np.ndarray) -> pa.RecordBatch:
        starts = np.concatenate([[0], r.ends[:-1]]) if len(r.ends) else r.ends
        spans, kept = [], []
        for a, b in zip(starts.tolist(), r.ends.tolist()):
            own = gone[a:b]
            if own.any():
                turns = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                spans.append([{"start": x, "length": y - x} for x, y in turns.reshape(-1, 2).tolist()])
                kept.append(r.data[a:b][~own].tobytes())
            else:
                spans.append([])
                kept.append(r.data[a:b].tobytes())
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(r.ids, pa.int64(), mask=r.ids == NO_ID), "n_bytes": pa.array(r.ends - starts, pa.int64()),
            "spans": pa.array(spans, span_type), "kept": pa.array(kept, pa.binary())})

    return _with_messages(runs, answers).select("blob", "messages").mapInArrow(
        mark, "doc_id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Finds and cuts the repeated strings of ``docs``; see :func:`marked` for the columns."""
    if not GRAM < length <= 120:
        raise ValueError(f"strings of {GRAM + 1} to 120 bytes")
    spark: SparkSession = docs.sparkSession
    runs = write_runs(docs, "suffix-runs")
    buckets = max(1, runs.select("run").count())
    grams = repeated_grams(runs, buckets, length)
    answers = smaller_elsewhere(runs, grams, buckets, length)
    return marked(runs, answers, length)


def with_digest(result: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return result.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
                         .alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                         F.sha2("kept", 256).alias("kept_sha256"))
