"""First deliveries of a stream that repeats changes, with state that does not grow with the log.

Positions of an origin (a topic partition for feed offsets, else the log itself) are cut into blocks of
``BLOCK``; the state of a block is the set of positions that are settled, as intervals, and the
hashes of the changes at the positions that are still open. A change at a settled position is a repeat; one at
an open position is a repeat if its hash (``with_position``) is there. When a position is settled:

* a feed offset holds one record, so it is settled as soon as it was seen;
* otherwise, once the next position was seen too: changes of one position are delivered before, or in the
  same micro-batch as, the next one's. Contiguous positions so collapse to one interval, and hashes
  are kept at the edges of gaps only, where late changes may still come in any order;
* with ``ascending`` (positions with gaps of their own, as byte addresses of a log have, delivered in ascending
  order but for repeats): once any higher position of the block was seen.

Snapshot rows (operation ``read``), changes without position and broken envelopes have no place in
the log: their hashes are kept, dealt over ``BUCKETS`` groups; they are as many as the catalog has rows, not
as many as the log has changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from assetlens.schemas import OP_READ
from assetlens.session import use_rocksdb
from assetlens.sources.envelope import ORIGIN, POSITION, with_position

BLOCK = 1 << 14
BUCKETS = 1 << 12
OFFSETS, LOG, UNPLACED = 0, 1, 2  # kinds of group


def merged_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of closed intervals of integers, in order; adjacent ones become one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > ends[:-1] + 1
    return starts[first], ends[np.append(first[1:], True)] if len(ends) else ends


def inside(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each value lies in one of the ordered, disjoint intervals."""
    if not len(starts):
        return np.zeros(len(values), bool)
    at = np.searchsorted(starts, values, side="right") - 1
    return (at >= 0) & (values <= ends[np.maximum(at, 0)])


def newly_settled(kind: int, seen: np.ndarray, starts: np.ndarray, ascending: bool) -> np.ndarray:
    """Which of the open positions (ascending, distinct) are settled now."""
    if kind == OFFSETS:
        return np.ones(len(seen), bool)
    if ascending:
        return seen < max(seen.max(initial=-1), starts.max(initial=-1))
    return np.isin(seen + 1, seen) | np.isin(seen + 1, starts)


class FirstDeliveries(StatefulProcessor):
    """Lets the first delivery of each change through; key: kind, origin, block."""

    def __init__(self, ascending: bool) -> None:
        self.ascending = ascending

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.settled = handle.getValueState("settled", "starts array<long>, ends array<long>")
        self.open = handle.getMapState("open", "place long, hash string", "seen boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        kind = int(key[0])
        changes = pd.concat(list(rows), ignore_index=True).drop_duplicates(["place", POSITION], ignore_index=True)
        if kind == UNPLACED:
            hashes = changes[POSITION]
            new = np.array([not self.open.containsKey((0, h)) for h in hashes], bool)
            for h in hashes[new]:
                self.open.updateValue((0, h), (True,))
            if new.any():
                yield changes.loc[new, ["payload"]]
            return
        empty = np.zeros(0, np.int64)
        held = self.settled.get() if self.settled.exists() else (empty, empty)
        starts, ends = (np.array(part, np.int64) for part in held)
        was_open = {(int(place), h) for place, h in self.open.keys()}
        changes = changes[~inside(changes["place"].to_numpy(np.int64), starts, ends)]
        found = list(zip(changes["place"].tolist(), changes[POSITION]))
        new = np.array([pair not in was_open for pair in found], bool)
        now_open = was_open | set(found)
        seen = np.unique(np.array([place for place, _ in now_open], np.int64))
        done = seen[newly_settled(kind, seen, starts, self.ascending)]
        if len(done):
            if self.ascending and kind == LOG:  # what lies between is empty
                begin, end = [min([*done, *starts])], [max([*done, *ends])]
            else:
                begin, end = np.concatenate([starts, done]), np.concatenate([ends, done])
            starts, ends = merged_intervals(np.array(begin, np.int64), np.array(end, np.int64))
            self.settled.update((starts.tolist(), ends.tolist()))
        still = {pair for pair, out in zip(now_open, np.isin([p for p, _ in now_open], done)) if not out}
        for pair in was_open - still:
            self.open.removeKey(pair)
        for pair in still - was_open:
            self.open.updateValue(pair, (True,))
        if new.any():
            yield changes.loc[new, ["payload"]]


def first_deliveries(decoded_stream: DataFrame, ascending: bool = False) -> DataFrame:
    """The decoded changes of a stream, each once."""
    use_rocksdb(decoded_stream.sparkSession)
    schema = decoded_stream.schema
    origin = F.col(ORIGIN) if ORIGIN in decoded_stream.columns else F.lit(None).cast("string")
    placed = F.col("seq").isNotNull() & ~F.coalesce(F.col("commit_op") == OP_READ, F.lit(False))
    kind = F.when(~placed, UNPLACED).when(origin.isNotNull(), OFFSETS).otherwise(LOG)
    block = F.when(placed, F.floor(F.col("seq") / F.lit(BLOCK))).otherwise(F.pmod(F.xxhash64(POSITION), F.lit(BUCKETS)))
    keyed = with_position(decoded_stream).select(
        kind.alias("kind"), F.when(placed, F.coalesce(origin, F.lit(""))).otherwise("").alias("source"),
        block.cast("long").alias("block"), F.when(placed, F.col("seq")).otherwise(0).alias("place"), POSITION,
        F.to_json(F.struct(*decoded_stream.columns)).alias("payload"))
    once = keyed.groupBy("kind", "source", "block").transformWithStateInPandas(
        FirstDeliveries(ascending), outputStructType="payload string", outputMode="Append", timeMode="None")
    return once.select(F.from_json("payload", schema).alias("change")).select("change.*")
