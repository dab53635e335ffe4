"""Change history in the stream: one row per change, emitted in the micro-batch that brings the change.

The asset query (``streaming.job``) emits one row per key and micro-batch. Here every change of a
table gives the joined table row that holds right after it (J1, J2, T5, T6), by a custom stateful operator
whose state is what is known of each table and its live partitions. A removed partition leaves the state at
once (T4).

A call of the operator takes the changes of one bucket of tables, of all its tables at once: a call per table costs
more than the table's changes. A bucket's state is a map of places, each holding its tables with up to
``KEPT`` live partitions each, so a micro-batch reads and writes the places it touches and not the bucket; the
partitions of a table that had more are rows of a map of their own, read and written one by one.

Changes are taken in the order of ``operators.history`` within a micro-batch and in the order of
arrival across micro-batches, so a feed in log order gives the rows of ``table_asset_versions``
of the batch job, however it is cut. A change that arrives after later ones of its table keeps its own
position and counts from there on.

All changes of one bucket in one micro-batch are sorted in one task, as narrow rows: the source's
limit per trigger bounds them. The rows go to a file sink that writes each micro-batch once, so a replay
adds none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from assetlens.operators.facts import ATTRS, not_delete
from assetlens.plans.compaction import tagged_changes
from assetlens.session import use_rocksdb

DESCRIBED, PLACED, COUNTED, IGNORED = 0, 1, 2, -1  # side of a change, as in operators.history
TEXTS = ("table_name", "namespace", "domain", "creator", "op")
SUMS = ("partition_counts", "file_counts", "file_total_size")
SEEN = ("described", "placed", "counted")
# Fixed for the life of a checkpoint: where a table's state is follows from them.
BUCKETS, PLACES = 1 << 11, 1 << 4
KEPT = 32  # live partitions that a table keeps in its place
FIELDS = ("table_id", *TEXTS, *SUMS, *SEEN, "partitions", "spread")
NEW = (None,) * 5 + (0,) * 3 + (False,) * 3 + ((), False)  # of a table that nothing is known of
KNOWN = ", ".join([f"{f} array<string>" for f in ("table_id", *TEXTS)] + [f"{f} array<long>" for f in SUMS]
                  + [f"{f} array<boolean>" for f in SEEN] + ["partitions array<array<string>>", "spread array<boolean>"])
VERSIONS = ("table_id string, seq long, side int, table_name string, namespace string, domain string, creator string, "
            "op string, partition_counts long, file_counts long, file_total_size long")


def changes_of(tagged: DataFrame) -> DataFrame:
    """Tagged changes (``plans.compaction``) as input of the operator; a change that counts nothing keeps its
    row with side -1 (a filter here would be pushed below the fold of the file ops). Every column of every row is a
    Python object on the way in, so there are few: ``mark`` is place, side and whether live, ``detail`` the
    description as JSON, the partition or the commit's id."""
    kind, zero = F.col("kind"), F.lit(0).cast("bigint")
    live = not_delete(F.col("commit_op"))
    side = (F.when(kind == "t", DESCRIBED).when(kind == "p", PLACED)
            .when((kind == "c") & F.col("d_files").isNotNull(), COUNTED).otherwise(IGNORED))
    described = F.to_json(F.struct(*[F.col(a).alias(t) for a, t in zip(ATTRS, TEXTS)], F.col("commit_op").alias("op")))
    detail = F.when(kind == "t", described).when(kind == "p", F.col("sub_key")).otherwise(F.coalesce("commit_id", F.lit("")))
    hashed = F.xxhash64("table_id")
    place = F.pmod(F.shiftright(hashed, BUCKETS.bit_length() - 1), F.lit(PLACES))
    return tagged.select(
        F.pmod(hashed, F.lit(BUCKETS)).cast("int").alias("bucket"),
        ((place * 4 + side + 1) * 2 + F.coalesce(live, F.lit(False)).cast("int")).cast("int").alias("mark"),
        "table_id", "seq", detail.alias("detail"),
        F.coalesce("d_files", zero).alias("file_counts"), F.coalesce("d_bytes", zero).alias("file_total_size"))


Columns = dict[str, np.ndarray]


def unpacked(rows: pd.DataFrame) -> Columns:
    """The rows of ``changes_of`` that count, with ``place``, ``side`` and ``live``, and the texts of the descriptions."""
    mark = rows["mark"].to_numpy()
    side = mark // 2 % 4 - 1
    counts = side != IGNORED
    changes = {"place": mark // 8, "side": side, "live": mark % 2 == 1}
    for name, kind in (("table_id", object), ("seq", np.int64), ("detail", object), ("file_counts", np.int64),
                       ("file_total_size", np.int64)):
        changes[name] = rows[name].to_numpy(dtype=kind)
    changes = {name: column[counts] for name, column in changes.items()}
    at = np.flatnonzero(changes["side"] == DESCRIBED)
    said = [json.loads(text) for text in changes["detail"][at]]
    for name in TEXTS:
        changes[name] = np.full(len(changes["side"]), None, dtype=object)
        changes[name][at] = [row.get(name) for row in said]
    return changes


def _row_of(side: int, live: bool, detail: str, *attrs: str | None) -> str:
    """Tells changes of a side at one position apart, as in ``operators.history``; a delete comes last."""
    if side == DESCRIBED:
        return "/".join(["false" if live else "true", *(a for a in attrs if a is not None)])
    return f"{detail}/{int(not live)}" if side == PLACED else detail


def _in_order(changes: Columns) -> tuple[Columns, np.ndarray, np.ndarray]:
    """The changes table by table in the order of the log, the number of each one's table, and the tables' ids."""
    table, names = pd.factorize(changes["table_id"])
    keys = [changes["side"], changes["seq"], table]
    order = np.lexsort(keys)
    if np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys]).any():  # the rows tell ties apart
        rows = [_row_of(*row) for row in zip(*[changes[c] for c in ("side", "live", "detail", *TEXTS[:-1])])]
        order = np.lexsort([np.unique(np.array(rows, dtype=object), return_inverse=True)[1], *keys])
    return {name: column[order] for name, column in changes.items()}, table[order], names


def _last(marked: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each row the number of the last marked row of its table up to it, -1 before the first."""
    last = np.maximum.accumulate(np.where(marked, np.arange(len(marked)), -1))
    return np.where(last >= begin, last, -1)


class TableVersions(StatefulProcessor):
    """The history of the tables of a bucket, one row per change once all three sides of its table are known."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "place int", KNOWN)
        self.partitions = handle.getMapState("partitions", "table_id string, partition_desc string", "live boolean")

    def load(self, names: np.ndarray, places: np.ndarray) -> tuple[dict[str, list], list[int], np.ndarray]:
        """The tables of the touched places, ``names`` among them, by field; the place of each; and where each
        of ``names`` is among them."""
        held, place_of = {field: [] for field in FIELDS}, []
        if self.known.exists():
            for place in np.unique(places).tolist():
                entry = self.known.getValue((place,))
                if entry is not None:
                    for column, values in zip(held.values(), entry):
                        column.extend(values)
                    place_of.extend([place] * len(entry[0]))
        at = {name: number for number, name in enumerate(held["table_id"])}
        for name, place in zip(names, places.tolist()):
            if name not in at:
                at[name] = len(place_of)
                place_of.append(place)
                for column, value in zip(held.values(), (name, *NEW)):
                    column.append(value)
        return held, place_of, np.array([at[name] for name in names], np.int64)

    def save(self, held: dict[str, list], place_of: list[int]) -> None:
        members: dict[int, list[int]] = {}
        for number, place in enumerate(place_of):
            members.setdefault(place, []).append(number)
        for place, numbers in members.items():
            self.known.updateValue((place,), tuple([column[n] for n in numbers] for column in held.values()))

    def partition_steps(self, changes: Columns, table: np.ndarray, names: np.ndarray, held: dict[str, list],
                        at: np.ndarray) -> np.ndarray:
        """+1, 0 or -1 of each change, and the state brought up to date: it holds live partitions only."""
        steps = np.zeros(len(table), np.int64)
        placed = np.flatnonzero(changes["side"] == PLACED)
        if not len(placed):
            return steps
        touched = np.unique(table[placed])
        kept = [held["partitions"][n] for n in at[touched]]
        spread = np.array([held["spread"][n] for n in at], bool)
        named = np.array([*changes["detail"][placed], *(d for k in kept for d in k)], dtype=object)
        number, descs = pd.factorize(named)
        number = number.astype(np.int64) + np.append(table[placed], np.repeat(touched, [len(k) for k in kept])) * len(descs)
        pair, lived = number[:len(placed)], number[len(placed):]  # table and partition as one number
        order = np.argsort(pair, kind="stable")
        live = changes["live"][placed].astype(np.int64)[order]
        first = np.append(True, np.diff(pair[order]) != 0)
        pairs = pair[order][first]
        owner, before = pairs // len(descs), np.isin(pairs, lived)
        apart = np.flatnonzero(spread[owner])
        for i in apart:
            before[i] = self.partitions.containsKey((names[owner[i]], descs[pairs[i] % len(descs)]))
        was = np.append(0, live[:-1])
        was[first] = before
        steps[placed[order]] = live - was
        after = live[np.append(first[1:], True)] > 0
        for i in apart[after[apart] != before[apart]]:
            row = (names[owner[i]], descs[pairs[i] % len(descs)])
            if after[i]:
                self.partitions.updateValue(row, (True,))
            else:
                self.partitions.removeKey(row)
        stay = np.sort(np.append(lived[~np.isin(lived, pairs)], pairs[after & ~spread[owner]]))
        ends = np.searchsorted(stay, np.append(touched, touched + 1) * len(descs))
        for t, lo, hi in zip(touched, ends[:len(touched)], ends[len(touched):]):
            if spread[t]:
                continue
            now = descs[stay[lo:hi] % len(descs)].tolist()
            if len(now) > KEPT:
                held["spread"][at[t]] = True
                for desc in now:
                    self.partitions.updateValue((names[t], desc), (True,))
                now = []
            held["partitions"][at[t]] = now
        return steps

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        changes = unpacked(pd.concat(list(rows), ignore_index=True))
        if not len(changes["side"]):
            return
        changes, table, names = _in_order(changes)
        first = np.searchsorted(table, np.arange(len(names)))  # row of each table, and of the table of each row
        begin, end = first[table], np.append(first[1:], len(table)) - 1
        held, place_of, at = self.load(names, changes["place"][first])
        side, live = changes["side"], changes["live"]
        out = {"table_id": names[table], "seq": changes["seq"], "side": side.astype(np.int32)}
        described = _last((side == DESCRIBED) & live, begin), _last(side == DESCRIBED, begin)
        for name in TEXTS:
            last, own = described[name == "op"], changes[name]
            out[name] = np.where(last >= 0, own[last], np.array([held[name][n] for n in at], dtype=object)[table])
        steps = {"partition_counts": self.partition_steps(changes, table, names, held, at)}
        for name in SUMS[1:]:
            steps[name] = np.where(side == COUNTED, changes[name], 0)
        for name, step in steps.items():
            sums, known = np.cumsum(step), np.array([held[name][n] for n in at], np.int64)
            out[name] = known[table] + sums - (sums - step)[begin]
        seen = {}
        for number, name in enumerate(SEEN):
            seen[name] = np.array([held[name][n] for n in at], bool)[table] | (_last(side == number, begin) >= 0)
        for name, values in [*((name, out[name]) for name in (*TEXTS, *SUMS)), *seen.items()]:
            column = held[name]
            for n, value in zip(at.tolist(), values[end].tolist()):
                column[n] = None if name in TEXTS and pd.isna(value) else value
        self.save(held, place_of)
        complete = np.logical_and.reduce(list(seen.values()))
        if complete.any():
            yield pd.DataFrame({name: values[complete] for name, values in out.items()})


def table_versions(decoded_stream: DataFrame, qualify_ids: bool = False) -> DataFrame:
    """The stream of versions (columns ``VERSIONS``) of a decoded change feed."""
    return changes_of(tagged_changes(decoded_stream, qualify_ids)).groupBy("bucket").transformWithStateInPandas(
        TableVersions(), outputStructType=VERSIONS, outputMode="Append", timeMode="None")


def start_versions(decoded_stream: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                   qualify_ids: bool = False):
    """Starts the query that appends every version to ``base/table_asset_versions`` (exactly-once file sink)."""
    use_rocksdb(decoded_stream.sparkSession)
    return (table_versions(decoded_stream, qualify_ids).writeStream.format("parquet").outputMode("append")
            .option("path", f"{base}/table_asset_versions").option("checkpointLocation", f"{checkpoint}/versions")
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def read_versions(spark: SparkSession, base: str) -> DataFrame:
    """What the query has written so far."""
    return spark.read.schema(VERSIONS).parquet(f"{base}/table_asset_versions")
