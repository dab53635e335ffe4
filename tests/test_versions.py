"""Change history by the stateful operator: any cut of the feed gives the same rows; replays add none."""

import json
import os
import random
import tempfile

import pandas as pd
import pytest

from assetlens.sources import changelog
from assetlens.streaming import versions
from test_stream import _commit, _partition, _table

NOW = {"availableNow": True}


def _write(spark, base, batches):
    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/feed/part={i:03d}")
    return changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)


def _run(spark, stream, base):
    query = versions.start_versions(stream, f"{base}/out", f"{base}/chk", NOW)
    query.awaitTermination()
    assert query.exception() is None
    return _rows(spark, base)


def _rows(spark, base):
    rows = versions.read_versions(spark, f"{base}/out").select("seq", "namespace", "op", "partition_counts", "file_counts",
                                                               "file_total_size").collect()
    return sorted(map(tuple, rows))


CHANGES = [_table("a", "n1", 1), _partition("a", "p", 2), _partition("a", "q", 3), _commit("a", "c1", 4), _commit("a", "c2", 5),
           _partition("a", "p", 6), _partition("a", "p", 7, "delete"), _partition("a", "p", 8, "delete"), _table("a", "n2", 9, "update"),
           _partition("a", "p", 10), _commit("a", "c1", 11, op="delete"), _table("a", None, 12, "delete"),
           _commit("a", "bad", 13, ops=["bm8="])]
WANT = [(4, "n1", "create", 2, 1, 10), (5, "n1", "create", 2, 2, 20), (6, "n1", "create", 2, 2, 20), (7, "n1", "create", 1, 2, 20),
        (8, "n1", "create", 1, 2, 20), (9, "n2", "update", 1, 2, 20), (10, "n2", "update", 2, 2, 20), (11, "n2", "update", 2, 1, 10),
        (12, "n2", "delete", 2, 1, 10)]


@pytest.mark.parametrize("cuts", [(), (3, 6, 9), (1, 2, 7, 8, 11)])
def test_a_row_per_change_however_the_feed_is_cut(spark, cuts):
    base = tempfile.mkdtemp(prefix="versions-")
    parts = [CHANGES[a:b] for a, b in zip((0, *cuts), (*cuts, len(CHANGES)))]
    for part in parts:  # the order of lines in a micro-batch does not matter
        random.Random(3).shuffle(part)
    assert _run(spark, _write(spark, base, parts), base) == WANT


def test_replay_of_a_micro_batch_adds_no_row(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    stream = _write(spark, base, [CHANGES[:6], CHANGES[6:]])
    assert _run(spark, stream, base) == WANT
    for name in ("1", ".1.crc"):  # as a driver leaves it that died before the commit of the last micro-batch
        os.unlink(f"{base}/chk/versions/commits/{name}")
    assert _run(spark, stream, base) == WANT


def test_a_failed_micro_batch_is_done_again(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    stream = _write(spark, base, [CHANGES[:6], CHANGES[6:]])
    failing = stream.where("CASE WHEN seq > 6 THEN raise_error('lost') ELSE true END")
    query = versions.start_versions(failing, f"{base}/out", f"{base}/chk", NOW)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    assert _rows(spark, base) == WANT[:3]
    assert _run(spark, stream, base) == WANT


def test_removed_partitions_leave_the_state(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    added = [_partition("a", f"p{i}", 10 + i) for i in range(40)]
    removed = [_partition("a", f"p{i}", 100 + i, "delete") for i in range(39)]
    _run(spark, _write(spark, base, [added, removed]), base)
    state = spark.read.format("statestore").option("path", f"{base}/chk/versions").option("stateVarName", "partitions")
    assert [r["user_map_key"]["partition_desc"] for r in state.load().collect()] == ["p39"]


def test_a_session_with_no_state_store_of_its_own_gets_one_with_map_state(spark):
    plain, key = spark.newSession(), "spark.sql.streaming.stateStore.providerClass"
    plain.conf.unset(key)  # as a session is that sets nothing: Spark's default keeps no maps
    assert plain.conf.get(key).endswith("HDFSBackedStateStoreProvider")
    base = tempfile.mkdtemp(prefix="versions-")
    assert _run(plain, _write(plain, base, [CHANGES[:6], CHANGES[6:]]), base) == WANT


class _Map:
    """A map state in memory that counts its calls."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def _call(self, result):
        self.calls += 1
        return result

    def exists(self):
        return self._call(bool(self.rows))

    def getValue(self, key):
        return self._call(self.rows.get(key))

    def containsKey(self, key):
        return self._call(key in self.rows)

    def updateValue(self, key, value):
        self._call(self.rows.__setitem__(key, value))

    def removeKey(self, key):
        self._call(self.rows.__delitem__(key))


def _one_by_one(changes):
    """The rows after each change, and the live partitions: (table, seq, side, live, detail, files, bytes) in order."""
    out, known = [], {}
    for table, seq, side, live, detail, files, size in changes:
        k = known.setdefault(table, {"op": None, "attrs": [None] * 4, "parts": set(), "files": 0, "bytes": 0, "sides": set()})
        k["sides"].add(side)
        if side == versions.DESCRIBED:
            said = json.loads(detail)
            k["op"] = said["op"]
            k["attrs"] = [said.get(t) for t in versions.TEXTS[:-1]] if live else k["attrs"]
        elif side == versions.PLACED:
            (k["parts"].add if live else k["parts"].discard)(detail)
        else:
            k["files"], k["bytes"] = k["files"] + files, k["bytes"] + size
        if len(k["sides"]) == 3:
            out.append((table, seq, side, *k["attrs"], k["op"], len(k["parts"]), k["files"], k["bytes"]))
    return out, {(t, d) for t, k in known.items() for d in k["parts"]}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_a_call_takes_all_tables_of_a_bucket(parts):
    rnd = random.Random(parts)
    changes = []
    for seq in range(6000):
        table, side, live = f"t{min(rnd.randrange(240), 199)}", rnd.choice([0, 1, 1, 1, 2]), rnd.random() < 0.7
        text = json.dumps({"namespace": f"n{seq % 5}", "domain": "d", "op": "update" if live else "delete"}) if side == 0 \
            else f"p{rnd.randrange(90 if table == 't199' else 6)}"  # one table with many partitions
        changes.append((table, seq, side, live, text, *((rnd.choice([-1, 2]), 10) if side == 2 else (0, 0))))
    want, partitions = _one_by_one(changes)
    operator = versions.TableVersions()
    operator.known, operator.partitions = _Map(), _Map()
    got = []
    for part in range(parts):
        rows = [(7, (int(table[1:]) % versions.PLACES * 4 + side + 1) * 2 + live, table, seq, detail, files, size)
                for table, seq, side, live, detail, files, size in changes[part * 6000 // parts:(part + 1) * 6000 // parts]]
        rows += [(7, 1, "ignored", 0, "c", 0, 0)]
        rnd.shuffle(rows)
        frame = pd.DataFrame(rows, columns=["bucket", "mark", "table_id", "seq", "detail", "file_counts", "file_total_size"])
        for out in operator.handleInputRows((7,), iter([frame[:100], frame[100:]]), None):
            got += [tuple(None if v is None else v for v in row) for row in out.astype(object).itertuples(index=False)]
    assert sorted(got, key=lambda r: r[1]) == want
    assert operator.known.calls <= parts * (1 + 2 * versions.PLACES)  # not by the 200 tables
    held = [dict(zip(versions.FIELDS, entry)) for entry in operator.known.rows.values()]
    kept = {(t, d) for entry in held for t, ds in zip(entry["table_id"], entry["partitions"]) for d in ds}
    assert kept | set(operator.partitions.rows) == partitions and not kept & set(operator.partitions.rows)
    assert sum(len(entry["table_id"]) for entry in held) == 200
    assert {t for t, _ in operator.partitions.rows} == {"t199"}


def test_changes_at_one_position_are_told_apart_by_their_rows():
    operator = versions.TableVersions()
    operator.known, operator.partitions = _Map(), _Map()
    rows = [(0, 2 * (1 + side) + live, "t", 5, detail, 1, 1) for side, live, detail in (
        (2, 1, "c"), (1, 0, "p"), (1, 1, "p"), (1, 1, "o"), (0, 0, '{"op":"delete"}'), (0, 1, '{"namespace":"n","op":"create"}'))]
    out = pd.concat(operator.handleInputRows((0,), iter([pd.DataFrame(rows, columns=[
        "bucket", "mark", "table_id", "seq", "detail", "file_counts", "file_total_size"])]), None))
    assert out[["side", "namespace", "op", "partition_counts"]].values.tolist() == [[2, "n", "delete", 1]]


def test_the_cuts_of_a_feed_are_found_in_the_written_envelopes(spark):
    base = tempfile.mkdtemp(prefix="versions-")
    rows = spark.createDataFrame([(f"v{i}", i) for i in range(10)], "value string, seq long")
    seen = []

    def cuts(written):
        seen.append(len(written.inputFiles()))
        return [written.agg({"seq": "max"}).first()[0] // 2]
    parts = changelog.write_feed(rows, f"{base}/feed", cuts)
    assert seen[0] > 0  # of files, not of the rows they were made from
    assert [spark.read.text(p).count() for p in parts] == [5, 5]
