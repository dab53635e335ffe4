"""Streaming equals batch; sinks are replay-safe."""

import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from assetlens import registry
from assetlens.plans.batch import compute_assets, compute_assets_from_feed
from assetlens.schemas import NAMESPACE_LEVEL_ASSETS, TABLE_LEVEL_ASSETS, USER_LEVEL_ASSETS, to_result_schema
from assetlens.sinks import upsert
from assetlens.sinks.upsert import KeyedLog, jdbc_upsert_statement, merge_statement
from assetlens.sources import changelog
from assetlens.sources.envelope import decode_envelopes, with_position
from assetlens.sources import fixtures as fx
from assetlens.streaming import job
from conftest import SF_SMALL, b64


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_over_several_micro_batches(spark):
    env = fx.fx_envelopes(spark, SF_SMALL)
    base = tempfile.mkdtemp(prefix="stream-")
    parts = changelog.write_feed(env, f"{base}/feed", registry._seq_cuts(env, 3), files_per_part=2)
    assert len(parts) == 3
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=2)
    tables = job.run_available(stream, f"{base}/out", f"{base}/chk")
    # Three parts, one per trigger.
    assert tables.table_state.last_batch() == 2
    b = compute_assets(fx.fx_table_info(spark, SF_SMALL), fx.fx_partition_info(spark, SF_SMALL),
                       fx.fx_commit_changes(spark, SF_SMALL))
    assert _sorted(tables.table_level_assets()) == _sorted(
        to_result_schema(b.table_assets, TABLE_LEVEL_ASSETS))
    for level, want in (("namespace", b.namespace_assets), ("domain", b.domain_assets)):
        got = tables.level_assets(level)
        assert _sorted(got) == _sorted(to_result_schema(want, got.schema))
    assert _sorted(tables.level_assets("creator")) == _sorted(
        to_result_schema(b.user_assets, USER_LEVEL_ASSETS))
    feed = compute_assets_from_feed(changelog.read_changes(spark, f"{base}/feed/*"))
    quarantine = tables.quarantine()
    assert quarantine.where("commit_id is not null").count() == feed.quarantine.count() > 0
    assert quarantine.where("commit_id is null").count() == feed.rejects.count() > 0


def test_replayed_batch_changes_nothing(spark):
    base = tempfile.mkdtemp(prefix="sink-")
    t = KeyedLog(spark, os.path.join(base, "t"), TABLE_LEVEL_ASSETS, "table_id")
    row = spark.createDataFrame([("a", "A", "d", "u", "n", 1, 2, 3)], TABLE_LEVEL_ASSETS)
    assert t.upsert(row, 0)
    newer = spark.createDataFrame([("a", "A", "d", "u", "n", 5, 5, 5)], TABLE_LEVEL_ASSETS)
    assert not t.upsert(newer, 0)          # same batch id again: skipped
    assert _sorted(t.current()) == [("a", "A", "d", "u", "n", 1, 2, 3)]
    assert t.upsert(newer, 1)
    assert _sorted(t.current()) == [("a", "A", "d", "u", "n", 5, 5, 5)]


def test_upsert_freezes_attributes_on_request(spark):
    base = tempfile.mkdtemp(prefix="sink-")
    t = KeyedLog(spark, os.path.join(base, "t"), TABLE_LEVEL_ASSETS, "table_id")
    t.upsert(spark.createDataFrame([("a", "A", "d1", "u", "n", 1, 1, 1)], TABLE_LEVEL_ASSETS), 0)
    moved = spark.createDataFrame([("a", "A", "d2", "u", "n", 2, 2, 2),
                                   ("b", "B", "d3", "u", "n", 1, 1, 1)], TABLE_LEVEL_ASSETS)
    t.upsert(moved, 1, frozen=("table_name", "domain", "creator", "namespace"))
    assert _sorted(t.current()) == [("a", "A", "d1", "u", "n", 2, 2, 2),
                                    ("b", "B", "d3", "u", "n", 1, 1, 1)]


def test_upsert_keeps_last_row_per_key(spark):
    base = tempfile.mkdtemp(prefix="sink-")
    t = KeyedLog(spark, os.path.join(base, "t"), TABLE_LEVEL_ASSETS, "table_id")
    rows = spark.createDataFrame([("a", "A", "d", "u", "n", 1, 1, 1, 1),
                                  ("a", "A", "d", "u", "n", 2, 2, 2, 2)],
                                 T.StructType(TABLE_LEVEL_ASSETS.fields + [T.StructField("seq", T.LongType())]))
    t.upsert(rows, 0, order_by="seq")
    assert _sorted(t.current()) == [("a", "A", "d", "u", "n", 2, 2, 2)]


def _envelope(op, table, img, seq):
    import json
    before, after = (img, {}) if op == "delete" else ({}, img)
    return json.dumps({"commitOp": op, "tableName": table, "before": before, "after": after,
                       "seq": seq})


def test_stream_quarantine_freeze_and_replay(spark):
    from conftest import b64
    base = tempfile.mkdtemp(prefix="stream-small-")
    ti = {"table_id": "a", "table_name": "A", "domain": "d1", "creator": "u1"}
    first = [
        _envelope("create", "table_info", {**ti, "table_namespace": "n1"}, 1),
        _envelope("create", "partition_info", {"table_id": "a", "partition_desc": "p1"}, 2),
        _envelope("create", "data_commit_info", {"table_id": "a", "commit_id": "c1", "committed": True,
                                                 "file_ops": [b64('(f,add,10,"x")')]}, 3),
        _envelope("create", "data_commit_info", {"table_id": "a", "commit_id": "c2", "committed": True,
                                                 "file_ops": [b64("(g,add,4,x)")]}, 4),
    ]
    second = [_envelope("update", "table_info", {**ti, "table_namespace": "n2", "domain": "d2"}, 5)]
    for i, lines in enumerate((first, second)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.text(f"{base}/feed/part={i}")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)
    tables = job.run_available(stream, f"{base}/out", f"{base}/chk", freeze_attributes=True)
    assert tables.table_state.last_batch() == 1
    # The unparsable commit is quarantined, the other counted.
    q = tables.quarantine().collect()
    assert [(r["commit_id"], r["problem"]) for r in q] == [("c2", "unparsed_file_op")]
    # Frozen sink keeps the first attributes; the rollups follow the move.
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d1", "u1", "n1", 1, 1, 10)]
    assert _sorted(tables.level_assets("namespace")) == [("n1", 0, 0, 0, 0), ("n2", 1, 1, 1, 10)]
    assert _sorted(tables.level_assets("creator")) == [("u1", 2, 2, 1, 1, 1, 10)]
    # Replaying an applied micro-batch changes nothing.
    before = [_sorted(t.current()) for t in (tables.table_assets, tables.group_assets)]
    job.apply_batch(tables, tables.table_state.current().limit(0), 1)
    assert [_sorted(t.current()) for t in (tables.table_assets, tables.group_assets)] == before


def test_stream_partition_count_deltas_across_batches(spark):
    from conftest import b64
    base = tempfile.mkdtemp(prefix="stream-delta-")
    ti = {"table_id": "a", "table_name": "A", "table_namespace": "n1", "domain": "d1",
          "creator": "u1"}
    part = lambda op, d, s: _envelope(op, "partition_info", {"table_id": "a", "partition_desc": d}, s)
    batches = [
        [_envelope("create", "table_info", ti, 1), part("create", "p1", 2), part("create", "p2", 3),
         _envelope("create", "data_commit_info", {"table_id": "a", "commit_id": "c1", "committed": True,
                                                  "file_ops": [b64('(f,add,10,"x")')]}, 4)],
        [part("delete", "p1", 5), part("create", "p3", 6), part("update", "p2", 7)],
        [part("create", "p1", 8), part("delete", "p2", 9), part("delete", "p2", 10)],
    ]
    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.text(f"{base}/feed/part={i}")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)
    tables = job.run_available(stream, f"{base}/out", f"{base}/chk")
    assert tables.partition_state.last_batch() == 2
    # p1 re-created, p2 deleted, p3 live.
    assert _sorted(tables.partition_counts.current()) == [("a", 2)]
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d1", "u1", "n1", 2, 1, 10)]


def _run(spark, batches, **kw):
    """Each list of envelopes is one micro-batch."""
    base = tempfile.mkdtemp(prefix="stream-run-")
    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/feed/part={i}")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)
    return job.run_available(stream, f"{base}/out", f"{base}/chk", **kw), base


def _table(t, ns, seq, op="create"):
    return _envelope(op, "table_info", {"table_id": t, "table_name": t.upper(), "table_namespace": ns,
                                        "domain": "d", "creator": "u"}, seq)


def _partition(t, desc, seq, op="create"):
    return _envelope(op, "partition_info", {"table_id": t, "partition_desc": desc}, seq)


def _commit(t, cid, seq, size=10, op="create", ops=None):
    from conftest import b64
    return _envelope(op, "data_commit_info", {"table_id": t, "commit_id": cid, "committed": True,
                                              "file_ops": ops or [b64(f'(f,add,{size},"x")')]}, seq)


def test_tables_whose_sides_come_in_different_micro_batches(spark):
    tables, _ = _run(spark, [[_table("a", "n1", 1)], [_partition("a", "p", 2), _commit("a", "c", 3)]])
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d", "u", "n1", 1, 1, 10)]
    full = [_table("a", "n1", 1), _partition("a", "p", 2), _commit("a", "c", 3)]
    later = [[_table(t, "n2", 10 + i)] for i, t in enumerate("bcdefg")]
    rest = [[_partition(t, "p", 20 + i), _commit(t, "c", 30 + i)] for i, t in enumerate("gfedcb")]
    tables, _ = _run(spark, [full, *later, *rest])
    assert [r[0] for r in _sorted(tables.table_level_assets())] == list("abcdefg")
    assert _sorted(tables.level_assets("namespace")) == [("n1", 1, 1, 1, 10), ("n2", 6, 6, 6, 60)]


def test_moves_deletes_and_recreation_across_micro_batches(spark):
    start = [x for i, t in enumerate("abc") for x in
             (_table(t, "n1", i), _partition(t, "p", 10 + i), _commit(t, "c", 20 + i))]
    tables, _ = _run(spark, [start, [_table("a", "n2", 30, "update")], [_table("b", "n1", 31, "delete")],
                             [_table("a", "n3", 32, "update"), _table("c", "n2", 33, "update")],
                             [_table("b", "n2", 34)], [_commit("a", "c", 35, op="delete")]])
    assert _sorted(tables.level_assets("namespace")) == [("n1", 0, 0, 0, 0), ("n2", 2, 2, 2, 20), ("n3", 1, 1, 0, 0)]
    assert _sorted(tables.level_assets("creator")) == [("u", 1, 3, 3, 3, 2, 20)]


def test_fixture_moves_and_deletes_straddle_micro_batches(spark):
    env = fx.fx_envelopes(spark, SF_SMALL)
    cuts = registry._seq_cuts(env, 4)
    part = lambda s: sum(s > c for c in cuts)
    seen = {}
    for r in fx.fx_table_info(spark, SF_SMALL).collect():
        seen.setdefault(r["table_id"], []).append((r["seq"], r["commit_op"]))
    apart = {op: sum(1 for own in seen.values() for s, o in own if o == op and part(s) != part(min(own)[0]))
             for op in ("update", "delete")}
    assert apart["update"] >= 5 and apart["delete"] >= 3, apart


def test_quarantine_keeps_commits_without_an_id(spark):
    bad = [_commit("a", None, s, ops=["bm8="]) for s in (1, 2, 3)]
    tables, base = _run(spark, [bad[:2], [bad[2], _commit("a", "x", 4, ops=["bm8="])]])
    assert sorted((r["seq"], r["commit_id"]) for r in tables.quarantine().collect()) == [
        (1, None), (2, None), (3, None), (4, "x")]
    feed = compute_assets_from_feed(changelog.read_changes(spark, f"{base}/feed/*"))
    assert feed.quarantine.count() == 4


def test_new_checkpoint_on_an_old_output_folder_is_refused(spark):
    tables, base = _run(spark, [[_table("a", "n1", 1), _partition("a", "p", 2), _commit("a", "c", 3)]])
    stream = changelog.read_change_stream(spark, f"{base}/feed/*")
    with pytest.raises(Exception, match="was written by"):
        job.run_available(stream, f"{base}/out", f"{base}/other-chk")
    # The same checkpoint goes on.
    assert job.run_available(stream, f"{base}/out", f"{base}/chk").table_assets.last_batch() == 0


def _assets(spark, keys, n=1):
    return spark.createDataFrame([(k, "A", "d", "u", "n", n, 2, 3) for k in keys], TABLE_LEVEL_ASSETS)


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_a_one_key_change_writes_one_row_whatever_the_table_holds(spark):
    written = []
    for size in (10, 5000):
        base = tempfile.mkdtemp(prefix="sink-")
        t = KeyedLog(spark, f"{base}/t", TABLE_LEVEL_ASSETS, "table_id")
        t.upsert(_assets(spark, [f"k{i}" for i in range(size)]).repartition(7), 0)
        t.compact(0, 5 * upsert.BUCKET_BYTES)
        t.upsert(_assets(spark, ["k5"], 9), 1)
        written.append(_bytes(f"{base}/t/changes/batch=1"))
        assert t.current().count() == size
        keys = spark.createDataFrame([("k5",), ("k7",), ("none",)], "table_id string")
        assert [r["partition_counts"] for r in t.current(keys=keys).orderBy("table_id").collect()] == [9, 1]
        assert [r["partition_counts"] for r in t.current(0, keys).orderBy("table_id").collect()] == [1, 1]
    assert written[0] == written[1]


def test_new_bases_replace_what_they_fold_in(spark, monkeypatch):
    monkeypatch.setattr(upsert, "MOST_BATCHES", 3)
    base = tempfile.mkdtemp(prefix="sink-")
    t = KeyedLog(spark, f"{base}/t", TABLE_LEVEL_ASSETS, "table_id", forget="partition_counts = 0")
    for i in range(10):
        assert t.upsert(_assets(spark, ["a", f"b{i}"], i), i)
        t.maintain(i)  # folds what is before the running batch
    assert sorted(os.listdir(f"{base}/t/base")) == ["upto=5-buckets=1", "upto=8-buckets=1"]
    assert sorted(os.listdir(f"{base}/t/changes")) == [f"batch={i}" for i in (6, 7, 8, 9)]
    reopened = KeyedLog(spark, f"{base}/t", TABLE_LEVEL_ASSETS, "table_id")
    for table in (t, reopened):
        rows = _sorted(table.current().select("table_id", "partition_counts"))
        assert rows == [("a", 9)] + [(f"b{i}", i) for i in range(1, 10)]  # b0's row means no row
        assert not table.upsert(_assets(spark, ["a"], 77), 4) and table.last_batch() == 9
    with pytest.raises(ValueError, match="folded"):
        reopened.current(3)


def test_unfinished_batches_do_not_count(spark):
    base = tempfile.mkdtemp(prefix="sink-")
    t = KeyedLog(spark, f"{base}/t", TABLE_LEVEL_ASSETS, "table_id")
    t.upsert(_assets(spark, ["a"]), 0)
    _assets(spark, ["a", "b"], 5).write.parquet(f"{base}/t/changes/batch=1")
    os.unlink(f"{base}/t/changes/batch=1/_SUCCESS")  # as a job leaves it that died while committing
    again = KeyedLog(spark, f"{base}/t", TABLE_LEVEL_ASSETS, "table_id")
    assert again.last_batch() == 0 and again.current().count() == 1
    assert again.upsert(_assets(spark, ["a"], 7), 1)
    assert [r["partition_counts"] for r in again.current().collect()] == [7]


def test_a_failed_micro_batch_is_finished_by_its_replay(spark, monkeypatch):
    """The writes of the first attempt that got through are kept, deltas are not taken twice."""
    first = [_table("a", "n1", 1), _partition("a", "p", 2), _commit("a", "c", 3)]
    second = [_partition("a", "q", 4), _commit("a", "c2", 5), _table("a", "n2", 6, "update")]
    base = tempfile.mkdtemp(prefix="stream-run-")
    for i, lines in enumerate((first, second)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/feed/part={i}")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)
    plain = KeyedLog.upsert

    def failing(self, rows, batch_id, **kw):
        if batch_id == 1 and self.path.endswith("group_assets"):
            raise RuntimeError("lost")
        return plain(self, rows, batch_id, **kw)
    monkeypatch.setattr(KeyedLog, "upsert", failing)
    with pytest.raises(Exception, match="lost"):
        job.run_available(stream, f"{base}/out", f"{base}/chk")
    monkeypatch.setattr(KeyedLog, "upsert", plain)
    tables = job.run_available(stream, f"{base}/out", f"{base}/chk")
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d", "u", "n2", 2, 2, 20)]
    assert _sorted(tables.level_assets("namespace")) == [("n1", 0, 0, 0, 0), ("n2", 1, 2, 2, 20)]


def test_removed_partitions_leave_the_state(spark, monkeypatch):
    monkeypatch.setattr(upsert, "MOST_BATCHES", 1)
    full = [_table("a", "n1", 1), _commit("a", "c", 2), *[_partition("a", f"p{i}", 10 + i) for i in range(6)]]
    gone = [_partition("a", f"p{i}", 20 + i, "delete") for i in range(5)]
    tables, _ = _run(spark, [full, gone, [_commit("a", "d", 30)], [_commit("a", "e", 31)], [_partition("a", "p0", 40)]])
    assert _sorted(tables.partition_state.current().where("NOT deleted").select("partition_desc")) == [("p0",), ("p5",)]
    assert tables.partition_state.current().count() == 2  # the five removed ones are in no base
    assert _sorted(tables.partition_counts.current()) == [("a", 2)]


def test_each_commit_counts_once_across_micro_batches(spark):
    """Updates, deletes, repeats and re-creations of a commit in other micro-batches than its creation."""
    uncommitted = _commit("d", "w", 24).replace("true", "false")
    batches = [[x for i, t in enumerate("abcd") for x in (_table(t, "n", i), _partition(t, "p", 4 + i))]
               + [_commit("a", "x", 10), _commit("a", "y", 11, 5), _commit("b", "x", 12), _commit("d", "w", 13)],
               [_commit("a", "x", 20, 7, "update"), _commit("a", None, 21, 3), _commit("b", "x", 22, op="delete"),
                _commit("c", "z", 23, op="delete"), uncommitted],
               [_commit("a", "x", 20, 7, "update"), _commit("a", "y", 30, op="delete"), _commit("a", "", 31, 2)],
               [_commit("a", "y", 40, 9), _commit("a", None, 41, 4, "update")]]
    tables, base = _run(spark, batches, dedupe_commits=True)
    want = compute_assets_from_feed(changelog.read_changes(spark, f"{base}/feed/*"), dedupe_commits=True)
    assert _sorted(tables.table_level_assets().select("table_id", "file_counts", "file_total_size")) == [
        ("a", 4, 22), ("b", 0, 0), ("c", 0, 0), ("d", 0, 0)]
    assert _sorted(tables.table_level_assets()) == _sorted(want.table_assets.select(*tables.table_level_assets().columns))
    assert _sorted(tables.level_assets("namespace")) == [("n", 4, 4, 4, 22)]
    job.apply_batch(tables, spark.createDataFrame([], job.COMPACTED), 3, dedupe_commits=True)  # a replay
    assert _sorted(tables.level_assets("namespace")) == [("n", 4, 4, 4, 22)]


def test_repeated_events_count_once_after_landing(spark):
    base = tempfile.mkdtemp(prefix="land-")
    lines = [_table("a", "n1", 1), _partition("a", "p", 2), _commit("a", "c", 3), _commit("a", "c", 3)]
    for i, part in enumerate((lines, lines[2:])):
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.text(f"{base}/feed/part={i}")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*", max_files_per_trigger=1)
    changelog.land_once(stream, f"{base}/landed", f"{base}/land-chk", {"availableNow": True}).awaitTermination()
    tables = job.run_available(changelog.read_landed(spark, f"{base}/landed", stream.schema), f"{base}/out", f"{base}/chk")
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d", "u", "n1", 1, 1, 10)]
    r = compute_assets_from_feed(changelog.read_changes(spark, f"{base}/feed/*"), at_least_once=True)
    assert [x["file_counts"] for x in r.table_assets.collect()] == [1]


def test_changes_that_share_a_position_all_count(spark):
    base = tempfile.mkdtemp(prefix="land-")
    frames = {"table_info": spark.createDataFrame([(t, "n", t, "d", "u") for t in "ab"],
                                                  ", ".join(f"{c} string" for c in changelog.SNAPSHOT_COLUMNS["table_info"])),
              "partition_info": spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "p")], "table_id string, partition_desc string"),
              "data_commit_info": spark.createDataFrame([("a", "c1", True), ("a", "c2", True), ("b", "c3", True)],
                                                        "table_id string, commit_id string, committed boolean")
              .selectExpr("table_id", "commit_id", "array('" + b64('(f,add,10,"x")') + "') as file_ops", "committed")}
    changelog.snapshot_feed(frames, 0).select("value").coalesce(1).write.text(f"{base}/feed/part=0")
    bad = [json.dumps({k: v for k, v in json.loads(_commit("a", c, 9)).items() if k != "seq"}) for c in ("x", "y")]
    spark.createDataFrame([(x,) for x in bad], "value string").coalesce(1).write.text(f"{base}/feed/part=1")
    stream = changelog.read_change_stream(spark, f"{base}/feed/*")
    changelog.land_once(stream, f"{base}/landed", f"{base}/land-chk", {"availableNow": True}).awaitTermination()
    assert spark.read.schema(stream.schema).parquet(f"{base}/landed").count() == 10
    twice = changelog.read_changes(spark, f"{base}/feed/*")
    r = compute_assets_from_feed(twice.unionByName(twice), at_least_once=True)
    assert {(x["table_id"], x["partition_counts"], x["file_counts"]) for x in r.table_assets.collect()} \
        == {("a", 2, 2), ("b", 1, 1)}
    assert [x["problem"] for x in r.rejects.collect()] == ["no_position"] * 2


def test_equal_offsets_of_two_partitions_are_two_changes(spark):
    lines = [_table("a", "n1", 1), _partition("a", "p", 2), _commit("a", "c1", 3), _commit("a", "c2", 3)]
    bare = [json.dumps({k: v for k, v in json.loads(x).items() if k != "seq"}) for x in lines]
    raw = spark.createDataFrame([(x, "s.public.t", 7, p) for x, p in zip(bare * 2, [0, 0, 0, 1] * 2)],
                                "value string, topic string, offset long, partition int")
    decoded = decode_envelopes(raw, "value", "topic", "offset", "partition")
    r = compute_assets_from_feed(decoded, at_least_once=True)
    assert [x["file_counts"] for x in r.table_assets.collect()] == [2]
    same = spark.createDataFrame([(bare[2], "s.public.t", 7, p) for p in (0, 0, 1)],
                                 "value string, topic string, offset long, partition int")
    assert with_position(decode_envelopes(same, "value", "topic", "offset", "partition")) \
        .select("position").distinct().count() == 2


def test_counts_beyond_int_do_not_stop_the_job(spark):
    rows = spark.createDataFrame([("n", 1, 2, 3_000_000_000, 5), ("m", 1, 2, None, 5)],
                                 "namespace string, table_counts long, partition_counts long, file_counts long, "
                                 "file_total_size long")
    got = {r["namespace"]: r["file_counts"] for r in to_result_schema(rows, NAMESPACE_LEVEL_ASSETS).collect()}
    assert got == {"n": 2**31 - 1, "m": None}


def test_counts_beyond_int_stay_exact_in_the_stream(spark):
    tables = job.AssetTables.at(spark, tempfile.mkdtemp(prefix="big-"))
    attrs, group = ("A", "n", "d", "u"), [("n", "d", "u")]
    def micro_batch(batch_id, files):
        rows = [("c", "a", "", "create", None, [], files, 50, 3 + batch_id)]
        if batch_id == 0:
            rows += [("t", "a", "", "create", attrs, group, None, None, 1), ("p", "a", "p", "create", None, [], None, None, 2)]
        job.apply_batch(tables, spark.createDataFrame(rows, job.COMPACTED), batch_id)
    for batch_id, files in enumerate((3_000_000_000, 3_000_000_001)):
        micro_batch(batch_id, files)
    assert _sorted(tables.table_level_assets()) == [("a", "A", "d", "u", "n", 1, 3_000_000_001, 50)]
    assert _sorted(tables.level_assets("namespace")) == [("n", 1, 1, 3_000_000_001, 50)]
    for _ in range(2):  # a replay quarantines the same row
        kept = tables.within_int(tables.table_level_assets(), "table_level_assets", TABLE_LEVEL_ASSETS, 1)
    assert kept.count() == 0 and kept.schema["file_counts"].dataType == T.IntegerType()
    (bad,) = tables.result_quarantine().collect()
    assert bad["problem"] == "count_beyond_int" and json.loads(bad["raw"])["file_counts"] == 3_000_000_001


def test_merge_statement_text():
    text = jdbc_upsert_statement("s.t", ["k", "a", "b"], "k", ["b"])
    assert text == ("INSERT INTO s.t (k, a, b) SELECT k, a, b FROM s.t__staging "
                    "ON CONFLICT (k) DO UPDATE SET b = EXCLUDED.b")
    with pytest.raises(ValueError):
        jdbc_upsert_statement("t; drop", ["k"], "k", [])
    assert merge_statement("cat.t", ["k", "a"], "k", ["a"]) == (
        "MERGE INTO cat.t t USING {changed} s ON t.k = s.k WHEN MATCHED THEN UPDATE SET t.a = s.a "
        "WHEN NOT MATCHED THEN INSERT (k, a) VALUES (s.k, s.a)")
