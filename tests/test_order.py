"""Ties, mixed positions and missing schemas give one answer and are reported."""

import json
import tempfile

from assetlens.plans.batch import compute_assets_from_feed
from assetlens.sources import changelog
from assetlens.sources.envelope import decode_envelopes
from assetlens.streaming import job
from conftest import b64

T = {"table_id": "t", "table_namespace": "n", "table_name": "T", "domain": "d", "creator": "u"}


def _change(table, op, seq, schema=None, **image):
    sides = ({}, image) if op != "delete" else (image, {})
    env = {"commitOp": op, "tableName": table, "before": sides[0], "after": sides[1]}
    return json.dumps(env | ({"seq": seq} if seq is not None else {}) | ({"source": {"schema": schema}} if schema else {}))


def _feed(spark, lines):
    path = tempfile.mkdtemp(prefix="order-")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/feed/part=0")
    return f"{path}/feed/*", path


def _commit(seq, name="c", schema=None, op="create"):
    return _change("data_commit_info", op, seq, schema, table_id="t", commit_id=name, committed="true", file_ops=[b64('(f,add,10,"c")')])


def _rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_ties_give_one_answer_in_any_order_and_are_reported(spark):
    lines = [_change("table_info", "create", 1, **T), _change("table_info", "update", 1, **{**T, "table_namespace": "m"}), _commit(2),
             _change("partition_info", "create", 3, table_id="t", partition_desc="p"),
             _change("partition_info", "delete", 3, table_id="t", partition_desc="p"),
             _change("partition_info", "create", 4, table_id="t", partition_desc="q")]
    results = []
    for order in (lines, lines[::-1]):
        path, base = _feed(spark, order)
        r = compute_assets_from_feed(changelog.read_changes(spark, path))
        tables = job.run_available(changelog.read_change_stream(spark, path), f"{base}/out", f"{base}/chk")
        columns = ["table_id", "namespace", "partition_counts", "file_counts"]
        assert _rows(r.table_assets, *columns) == _rows(tables.table_level_assets(), *columns)
        assert _rows(r.unordered, "problem", "seq", "commit_op") == [
            ("tied_position", 1, "create"), ("tied_position", 1, "update"), ("tied_position", 3, "create"), ("tied_position", 3, "delete")]
        results.append(_rows(r.table_assets, *columns))
    assert results[0] == results[1] and results[0][0][2] == 1  # p: the delete comes last


def test_log_positions_and_offsets_of_one_table_are_reported(spark):
    rows = [(_change("table_info", "create", 100, **T), 0), (_change("partition_info", "create", None, table_id="t", partition_desc="p"), 1),
            (_change("partition_info", "create", None, table_id="other", partition_desc="p"), 2)]
    raw = spark.createDataFrame([(x, "s.public.x", o, 0) for x, o in rows], "value string, topic string, offset long, partition int")
    r = compute_assets_from_feed(decode_envelopes(raw, "value", "topic", "offset", "partition"))
    assert _rows(r.unordered, "problem", "table_id") == [("mixed_positions", "t")] * 2


def test_a_change_without_schema_is_rejected_where_ids_are_qualified(spark):
    lines = [_change("table_info", "create", 1, "s", **T), _commit(2, schema="s"), _change("partition_info", "create", 3, table_id="t", partition_desc="p"),
             _change("partition_info", "create", 4, "s", table_id="t", partition_desc="q")]
    path, base = _feed(spark, lines)
    r = compute_assets_from_feed(changelog.read_changes(spark, path), qualify_ids=True)
    assert _rows(r.table_assets, "table_id", "partition_counts") == [("s.t", 1)]
    assert _rows(r.rejects, "problem", "seq") == [("no_schema", 3)]
    tables = job.run_available(changelog.read_change_stream(spark, path), f"{base}/out", f"{base}/chk", qualify_ids=True)
    assert _rows(tables.table_level_assets(), "table_id", "partition_counts") == [("s.t", 1)]
    assert _rows(tables.quarantine(), "problem", "seq") == [("no_schema", 3)]
    plain = compute_assets_from_feed(changelog.read_changes(spark, path))
    assert _rows(plain.table_assets, "table_id", "partition_counts") == [("t", 2)] and plain.rejects.count() == 0
