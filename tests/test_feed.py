"""Batch over a raw feed: one-pass compaction, quarantine of bad commits."""

import json
import tempfile

from assetlens.plans.batch import compute_assets_from_feed
from assetlens.sources import changelog
from conftest import b64


def _env(op, table, img, seq):
    before, after = (img, {}) if op == "delete" else ({}, img)
    return json.dumps({"commitOp": op, "tableName": table, "before": before, "after": after,
                       "seq": seq})


def test_feed_batch_with_quarantine_and_other_tables(spark):
    path = tempfile.mkdtemp(prefix="feed-") + "/f"
    ti = {"table_id": "a", "table_name": "A", "table_namespace": "n1", "domain": "d1",
          "creator": "u1"}
    lines = [
        _env("create", "table_info", ti, 1),
        _env("create", "partition_info", {"table_id": "a", "partition_desc": "p1"}, 2),
        _env("create", "partition_info", {"table_id": "a", "partition_desc": None}, 3),
        _env("create", "data_commit_info", {"table_id": "a", "commit_id": "c@1", "committed": True,
                                            "file_ops": [b64('(f,add,10,"x")'), b64('(g,del,5,"x")')]}, 4),
        _env("create", "data_commit_info", {"table_id": "a", "commit_id": "c2", "committed": True,
                                            "file_ops": [b64("(g,add,4,x)")]}, 5),
        _env("create", "data_commit_info", {"table_id": "a", "commit_id": "c3", "committed": False,
                                            "file_ops": [b64('(h,add,7,"x")')]}, 6),
        _env("create", "namespace", {"table_id": "zz"}, 7),
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    r = compute_assets_from_feed(changelog.read_changes(spark, path))
    assert [tuple(x) for x in r.table_assets.collect()] == [
        ("a", "A", "d1", "u1", "n1", "create", 1, 1, 10)]
    assert [(x["commit_id"], x["seq"], x["problem"]) for x in r.quarantine.collect()] == [
        ("c2", 5, "unparsed_file_op")]
    assert [tuple(x) for x in r.namespace_assets.collect()] == [("n1", 1, 1, 1, 10)]
