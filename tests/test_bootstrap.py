"""A snapshot plus the log gives the same results as the log alone, however they overlap."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from assetlens import registry
from assetlens.__main__ import main
from assetlens.operators import facts
from assetlens.plans.batch import compute_assets_from_feed
from assetlens.schemas import wide, TABLE_LEVEL_ASSETS
from assetlens.sources import changelog, snapshot
from assetlens.sources import fixtures as fx
from assetlens.streaming.job import AssetTables
from conftest import SF_SMALL, b64


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_snapshot_plus_later_log_equals_whole_log(spark):
    boot = registry.q_snapshot_bootstrap(spark, SF_SMALL).where("table_name = 'partition_info'") \
        .withColumnRenamed("detail", "partition_desc")
    cut = registry.orders_mid(spark, SF_SMALL)
    assert boot.where(F.col("commit_op") == "read").where(F.col("seq") != cut).count() == 0
    assert boot.where(F.col("commit_op") != "read").where(F.col("seq") <= cut).count() == 0
    whole = fx.fx_partition_info(spark, SF_SMALL)
    counts = lambda df: sorted(tuple(r) for r in facts.live_partition_counts(
        facts.compact_partitions(df)).where(F.col("partition_counts") > 0).collect())
    assert counts(boot) == counts(whole)


def test_splits_cover_every_row_once(spark):
    one = snapshot.split_predicates(("table_id",), 10)
    assert one == ["mod(('x' || substr(md5(coalesce(table_id::text, '')), 1, 8))::bit(32)::bigint & 4294967295, 1) = 0"]
    many = snapshot.split_predicates(("table_id", "partition_desc"), 5_000_000_000)
    assert len(many) == 4_882_813 and len(set(many)) == len(many)
    n = F.lit(7).cast("bigint")
    got = spark.range(1000).select(snapshot.split_number(F.col("id").cast("string"), n).alias("n")).groupBy("n").count().collect()
    assert {r["n"] for r in got} == set(range(7)) and min(r["count"] for r in got) > 80


def _change(table, op, seq, **image):
    sides = ({}, image) if op != "delete" else (image, {})
    return json.dumps({"commitOp": op, "tableName": table, "seq": seq, "before": sides[0], "after": sides[1]})


def _folder(lines):
    path = tempfile.mkdtemp(prefix="envelopes-")
    with open(f"{path}/part.json", "w") as f:
        f.write("\n".join(lines))
    return path


T = {"table_id": "t", "table_namespace": "n", "table_name": "T", "domain": "d", "creator": "u"}


def _commit(op, seq, name, size, committed="true"):
    return _change("data_commit_info", op, seq, table_id="t", commit_id=name, committed=committed,
                   file_ops=[b64(f'({name},add,{size},"c")')])


def _partition(op, seq, name):
    return _change("partition_info", op, seq, table_id="t", partition_desc=name)


def _results(spark, snap, log, splits=None):
    """(partitions, files, bytes) of the table by the batch and by the streaming command."""
    out = tempfile.mkdtemp(prefix="boot-")
    more = ["--snapshot", _folder(snap)]
    if splits:
        more += ["--splits", _folder([json.dumps(dict(zip(("table_name", "splits", "split", "low", "high"), s))) for s in splits])]
    feed = _folder(log)
    main(["batch", "--feed", feed, "--out", f"{out}/batch", *more], spark=spark)
    main(["stream", "--feed", feed, "--out", f"{out}/stream", "--once", *more], spark=spark)
    main(["stream", "--feed", feed, "--out", f"{out}/stream", "--once", *more], spark=spark)  # a restart adds nothing
    columns = ["partition_counts", "file_counts", "file_total_size"]
    batch = _rows(spark.read.schema(wide(TABLE_LEVEL_ASSETS)).parquet(f"{out}/batch/table_level_assets").select(columns))
    stream = _rows(AssetTables.at(spark, f"{out}/stream").table_level_assets().select(columns))
    assert batch == stream
    return batch


def test_commit_in_both_snapshot_and_log_counts_once(spark):
    snap = [_change("table_info", "read", 10, **T), _partition("read", 10, "p"), _commit("read", 10, "c1", 10)]
    log = [_change("table_info", "create", 1, **T), _partition("create", 2, "p"), _commit("create", 5, "c1", 10),
           _commit("create", 12, "c2", 10)]
    assert _results(spark, snap, log) == [(1, 2, 20)]


def test_changes_before_inside_and_after_a_split(spark):
    """The splits of commits are read between 10 and 20: what the log says from 11 to 20 decides."""
    snap = [_change("table_info", "read", 20, **T), _partition("read", 20, "p"), _partition("read", 20, "gone"),
            _commit("read", 20, "old", 1), _commit("read", 20, "seen", 2), _commit("read", 20, "dropped", 4)]
    log = [_commit("create", 3, "old", 1),           # before: in the snapshot
           _commit("create", 12, "seen", 2),         # inside, and already in the snapshot
           _commit("create", 15, "unseen", 8),       # inside, not in the snapshot
           _commit("create", 4, "dropped", 4), _commit("delete", 18, "dropped", 4),  # inside: deleted after it was read
           _commit("create", 21, "new", 16), _commit("delete", 22, "seen", 2),       # after
           _partition("delete", 14, "gone"), _partition("create", 16, "q"), _partition("delete", 30, "p")]
    splits = [(t, 1, 0, 10, 20) for t in ("table_info", "partition_info", "data_commit_info")]
    assert _results(spark, snap, log, splits) == [(1, 1 + 1 + 1 + 1 - 1, 1 + 2 + 8 + 16 - 2)]


def test_totals_of_a_torn_snapshot_equal_those_at_the_positions(spark):
    """Splits at different positions: totals of the reconciled feed are those of the rows at each split's
    ``high`` plus the later changes, not those of the whole log added again."""
    log = changelog.read_changes(spark, registry._envelope_feed(spark, SF_SMALL))
    positions = registry._split_positions(spark, SF_SMALL)
    moments = positions.withColumn("high", F.col("high") - 37)
    feed = snapshot.reconciled(snapshot.state_at(log, moments), log, positions)
    at_high = snapshot.state_at(log, positions).unionByName(snapshot.after_snapshot(log, positions))
    got, want = compute_assets_from_feed(feed), compute_assets_from_feed(at_high)
    for name in ("table_assets", "namespace_assets", "user_assets", "quarantine"):
        assert _rows(getattr(got, name)) == _rows(getattr(want, name))
    twice = compute_assets_from_feed(snapshot.state_at(log, positions).unionByName(log)).table_assets
    assert _rows(twice) != _rows(want.table_assets)
    assert feed.where("commit_op is null or table_name is null").count() > 0  # broken envelopes still reach the rejects


def test_positions_must_be_plain_or_named(spark):
    torn = changelog.read_changes(spark, _folder([_partition("read", 1, "p"), _partition("read", 2, "q")]))
    with pytest.raises(ValueError, match="several positions"):
        snapshot.positions_of(torn)
    whole = changelog.read_changes(spark, _folder([_partition("read", 7, "p")]))
    assert _rows(snapshot.positions_of(whole).select("table_name", "high")) == [
        ("data_commit_info", 7), ("partition_info", 7), ("table_info", 7)]


def test_the_feed_is_not_dealt_by_its_splits(spark):
    log = spark.createDataFrame([], changelog.read_changes(spark, tempfile.mkdtemp(prefix="no-feed-")).schema)
    plan = snapshot.placed(log, registry._split_positions(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
