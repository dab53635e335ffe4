"""Change history: its last version is the last state, whatever the ranges; ranges carry over."""

import random

import pytest
from pyspark.sql import functions as F

from assetlens import registry
from assetlens.operators import facts, history, prefix
from conftest import SF_SMALL
from oracle_compare import duck


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def _last(versions, key):
    order = [c for c in ("seq", "side", "table_id") if c in versions.columns and c != key]
    rest = [c for c in versions.columns if c not in (key, *order)]
    return versions.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("v")).select(key, "v.*")


@pytest.mark.parametrize("name, state, key", [
    ("commit_total_versions", "commit_totals", "table_id"),
    ("partition_count_versions", "live_partition_counts", "table_id"),
    ("table_asset_versions", "table_level_assets", "table_id"),
    ("namespace_asset_versions", "namespace_level_assets", "namespace"),
    ("user_asset_versions", "user_level_assets", "creator")])
def test_last_version_is_the_state(spark, monkeypatch, name, state, key):
    monkeypatch.setattr(prefix, "RANGE_ROWS", 50)
    want = registry.QUERIES[state](spark, SF_SMALL)
    last = _last(registry.QUERIES[name](spark, SF_SMALL), key)
    assert _rows(last, *want.columns) == _rows(want, *want.columns)


def test_first_delete_readding_and_repeats(logs):
    rows = [("t", "p", "delete", 1), ("t", "p", "create", 2), ("t", "q", "create", 3), ("t", "p", "update", 4),
            ("t", "p", "delete", 5), ("t", "p", "delete", 6), ("t", None, "create", 7), ("t", "p", "create", 8)]
    got = _rows(history.partition_count_versions(logs.partitions(rows)), "seq", "partition_counts")
    assert got == [(1, 0), (2, 1), (3, 2), (4, 2), (5, 1), (6, 1), (8, 2)]


def test_one_table_over_many_ranges(spark, monkeypatch):
    """A table with nearly all rows, ranges of a few rows, gaps and negative positions."""
    rng = random.Random(1)
    seqs = rng.sample(range(-10**12, 10**12), 400) + list(range(50))
    rows = [("hot" if i % 9 else f"t{i}", s, rng.choice([None, rng.randint(-5, 5)])) for i, s in enumerate(seqs)]
    df = spark.createDataFrame(rows, "table_id string, seq long, x long").withColumns({"y": F.col("x"), "z": F.col("x")})
    want = []
    for table in {r[0] for r in rows}:
        total, last = 0, None
        for _, s, x in sorted((r for r in rows if r[0] == table), key=lambda r: r[1]):
            was, total, last = last, total + (x or 0), x if x is not None else last
            want.append((table, s, total, last, was))
    for size in (1, 7, 100_000):
        monkeypatch.setattr(prefix, "RANGE_ROWS", size)
        got = prefix.running(df, ["table_id"], ["seq"], sums=["x"], latest=["y"], previous=["z"])
        assert _rows(got, "table_id", "seq", "x", "y", "z") == sorted(want, key=str)
    assert prefix.running(df.limit(0), ["table_id"], ["seq"], sums=["x"]).collect() == []


def test_no_window_is_over_a_table_alone(spark, logs):
    commits = spark.createDataFrame([("t", "c", 1, 1, 1)], "table_id string, commit_id string, seq long, d_files long, d_bytes long")
    plan = history.commit_total_versions(commits)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all(prefix.RANGE in line for line in windows)
    assert "SortAggregate" not in plan


def test_versions_need_all_three_sides(logs, spark):
    ti = logs.table_info([("t", "n", "ns", "d", "u", "create", 1), ("t", "n", "ns2", "d", "u", "update", 4),
                          ("t", "n", "ns2", "d", "u", "delete", 7)])
    pi = logs.partitions([("t", "p", "create", 2)])
    ci = spark.createDataFrame([("t", "b", 3, None, None), ("t", "c", 5, 2, 20)],
                               "table_id string, commit_id string, seq long, d_files long, d_bytes long")
    v = history.table_asset_versions(ti, pi, ci)
    assert _rows(v, "seq", "namespace", "op", "partition_counts", "file_counts") == [
        (5, "ns2", "update", 1, 2), (7, "ns2", "delete", 1, 2)]
    steps = history.group_steps(v, ti)
    assert _rows(history.group_asset_versions(steps, "namespace"), "namespace", "seq", "table_counts", "file_total_size") == [
        ("ns", 5, 0, 0), ("ns2", 5, 1, 20), ("ns2", 7, 0, 0)]
    assert _rows(history.group_asset_versions(steps, "creator"), "seq", "domain_counts", "namespace_counts", "table_counts") == [
        (5, 1, 2, 1), (7, 1, 2, 0)]


def test_snapshot_rows_share_a_position_in_a_fixed_order(spark, logs):
    """Rows of one snapshot have one position: the history still has a row per change, in one order."""
    ti = logs.table_info([("t", "n", "ns", "d", "u", "read", 5)])
    want = None
    for turn in (1, -1):
        pi = logs.partitions([("t", d, "read", 5) for d in "abc"][::turn])
        ci = spark.createDataFrame([("t", c, 5, n, n) for c, n in (("x", 1), ("y", 10), ("z", 100))][::turn],
                                   "table_id string, commit_id string, seq long, d_files long, d_bytes long")
        got = [_rows(history.partition_count_versions(pi), "partition_counts"), _rows(history.commit_total_versions(ci), "file_counts"),
               _rows(history.table_asset_versions(ti, pi, ci), "row", "partition_counts", "file_counts")]
        assert got[0] == [(1,), (2,), (3,)] and got[1] == [(1,), (11,), (111,)]
        assert got[2] == [("x", 3, 1), ("y", 3, 11), ("z", 3, 111)] and got in (want, got)
        want = got


def test_file_ops_are_folded_once(spark, monkeypatch):
    """A filter on the deltas would be pushed below the fold and fold every commit once more."""
    written, write = [], history.materialize
    monkeypatch.setattr(history, "materialize", lambda df, name: written.append(df) or write(df, name))
    registry.q_table_asset_versions(spark, SF_SMALL)
    registry.q_commit_total_versions(spark, SF_SMALL)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in written]
    assert sorted(p.count("regexp_extract") for p in plans if "regexp_extract" in p) == [1, 1]
