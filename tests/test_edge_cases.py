"""The hand-made edge cases of FIXTURES.md section 3."""

from assetlens.operators import facts
from assetlens.plans.batch import compute_assets

OK_OP = '(p,add,9,"a,b")'


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _counts(logs, parts):
    return _rows(facts.live_partition_counts(facts.compact_partitions(logs.partitions(parts))),
                 "table_id", "partition_counts")


def _totals(logs, commits):
    s = facts.commit_stats(logs.commits(commits))
    return _rows(facts.commit_totals(facts.signed_commit_deltas(s)),
                 "table_id", "file_counts", "file_total_size")


def test_partition_seen_twice(logs):
    assert _counts(logs, [("t", "p1", "create", 1), ("t", "p1", "update", 2)]) == [("t", 1)]


def test_partition_deleted_twice(logs):
    rows = [("t", "p1", "create", 1), ("t", "p1", "delete", 2), ("t", "p1", "delete", 3)]
    assert _counts(logs, rows) == [("t", 0)]


def test_first_partition_change_is_delete(logs):
    assert _counts(logs, [("t", "p1", "delete", 1)]) == [("t", 0)]


def test_delete_then_recreate_counts_again(logs):
    rows = [("t", "p1", "create", 1), ("t", "p1", "delete", 2), ("t", "p1", "create", 3),
            ("t", "p2", "create", 4)]
    assert _counts(logs, rows) == [("t", 2)]


def test_null_partition_desc_gives_no_row(logs):
    assert _counts(logs, [("t", None, "create", 1)]) == []


def test_uncommitted_commit_adds_nothing(logs):
    assert _totals(logs, [("t", "c1", [OK_OP], False, "create", 1)]) == []


def test_delete_of_uncommitted_commit_subtracts(logs):
    assert _totals(logs, [("t", "c1", [OK_OP], False, "delete", 1)]) == [("t", -1, -9)]


def test_created_then_updated_commit_counts_twice(logs):
    rows = [("t", "c1", [OK_OP], True, "create", 1), ("t", "c1", [OK_OP], True, "update", 2)]
    assert _totals(logs, rows) == [("t", 2, 18)]


def test_dedupe_commits_option_counts_once(logs):
    rows = [("t", "c1", [OK_OP], True, "create", 1), ("t", "c1", [OK_OP], True, "update", 2),
            ("t", "c2", [OK_OP], True, "create", 3), ("t", "c2", [OK_OP], True, "delete", 4)]
    s = facts.commit_stats(logs.commits(rows))
    got = _rows(facts.commit_totals(facts.signed_commit_deltas(s, dedupe_commits=True)),
                "table_id", "file_counts", "file_total_size")
    assert got == [("t", 1, 9)]


def test_del_file_op_adds_nothing(logs):
    rows = [("t", "c1", ['(p,del,9,"a,b")', '(q,add,5,"a")'], True, "create", 1)]
    assert _totals(logs, rows) == [("t", 1, 5)]


def test_unquoted_column_list_goes_to_quarantine(logs):
    rows = [("t", "c1", ["(p,add,9,a)"], True, "create", 1), ("t", "c2", [OK_OP], True, "create", 2)]
    s = facts.commit_stats(logs.commits(rows))
    assert _rows(facts.quarantine(s), "commit_id", "problem") == [("c1", "unparsed_file_op")]
    # The bad commit is skipped, the good one counted.
    assert _rows(facts.commit_totals(facts.signed_commit_deltas(s)),
                 "table_id", "file_counts") == [("t", 1)]


def test_missing_file_ops_and_bad_size_go_to_quarantine(logs):
    rows = [("t", "c1", None, True, "create", 1), ("t", "c2", ['(p,add,x9,"a")'], True, "create", 2)]
    s = facts.commit_stats(logs.commits(rows))
    assert _rows(facts.quarantine(s), "commit_id", "problem") == [
        ("c1", "missing_file_ops"), ("c2", "bad_file_size")]


def _world(logs, table_info, parts=None, commits=None):
    ti = logs.table_info(table_info)
    ids = sorted({r[0] for r in table_info})
    parts = parts if parts is not None else [(t, "p1", "create", 100 + i) for i, t in enumerate(ids)]
    commits = commits if commits is not None else [
        (t, f"c{i}", [OK_OP], True, "create", 200 + i) for i, t in enumerate(ids)]
    return compute_assets(ti, logs.partitions(parts), logs.commits(commits), keep=False)


def test_table_without_partitions_or_commits_is_absent(logs):
    ti = [("a", "A", "n1", "d1", "u1", "create", 1), ("b", "B", "n1", "d1", "u1", "create", 2),
          ("c", "C", "n2", "d2", "u2", "create", 3)]
    r = _world(logs, ti, parts=[("a", "p1", "create", 10), ("c", "p1", "create", 11)],
               commits=[("a", "c1", [OK_OP], True, "create", 20),
                        ("b", "c2", [OK_OP], True, "create", 21)])
    assert _rows(r.table_assets, "table_id") == [("a",)]
    assert _rows(r.namespace_assets, "namespace", "table_counts") == [("n1", 1)]
    assert _rows(r.user_assets, "creator") == [("u1",)]


def test_all_tables_of_group_deleted_keeps_zero_row(logs):
    ti = [("a", "A", "n1", "d1", "u1", "create", 1), ("a", "A", "n1", "d1", "u1", "delete", 2),
          ("b", "B", "n2", "d1", "u1", "create", 3)]
    r = _world(logs, ti)
    assert _rows(r.namespace_assets, "namespace", "table_counts", "partition_counts",
                 "file_counts", "file_total_size") == [("n1", 0, 0, 0, 0), ("n2", 1, 1, 1, 9)]
    # A deleted table keeps its table-level row (with its last measures and op).
    assert _rows(r.table_assets, "table_id", "op") == [("a", "delete"), ("b", "create")]


def test_moved_table_counts_in_new_group_only(logs):
    ti = [("a", "A", "n1", "d1", "u1", "create", 1), ("a", "A", "n2", "d2", "u1", "update", 2)]
    r = _world(logs, ti)
    assert _rows(r.namespace_assets, "namespace", "table_counts") == [("n1", 0), ("n2", 1)]
    assert _rows(r.domain_assets, "domain", "table_counts") == [("d1", 0), ("d2", 1)]
    # Domains and namespaces are "ever seen" for a creator.
    assert _rows(r.user_assets, "creator", "domain_counts", "namespace_counts", "table_counts") == [
        ("u1", 2, 2, 1)]


def test_delete_with_key_only_image_uses_last_live_attributes(logs):
    ti = [("a", "A", "n1", "d1", "u1", "create", 1), ("a", None, None, None, None, "delete", 2)]
    r = _world(logs, ti)
    assert _rows(r.table_assets, "table_id", "namespace", "domain", "creator", "op") == [
        ("a", "n1", "d1", "u1", "delete")]
    assert _rows(r.namespace_assets, "namespace", "table_counts") == [("n1", 0)]


def test_result_independent_of_input_order(logs, spark):
    ti = [("a", "A", "n1", "d1", "u1", "create", 1), ("a", "A", "n2", "d1", "u1", "update", 5),
          ("b", "B", "n1", "d2", "u2", "create", 2)]
    parts = [("a", "p1", "create", 3), ("a", "p1", "delete", 4), ("b", "p9", "create", 6)]
    r1 = _world(logs, ti, parts)
    r2 = _world(logs, list(reversed(ti)), list(reversed(parts)))
    for a, b in [(r1.table_assets, r2.table_assets), (r1.user_assets, r2.user_assets)]:
        assert sorted(a.collect()) == sorted(b.collect())
