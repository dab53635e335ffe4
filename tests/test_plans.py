"""Physical plans: no Python on the data path, few exchanges, pruned scans."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod
from assetlens import registry
from conftest import SF_SMALL

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "FlatMapCoGroupsInPandas", "PythonMapInArrow")
# Keys whose result is written by a streaming query or a sink and read back: their
# returned plan is a parquet scan; the work ran before.
READ_BACK = ("cdc_scan", "upsert_", "stream_")


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


@pytest.mark.parametrize("key", sorted(k for k in registry.QUERIES
                                       if not k.startswith(READ_BACK)))
def test_no_python_on_the_data_path(spark, key):
    plan = plan_of(entry_mod.queries()[key](spark, SF_SMALL))
    assert not [n for n in PYTHON_NODES if n in plan], plan


def test_table_level_assets_plan(spark):
    plan = plan_of(registry.q_table_level_assets(spark, SF_SMALL))
    # Change logs: table_info (1), partitions (2: per partition, then per table with
    # one partial row per table per task), commits (1); fixture: lineitem per order (1);
    # plus at most two join exchanges when the joins are not broadcast.
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") - tree.count("BroadcastExchange") <= 7, tree
    # The fold over file ops runs once per commit.
    assert plan.count("aggregate(transform(") == 1, plan
    # The partition log, the largest aggregate, is hash-aggregated (fixed-width buffer).
    assert "Keys [2]: [table_id" in plan
    # Scans read only the columns they need.
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_returnflag:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_partition_compaction_is_hash_aggregate(spark):
    from assetlens.operators import facts
    from assetlens.sources import fixtures as fx
    plan = plan_of(facts.compact_partitions(fx.fx_partition_info(spark, SF_SMALL)))
    assert "HashAggregate" in plan and "SortAggregate" not in plan, plan


def test_feed_compaction_scans_and_parses_once(spark):
    from assetlens.plans.compaction import compaction_agg, tagged_changes
    from assetlens.sources import changelog
    path = registry._envelope_feed(spark, SF_SMALL)
    plan = plan_of(compaction_agg(tagged_changes(changelog.read_changes(spark, path))))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan json") == 1 and "Union" not in tree, tree
    assert tree.count("Exchange") == 1, tree
    assert plan.count("aggregate(transform(") == 1 and "from_json" not in plan


def test_feed_batch_aggregates_partitions_and_commits_by_hash(spark):
    from assetlens.plans.compaction import compact_tagged, tagged_changes
    from assetlens.session import materialize
    from assetlens.sources import changelog
    decoded = changelog.read_changes(spark, registry._envelope_feed(spark, SF_SMALL))
    c = compact_tagged(materialize(tagged_changes(decoded), "tagged", partition_by="kind"))
    for frame in (c.partitions, c.totals):
        plan = plan_of(frame)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan, plan
        assert "PartitionFilters: [isnotnull(kind" in plan  # the other kinds' files are not read


def test_rollups_read_the_assets_once(spark):
    from assetlens.operators import rollups
    assets = registry.q_table_level_assets(spark, SF_SMALL)
    from assetlens.session import materialize
    plan = plan_of(rollups.live_measures_by_level(materialize(assets, "assets"))).split("\n\n")[0]
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1, plan
