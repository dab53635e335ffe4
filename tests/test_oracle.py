"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from oracle_compare import compare, duck

from assetlens import registry

KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(KEYS) <= set(entry_mod.queries())
    assert set(KEYS) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry_mod.queries()[key](spark, SF_SMALL)
    ok, msg = compare(df, con, entry_mod.oracle_sql()[key])
    assert ok, f"{key}: {msg}"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["namespace", "table_counts", "partition_counts", "file_counts",
                          "file_total_size"]
    assert df.count() > 0
