"""The command line runs the batch and the streaming job over a feed folder."""

import base64
import json
import tempfile

import pytest

from assetlens.__main__ import main
from assetlens.plans.batch import compute_assets
from assetlens.schemas import TABLE_LEVEL_ASSETS, to_result_schema
from assetlens.sources import changelog
from assetlens.sources import fixtures as fx
from assetlens.streaming.job import AssetTables
from assetlens.streaming.versions import read_versions
from conftest import SF_SMALL


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def _uncountable(file_ops):
    texts = None if file_ops is None else [base64.b64decode(x).decode() for x in file_ops]
    return texts is None or "broken" in texts or any(",add,none," in t for t in texts)


def test_batch_and_stream_commands(spark):
    base = tempfile.mkdtemp(prefix="cli-")
    changelog.write_feed(fx.fx_envelopes(spark, SF_SMALL), f"{base}/feed")
    want = _sorted(to_result_schema(
        compute_assets(fx.fx_table_info(spark, SF_SMALL), fx.fx_partition_info(spark, SF_SMALL),
                       fx.fx_commit_changes(spark, SF_SMALL)).table_assets, TABLE_LEVEL_ASSETS))
    main(["batch", "--feed", f"{base}/feed", "--out", f"{base}/batch"], spark=spark)
    assert _sorted(spark.read.parquet(f"{base}/batch/table_level_assets")) == want
    assert spark.read.parquet(f"{base}/batch/quarantine").count() == len(
        [r for r in fx.fx_commit_changes(spark, SF_SMALL).collect() if _uncountable(r["file_ops"])])
    assert spark.read.parquet(f"{base}/batch/rejects").count() > 0
    main(["stream", "--feed", f"{base}/feed", "--out", f"{base}/stream", "--once"], spark=spark)
    assert _sorted(AssetTables.at(spark, f"{base}/stream").table_level_assets()) == want


def test_options(spark):
    base = tempfile.mkdtemp(prefix="cli-")

    def line(table, op, seq, **image):
        return json.dumps({"commitOp": op, "tableName": table, "source": {"schema": "s"}, "before": {}, "after": image, "seq": seq})
    t = {"table_id": "t", "table_namespace": "n", "table_name": "T", "domain": "d", "creator": "u"}
    op = base64.b64encode(b'(f,add,10,"c")').decode()
    commit = {"table_id": "t", "commit_id": "c", "committed": "true", "file_ops": [op]}
    lines = [line("table_info", "create", 1, **t), line("partition_info", "create", 2, table_id="t", partition_desc="p"),
             line("data_commit_info", "create", 3, **commit), line("data_commit_info", "create", 3, **commit),
             line("data_commit_info", "update", 4, **commit), line("table_info", "update", 5, **{**t, "table_namespace": "m"})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{base}/feed")
    more = ["--feed", f"{base}/feed", "--qualify-ids", "--at-least-once"]
    main(["batch", *more, "--out", f"{base}/batch", "--dedupe-commits"], spark=spark)
    (row,) = spark.read.parquet(f"{base}/batch/table_level_assets").collect()
    assert (row["table_id"], row["namespace"], row["file_counts"]) == ("s.t", "m", 1)
    assert spark.read.parquet(f"{base}/batch/unordered").count() == 0
    main(["stream", *more, "--out", f"{base}/stream", "--once", "--freeze-attributes"], spark=spark)
    (row,) = AssetTables.at(spark, f"{base}/stream").table_level_assets().collect()
    assert (row["table_id"], row["file_counts"]) == ("s.t", 2)
    main(["stream", *more, "--out", f"{base}/once", "--once", "--dedupe-commits", "--versions"], spark=spark)
    (row,) = AssetTables.at(spark, f"{base}/once").table_level_assets().collect()
    assert (row["table_id"], row["file_counts"]) == ("s.t", 1)
    assert sorted((r["seq"], r["file_counts"]) for r in read_versions(spark, f"{base}/once").collect()) == [(3, 1), (4, 2), (5, 2)]
    with pytest.raises(SystemExit):
        main(["batch", *more, "--out", f"{base}/x", "--freeze-attributes"], spark=spark)
