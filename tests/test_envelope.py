"""Envelope decoding, row-image choice, routing, and file-op parsing."""

import json

from pyspark.sql import functions as F

from assetlens.functions.fileops import decode_base64_text, parse_file_op
from assetlens.sources import envelope
from conftest import b64


def _decode(spark, envs, topic=None):
    rows = [(json.dumps(e), topic) for e in envs]
    df = spark.createDataFrame(rows, "value string, topic string")
    return envelope.decode_envelopes(df, topic_col="topic" if topic else None)


def test_empty_after_image_takes_before(spark):
    d = _decode(spark, [{"commitOp": "DELETE", "tableName": "partition_info",
                         "before": {"table_id": "t1", "partition_desc": "p"}, "after": {}, "seq": 3}])
    # The parsed empty image is a struct of nulls, not null.
    assert d.select(F.col("after").isNull()).first()[0] is False
    ti, pi, ci = envelope.route_all(d)
    assert [tuple(r) for r in pi.collect()] == [("t1", "p", "delete", 3)]
    assert ti.count() == 0 and ci.count() == 0


def test_op_codes_and_topic_table_name(spark):
    envs = [{"commitOp": "c", "before": {}, "after": {"table_id": "t", "table_namespace": "n",
                                                       "table_name": "x", "domain": "d",
                                                       "creator": "u"}, "seq": 1}]
    d = _decode(spark, envs, topic="srv.public.table_info")
    ti, _, _ = envelope.route_all(d)
    assert [tuple(r) for r in ti.collect()] == [("t", "x", "n", "d", "u", "create", 1)]


def test_other_tables_are_dropped(spark):
    envs = [{"commitOp": "create", "tableName": "namespace", "before": {},
             "after": {"namespace": "n"}, "seq": 1}]
    assert all(df.count() == 0 for df in envelope.route_all(_decode(spark, envs)))


def test_commit_image_with_json_boolean_and_file_ops(spark):
    envs = [{"commitOp": "create", "tableName": "data_commit_info", "before": {},
             "after": {"table_id": "t", "commit_id": "c", "committed": True,
                       "file_ops": [b64('(p,add,7,"a")')]}, "seq": 9}]
    _, _, ci = envelope.route_all(_decode(spark, envs))
    r = ci.first()
    assert r["committed"] is True and r["file_ops"] == [b64('(p,add,7,"a")')]


def test_file_op_parse_first_match_and_no_match(spark):
    df = spark.createDataFrame(
        [("junk (a,add,12,\"x,y\") tail (b,del,3,\"z\")",), ("(p,add,9,a)",), (None,)], "t string")
    p = df.select(parse_file_op(F.col("t")).alias("p")).select("p.*").collect()
    assert (p[0]["matched"], p[0]["path"], p[0]["action"], p[0]["size"], p[0]["columns"]) == (
        True, "a", "add", 12, "x,y")
    # No match: empty strings, not null (as the regex extract of the reference).
    assert (p[1]["matched"], p[1]["action"], p[1]["size"]) == (False, "", None)
    assert p[2]["matched"] is False


def test_base64_decoding_of_bad_text_is_null(spark):
    df = spark.createDataFrame([(b64("héllo"),), ("%%%",)], "t string")
    got = [r[0] for r in df.select(decode_base64_text(F.col("t"))).collect()]
    assert got == ["héllo", None]


def test_several_schemas_qualify_table_ids(spark):
    envs = [{"commitOp": "c", "before": {}, "after": {"table_id": "t", "partition_desc": "p"},
             "seq": 1}]
    a = _decode(spark, envs, topic="srv.s1.partition_info")
    b = _decode(spark, envs, topic="srv.s2.partition_info")
    _, pi, _ = envelope.route_all(a.unionByName(b), qualify_ids=True)
    assert sorted(r["table_id"] for r in pi.collect()) == ["s1.t", "s2.t"]


def test_connector_records_and_rejects(spark):
    import json
    import tempfile

    from assetlens.plans.batch import compute_assets_from_feed
    from assetlens.sources import changelog
    from assetlens.sources import envelope as env
    from conftest import b64
    path = tempfile.mkdtemp(prefix="connector-") + "/f"

    def record(op, table, img, lsn, **more):
        before, after = (img, None) if op == "d" else (None, img)
        return json.dumps({"op": op, "before": before, "after": after,
                           "source": {"schema": "public", "table": table, "lsn": lsn}} | more)
    commit = {"table_id": "a", "commit_id": "c", "committed": True, "file_ops": [b64('(f,add,10,"x")')]}
    lines = [
        record("c", "table_info", {"table_id": "a", "table_name": "A", "table_namespace": "n", "domain": "d",
                                   "creator": "u"}, 1),
        record("c", "partition_info", {"table_id": "a", "partition_desc": "p"}, 2),
        record("c", "data_commit_info", commit, 3),
        record("c", "data_commit_info", commit, None),
        record("x", "partition_info", {"table_id": "a", "partition_desc": "q"}, 4),
        record("c", "partition_info", {"partition_desc": "q"}, 5),
        '{"op": "c", "source"',
        record("c", "other", {"table_id": "a"}, None),
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    decoded = changelog.read_changes(spark, path)
    r = compute_assets_from_feed(decoded)
    assert [tuple(x) for x in r.table_assets.collect()] == [("a", "A", "d", "u", "n", "create", 1, 1, 10)]
    assert sorted((x["problem"], x["seq"]) for x in r.rejects.collect()) == [
        ("bad_json", None), ("no_operation", 4), ("no_position", None), ("no_table_id", 5)]
    raw = [x["raw"] for x in r.rejects.collect() if x["problem"] == "bad_json"]
    assert raw == ['{"op": "c", "source"']
    assert env.usable(decoded).count() == 4
    # From Kafka the position is the offset when the record has none.
    kafka = spark.createDataFrame([(lines[3], "srv.public.data_commit_info", 77)], "value string, topic string, offset long")
    got = env.decode_envelopes(kafka, topic_col="topic", offset_col="offset").first()
    assert (got["seq"], got["table_name"], got["schema_name"]) == (77, "data_commit_info", "public")


def test_kafka_needs_topics(spark):
    import pytest
    from assetlens.sources import changelog
    with pytest.raises(ValueError, match="topics"):
        changelog.read_change_stream(spark, kafka={"kafka.bootstrap.servers": "nowhere:1"})
