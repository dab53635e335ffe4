"""Binding of the driver's tables to catalog change logs (see FIXTURES.md section 2).

The driver's TPC-H-like tables hold no lake catalog, so each change log is a fixed
projection of one of them: ``customer`` gives table descriptions, ``orders`` partition
changes and commits, ``lineitem`` the file operations of the commits. Everything is
DataFrame code over whole tables; the growth of the change logs follows the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.schemas import DATA_COMMIT_INFO, PARTITION_INFO, ROW_IMAGE, TABLE_INFO


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(c: Column) -> Column:
    return c.cast("string")


def table_id_of(custkey: Column) -> Column:
    return F.concat(F.lit("table_"), _s(custkey))


def fx_table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``table_info`` changes: every customer created; every 7th updated (every 21st of
    all moving to namespace ``ns_MOVED``); every 11th deleted; every 35th moved (again) to
    ``ns_MOVED2``, some of them after their deletion. The positions of a table's changes
    are 1 : 2 : 3 : 4, so its moves and its deletion come in later micro-batches."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")

    def changes(k: int, op: str, keep: Column | None) -> DataFrame:
        rows = c if keep is None else c.where(keep)
        moved = (key % 21 == 0) if k >= 1 else F.lit(False)
        again = F.lit(k == 3)
        return rows.select(
            table_id_of(key).alias("table_id"),
            F.col("c_name").alias("table_name"),
            F.when(again, F.lit("ns_MOVED2")).when(moved, F.lit("ns_MOVED"))
             .otherwise(F.concat(F.lit("ns_"), F.col("c_mktsegment"))).alias("table_namespace"),
            F.concat(F.lit("domain_"), _s(F.col("c_nationkey"))).alias("domain"),
            F.concat(F.lit("user_"), _s(key % 40)).alias("creator"),
            F.lit(op).alias("commit_op"),
            (key * 13 * (1 + k) + k).alias("seq"),
        )

    return (changes(0, "create", None)
            .unionByName(changes(1, "update", key % 7 == 0))
            .unionByName(changes(2, "delete", key % 11 == 0))
            .unionByName(changes(3, "update", key % 35 == 0)))


def fx_partition_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``partition_info`` changes: one per order, partition ``year=<order year>`` (null for
    every 97th order)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        table_id_of(F.col("o_custkey")).alias("table_id"),
        F.when(k % 97 != 0, F.concat(F.lit("year="), _s(F.year("o_orderdate")))).alias("partition_desc"),
        F.when(k % 5 == 0, F.lit("delete")).when(k % 3 == 0, F.lit("update"))
         .otherwise(F.lit("create")).alias("commit_op"),
        k.alias("seq"),
    )


def file_op_text() -> Column:
    """One file operation per line item, still as text: ``(path,action,size,"c1,c2")``. The
    first line of every 101st order is no file operation, that of every 107th has no size."""
    first = F.col("l_linenumber") == 1
    return F.when(first & (F.col("l_orderkey") % 101 == 0), F.lit("broken")).otherwise(F.concat(
        F.lit("(s3://b/"), _s(F.col("l_orderkey")), F.lit("/"), _s(F.col("l_linenumber")),
        F.lit(".parquet,"),
        F.when(F.col("l_returnflag") == "R", F.lit("del")).otherwise(F.lit("add")), F.lit(","),
        F.when(first & (F.col("l_orderkey") % 107 == 0), F.lit("none"))
         .otherwise(_s(F.floor("l_extendedprice").cast("bigint"))), F.lit(',"c1,c2")')))


def fx_commit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``data_commit_info`` changes: one commit per order that has lines. ``file_ops``
    is the array of base64 texts of the order's lines (in no particular order); a
    commit holds one order's lines, so the array is bounded by lines per order; it is null
    for every 103rd order."""
    li = table(spark, sf_dir, "lineitem")
    arrays = (li.groupBy("l_orderkey")
              .agg(F.collect_list(F.base64(F.encode(file_op_text(), "UTF-8"))).alias("file_ops")))
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.join(arrays, o["o_orderkey"] == arrays["l_orderkey"], "inner").select(
        table_id_of(F.col("o_custkey")).alias("table_id"),
        _s(k).alias("commit_id"),
        F.when(k % 103 != 0, F.col("file_ops")).alias("file_ops"),
        (F.col("o_orderstatus") != "P").alias("committed"),
        F.when(k % 13 == 0, F.lit("delete")).otherwise(F.lit("create")).alias("commit_op"),
        k.alias("seq"),
    )


# ----------------------------------------------------------------- envelope encoding

def _image(cols: dict[str, Column]) -> Column:
    """A row image with the given fields; all other fields null (serialized as absent)."""
    return F.struct(*[cols.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
                      for f in ROW_IMAGE.fields])


def _empty_image() -> Column:
    return _image({})


def encode_envelopes(changes: DataFrame, table_name: str, image: dict[str, Column]) -> DataFrame:
    """Routed changes back to envelope text (``value``) plus ``seq``.

    Creates, updates and snapshot reads carry the row in ``after`` and ``{}`` in
    ``before``; deletes carry it in ``before`` and ``{}`` in ``after``.
    """
    is_delete = F.col("commit_op") == "delete"
    img = _image(image)
    env = F.struct(
        F.col("commit_op").alias("commitOp"), F.lit(table_name).alias("tableName"),
        F.when(is_delete, img).otherwise(_empty_image()).alias("before"),
        F.when(is_delete, _empty_image()).otherwise(img).alias("after"),
        F.col("seq").alias("seq"))
    return changes.select(F.to_json(env).alias("value"), F.col("seq"))


def table_info_envelopes(ti: DataFrame) -> DataFrame:
    return encode_envelopes(ti, TABLE_INFO, {
        "table_id": F.col("table_id"), "table_namespace": F.col("table_namespace"),
        "table_name": F.col("table_name"), "domain": F.col("domain"), "creator": F.col("creator")})


def partition_envelopes(pi: DataFrame) -> DataFrame:
    return encode_envelopes(pi, PARTITION_INFO, {
        "table_id": F.col("table_id"), "partition_desc": F.col("partition_desc")})


def commit_envelopes(ci: DataFrame) -> DataFrame:
    return encode_envelopes(ci, DATA_COMMIT_INFO, {
        "table_id": F.col("table_id"), "commit_id": F.col("commit_id"),
        "file_ops": F.col("file_ops"), "committed": _s(F.col("committed"))})


def other_table_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a catalog table the job does not consume (``namespace``, from
    ``nation``): present in the feed, dropped by routing (P5)."""
    n = table(spark, sf_dir, "nation")
    env = F.struct(F.lit("create").alias("commitOp"), F.lit("namespace").alias("tableName"),
                   F.struct(F.lit(None).cast("string").alias("namespace")).alias("before"),
                   F.struct(F.col("n_name").alias("namespace")).alias("after"),
                   (-1 - F.col("n_nationkey").cast("bigint")).alias("seq"))
    return n.select(F.to_json(env).alias("value"), env["seq"].alias("seq"))


def unusable_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes that cannot be used, from ``customer``: by the key modulo 50, broken JSON
    (1), no log position (2), an unknown operation (3), no table id (4)."""
    c = table(spark, sf_dir, "customer").where((F.col("c_custkey") % 50).between(1, 4))
    key, kind = F.col("c_custkey"), F.col("c_custkey") % 50
    seq = key * 13 + 5
    env = F.struct(
        F.when(kind == 3, F.lit("truncate")).otherwise(F.lit("create")).alias("commitOp"),
        F.lit(TABLE_INFO).alias("tableName"), _empty_image().alias("before"),
        _image({"table_id": F.when(kind != 4, table_id_of(key)), "domain": F.lit("domain_none")}).alias("after"),
        F.when(kind != 2, seq).alias("seq"))
    broken = F.concat(F.lit('{"commitOp":"create","tableName":"table_info","after":{"table_id":"'), table_id_of(key))
    return c.select(F.when(kind == 1, broken).otherwise(F.to_json(env)).alias("value"), seq.alias("seq"))


def fx_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change feed as envelope text: three catalog tables, one other, and
    envelopes that cannot be used."""
    return (table_info_envelopes(fx_table_info(spark, sf_dir))
            .unionByName(partition_envelopes(fx_partition_info(spark, sf_dir)))
            .unionByName(commit_envelopes(fx_commit_changes(spark, sf_dir)))
            .unionByName(other_table_envelopes(spark, sf_dir))
            .unionByName(unusable_envelopes(spark, sf_dir)))
