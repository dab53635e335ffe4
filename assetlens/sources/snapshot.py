"""Hand-over from the snapshot to the log (S2): watermark reconciliation per split.

A snapshot of a live catalog is read in splits, one after another, so each split shows its rows
at a moment of its own, somewhere between the log position before it was read (``low``) and the one after
(``high``). For the keys of a split, then:

* log changes at or below ``low`` are in the snapshot already and are dropped;
* log changes above ``low`` and up to ``high`` may or may not be in it, so the last of them replaces
  the snapshot row of its key (a delete removes it);
* log changes above ``high`` follow as they are.

The rows so gathered are the table at ``high``, as ``read`` changes at that position. Without this,
results that add up (commit totals) count what is in both the snapshot and the log twice.

Splits are dealt by the first 32 bits of the MD5 of the key, which a database and Spark compute
alike. ``positions`` frames have one row per split: table_name, splits (how many the table has),
split, low, high.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.schemas import CATALOG_TABLES, DATA_COMMIT_INFO, OP_DELETE, OP_READ, PARTITION_INFO, TABLE_INFO
from assetlens.session import child_names, materialize
from assetlens.sources.envelope import OPERATIONS, catalog_changes, row_image, usable

# The primary keys of the catalog tables.
KEYS = {TABLE_INFO: ("table_id",), PARTITION_INFO: ("table_id", "partition_desc"),
        DATA_COMMIT_INFO: ("table_id", "commit_id")}
POSITIONS = "table_name string, splits long, split long, low long, high long"


def split_predicates(columns: tuple[str, ...], rows: int, split_size: int = 1024) -> list[str]:
    """Predicates (PostgreSQL) that cut a table into splits of about ``split_size`` rows, in the order
    of their numbers. Every row is in exactly one; null columns count as empty."""
    n = max(1, math.ceil(rows / split_size))
    key = " || chr(31) || ".join(f"coalesce({c}::text, '')" for c in columns)
    number = f"mod(('x' || substr(md5({key}), 1, 8))::bit(32)::bigint & 4294967295, {n})"
    return [f"{number} = {i}" for i in range(n)]


def split_number(key: Column, splits: Column) -> Column:
    """The number of a key's split, as ``split_predicates`` deals them."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint") % splits


def key_of(table_name: Column, image: Column) -> Column:
    """The primary key of a row image as one text."""
    text = lambda c: F.coalesce(image[c], F.lit(""))
    key = F.lit(None).cast("string")
    for name, columns in KEYS.items():
        key = F.when(table_name == name, F.concat_ws(chr(31), *[text(c) for c in columns])).otherwise(key)
    return key


def positions_of(snapshot: DataFrame) -> DataFrame:
    """Positions of a snapshot that shows each table at one moment, the position of its rows: one
    split per table (written). Rows of one table at several positions need the splits named."""
    found = {r["table_name"]: r for r in catalog_changes(snapshot).groupBy("table_name")
             .agg(F.min("seq").alias("low"), F.max("seq").alias("high")).collect()}  # three rows at most
    torn = [t for t, r in found.items() if r["low"] != r["high"]]
    if torn:
        raise ValueError(f"snapshot rows of {torn[0]} have several positions: name its splits")
    # A table without rows was empty when the others were read.
    least = min((r["high"] for r in found.values()), default=None)
    rows = [(t, 1, 0, p, p) for t in CATALOG_TABLES for p in [found[t]["high"] if t in found else least] if p is not None]
    return materialize(snapshot.sparkSession.createDataFrame(rows, POSITIONS), "snapshot-positions")


def placed(decoded: DataFrame, positions: DataFrame) -> DataFrame:
    """``decoded`` with the columns key, low and high of each change's split; null where the change is
    of no split (broken, of another table, of a table that was not read). Works on streams: the
    positions are a small static side (a row per 1,024 snapshot rows at least), keyed by table and split, and
    are broadcast: a shuffle would deal the whole feed by its few splits."""
    counts = positions.groupBy("table_name").agg(F.max("splits").alias("splits"))
    splits = F.lit(None).cast("bigint")
    for r in counts.collect():  # three rows at most
        splits = F.when(F.col("table_name") == r["table_name"], F.lit(r["splits"])).otherwise(splits)
    key = key_of(F.col("table_name"), row_image(F.col("before"), F.col("after")))
    p = positions.select(F.col("table_name").alias("__table"), F.col("split").alias("__split"), "low", "high")
    numbered = decoded.withColumn("key", key).withColumn("__number", split_number(F.col("key"), splits))
    return numbered.join(F.broadcast(p), (F.col("table_name") == F.col("__table")) & (F.col("__number") == F.col("__split")), "left") \
        .drop("__table", "__split", "__number")


def after_snapshot(log: DataFrame, positions: DataFrame) -> DataFrame:
    """The changes of the decoded log that follow the snapshot (above the ``high`` of their split), and
    those that cannot be placed, for the rejects. Batch and streams."""
    unusable = F.col("seq").isNull() | F.col("commit_op").isNull() | ~F.col("commit_op").isin(*OPERATIONS)
    later = placed(log, positions).where(F.col("high").isNull() | unusable | (F.col("seq") > F.col("high")))
    return later.select(*log.columns)


def rows_at_high(snapshot: DataFrame, log: DataFrame, positions: DataFrame) -> DataFrame:
    """The snapshot as it stood at each split's ``high``: decoded ``read`` changes, one per key."""
    image = row_image(F.col("before"), F.col("after"))
    window = placed(usable(log), positions).where((F.col("seq") > F.col("low")) & (F.col("seq") <= F.col("high")))
    last = materialize(window.groupBy("table_name", "key").agg(
        F.max_by(F.struct("schema_name", image.alias("image"), F.col("commit_op").alias("op"), "high"), F.col("seq")).alias("c"))
        .select("table_name", "key", "c.*"), "snapshot-window")
    kept = placed(usable(snapshot), positions).where(F.col("high").isNotNull()).join(last.select("table_name", "key"), ["table_name", "key"], "left_anti") \
        .select("table_name", "schema_name", image.alias("image"), "high")
    rows = kept.unionByName(last.where(F.col("op") != OP_DELETE).select("table_name", "schema_name", "image", "high"))
    empty = F.lit(None).cast(snapshot.schema["before"].dataType)
    known = {"commit_op": F.lit(OP_READ), "table_name": F.col("table_name"), "schema_name": F.col("schema_name"),
             "before": empty, "after": F.col("image"), "seq": F.col("high")}
    return rows.select(*[known[f.name].alias(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in snapshot.schema.fields])


def reconciled(snapshot: DataFrame, log: DataFrame, positions: DataFrame) -> DataFrame:
    """Batch: one decoded feed of the snapshot and the log, each change counted once."""
    return rows_at_high(snapshot, log, positions).unionByName(after_snapshot(log, positions), allowMissingColumns=True)


def bootstrap_stream(spark: SparkSession, snapshot: DataFrame, log: DataFrame, log_stream: DataFrame, folder: str,
                     positions: DataFrame | None = None) -> DataFrame:
    """Stream: the reconciled rows, written once to ``folder``, followed by the log above them. ``log`` is
    a batch read of the same log, which must have reached the highest position. A restart finds the
    folder and does not read the snapshot again."""
    done = lambda name: "_SUCCESS" in child_names(spark, f"{folder}/{name}")
    if not done("positions"):
        (positions_of(snapshot) if positions is None else positions).write.mode("overwrite").parquet(f"{folder}/positions")
    positions = spark.read.schema(POSITIONS).parquet(f"{folder}/positions")
    if not done("rows"):
        rows_at_high(snapshot, log, positions).write.mode("overwrite").parquet(f"{folder}/rows")
    rows = spark.readStream.schema(snapshot.schema).parquet(f"{folder}/rows")
    return rows.unionByName(after_snapshot(log_stream, positions), allowMissingColumns=True)


def state_at(decoded: DataFrame, moments: DataFrame) -> DataFrame:
    """What a reader sees that reads each split at its ``high`` in ``moments``: decoded ``read`` changes."""
    return rows_at_high(decoded.limit(0), decoded, moments.withColumn("low", F.lit(-(1 << 62))))


def read_snapshot_jdbc(spark: SparkSession, url: str, table: str, properties: dict, split_size: int = 1024) -> DataFrame:
    """Snapshot of one catalog table over JDBC, read in parallel splits (a split is a task). The log positions
    before and after each split come from the database (its current log position).

    Not exercised in this repository's tests: it needs a database server. The predicates are.
    """
    rows = spark.read.jdbc(url, f"(select count(*) as n from {table}) b", properties=properties).first()["n"]
    return spark.read.jdbc(url, table, predicates=split_predicates(KEYS[table], rows, split_size), properties=properties)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """The splits of a snapshot: JSON lines with the fields of ``POSITIONS``."""
    return spark.read.schema(POSITIONS).json(path)


def write_envelopes(decoded: DataFrame, path: str) -> None:
    """Decoded changes as envelope files that ``changelog.read_changes`` reads."""
    env = F.struct(F.col("commit_op").alias("commitOp"), F.col("table_name").alias("tableName"),
                   F.struct(F.col("schema_name").alias("schema")).alias("source"), "before", "after", "seq")
    decoded.select(F.to_json(env).alias("value")).write.mode("errorifexists").text(path)

