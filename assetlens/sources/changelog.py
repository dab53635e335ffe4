"""Change-feed sources: the change log (S1) and the snapshot bootstrap.

The change feed is a sequence of envelope texts (see ``envelope.py``), one per row
change of the catalog database, as written by a change-capture connector into files
or a Kafka topic. A new deployment first reads a snapshot of the three catalog
tables (rows tagged ``read`` with a log position below every change that follows),
then the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.schemas import (CATALOG_TABLES, DATA_COMMIT_INFO, ENVELOPE, OP_READ, PARTITION_INFO,
                               TABLE_INFO)
from assetlens.sources.deliveries import first_deliveries
from assetlens.sources.envelope import decode_envelopes, normalize_envelopes
from assetlens.sources.fixtures import encode_envelopes


# ------------------------------------------------------------------ S1: the change log

def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of envelope files (one JSON envelope per line), decoded.

    The JSON file source parses each line once, into the explicit envelope schema
    (no inference pass), while reading; filters on the table name are applied there.
    """
    return normalize_envelopes(spark.read.schema(ENVELOPE).json(path))


def read_changes_kafka(spark: SparkSession, kafka: dict) -> DataFrame:
    """Batch read of the topics from their earliest offsets to the present, decoded."""
    raw = spark.read.format("kafka").options(**({"startingOffsets": "earliest"} | kafka)).load()
    return decode_envelopes(raw, value_col="value", topic_col="topic", offset_col="offset", partition_col="partition")


def read_change_stream(spark: SparkSession, path: str | None = None,
                       kafka: dict | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the change feed, decoded and restricted to the catalog tables.

    ``path``: a folder of envelope text files. ``kafka``: options of the Kafka source
    (``kafka.bootstrap.servers``, ``subscribe`` or ``subscribePattern``, ...), read from
    the earliest offset unless the options say otherwise; the table name is then taken
    from the topic when the envelope lacks one, and the log position from the offset.
    The filter on the three catalog tables (and broken envelopes, which have no table)
    runs before any shuffle.
    """
    if kafka is not None:
        options = {"startingOffsets": "earliest"} | kafka
        if not {"subscribe", "subscribePattern", "assign"} & set(options):
            raise ValueError("name the topics: subscribe, subscribePattern or assign")
        raw = spark.readStream.format("kafka").options(**options).load()
        decoded = decode_envelopes(raw, value_col="value", topic_col="topic", offset_col="offset",
                                   partition_col="partition")
    else:
        reader = spark.readStream.schema(ENVELOPE).format("json")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        decoded = normalize_envelopes(reader.load(path))
    return decoded.where(F.col("table_name").isin(*CATALOG_TABLES) | F.col("raw").isNotNull())


def land_once(decoded_stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
              ascending: bool = False):
    """For sources that repeat events after a restart: writes each change once to ``path``
    (parquet, exactly-once file sink), for ``read_landed``. A repeat is equal in everything,
    the position included (``with_position``); equal changes without any position count as
    repeats, and a broken envelope is told by its text. The state is intervals of positions,
    and hashes at open positions only; see ``deliveries`` for what that asks of the source."""
    return (first_deliveries(decoded_stream, ascending).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def read_landed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Streaming read of what ``land_once`` wrote; ``schema`` is that of its input."""
    return spark.readStream.schema(schema).parquet(path)


def write_feed(envelopes: DataFrame, path: str, cuts: list[int] | Callable[[DataFrame], list[int]] | None = None,
               files_per_part: int | None = None, scratch: list[str] | None = None) -> list[str]:
    """Writes envelope text (``value``, ``seq``) as a change feed folder.

    With ``cuts`` (ascending log positions) the feed is written as consecutive parts
    ``part=000, 001, ...`` in log order, one write per part, so a file-source stream
    sees them in that order; with ``files_per_part`` each part has exactly that many
    files, and ``maxFilesPerTrigger = files_per_part`` makes one part one micro-batch.
    ``cuts`` may be a function of the materialized envelopes, which finds them without building the envelopes again.
    The envelopes are materialized once first, so each part is a filtered read
    (row groups skipped on ``seq``) rather than a recomputation.
    """
    if not cuts:
        envelopes.select("value").write.mode("errorifexists").text(path)
        return [path]
    from assetlens.session import materialize
    env = materialize(envelopes.select("value", "seq"), "feed-envelopes", scratch)
    bounds = [None, *(cuts(env) if callable(cuts) else cuts), None]
    parts = []
    for i in range(len(bounds) - 1):
        lo, hi = bounds[i], bounds[i + 1]
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("seq") > lo)
        if hi is not None:
            cond = cond & (F.col("seq") <= hi)
        part = f"{path}/part={i:03d}"
        out = env.where(cond).select("value")
        if files_per_part:
            out = out.repartition(files_per_part)
        out.write.mode("errorifexists").text(part)
        parts.append(part)
    return parts


# ------------------------------------------------------------- S2: snapshot bootstrap

def read_snapshot_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Snapshot of one catalog table exported as files; split by the file source."""
    return spark.read.format(fmt).load(path)


def snapshot_envelopes(rows: DataFrame, table_name: str, image: dict,
                       snapshot_seq: int) -> DataFrame:
    """Snapshot rows as envelopes with operation ``read`` and log position
    ``snapshot_seq``, which must be below every position of the log that follows.
    Each key occurs once in a snapshot, so the shared position is no tie."""
    tagged = rows.select("*", F.lit(OP_READ).alias("commit_op"),
                         F.lit(snapshot_seq).cast("bigint").alias("seq"))
    return encode_envelopes(tagged, table_name, image)


# The columns of the catalog tables that the job reads.
SNAPSHOT_COLUMNS = {
    TABLE_INFO: ("table_id", "table_namespace", "table_name", "domain", "creator"),
    PARTITION_INFO: ("table_id", "partition_desc"),
    DATA_COMMIT_INFO: ("table_id", "commit_id", "file_ops", "committed"),
}


def snapshot_feed(snapshots: dict[str, DataFrame], snapshot_seq: int) -> DataFrame:
    """Snapshots of the three catalog tables (by name) as one set of envelopes."""
    out = None
    for name, columns in SNAPSHOT_COLUMNS.items():
        image = {c: F.col(c).cast("string") if c == "committed" else F.col(c) for c in columns}
        part = snapshot_envelopes(snapshots[name], name, image, snapshot_seq)
        out = part if out is None else out.unionByName(part)
    return out


def bootstrap(snapshot: DataFrame, log: DataFrame, snapshot_seq: int) -> DataFrame:
    """Snapshot envelopes ahead of the log changes after the snapshot position."""
    return snapshot.unionByName(log.where(F.col("seq") > snapshot_seq))
