"""Continuous asset statistics with Structured Streaming.

Spark accepts one stateful aggregate per query in update mode, and neither chained
aggregates nor a join of two streaming aggregates. So the query is the compaction of
``plans.compaction``: the three change logs as tagged rows, and **one** native streaming
aggregate keyed by ``(kind, table_id, sub_key)`` that keeps the compacted state in the
state store.

Each micro-batch emits only the keys it changed (update mode, full values, so a
replay is idempotent). ``foreachBatch`` keeps what the finish needs to look up: the live
flag of each partition, and each table's description and commit totals. It then runs the
same finish functions as the batch job on the touched tables and upserts their rows; live
partition counts and group rows are kept by deltas.

Envelopes and commits that cannot be used do not touch the state: a second, stateless
query appends them to the quarantine folder with the reason.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlens.operators import facts, rollups
from assetlens.plans.compaction import (COMPACTED, KEYS, compaction_agg, quarantined,
                                        split_compacted, tagged_changes)
from assetlens.schemas import (DATA_COMMIT_INFO, DOMAIN_LEVEL_ASSETS, NAMESPACE_LEVEL_ASSETS, OP_DELETE,
                               TABLE_LEVEL_ASSETS, USER_LEVEL_ASSETS, fits, to_exact_schema, wide)
from assetlens.session import materialize, remove_folder, use_rocksdb
from assetlens.sinks.upsert import BATCH_WRITER, JdbcTable, KeyedLog
from assetlens.sources.envelope import rejected

# Live flags of the partitions, and the unusable changes with their reason.
PARTITION_STATE = T.StructType([T.StructField("table_id", T.StringType()),
                                T.StructField("partition_desc", T.StringType()),
                                T.StructField("deleted", T.BooleanType())])
QUARANTINE = T.StructType([T.StructField(c, T.LongType() if c == "seq" else T.StringType()) for c in
                           ("problem", "table_name", "commit_op", "seq", "table_id", "commit_id", "raw")])
PARTITION_COUNTS = T.StructType([T.StructField("table_id", T.StringType()),
                                 T.StructField("partition_counts", T.LongType())])
# With ``dedupe_commits``: the last contribution of each commit, and the totals that follow from them.
TOTALS = T.StructType([T.StructField(c, T.StringType() if c == "table_id" else T.LongType())
                       for c in ("table_id", "file_counts", "file_total_size")])
COMMIT_STATE = T.StructType([TOTALS["table_id"], T.StructField("commit_key", T.StringType()), *TOTALS.fields[1:]])
# Ever-seen (creator, "domain" | "namespace", value) pairs of complete tables.
SEEN_PAIRS = T.StructType([T.StructField(c, T.StringType()) for c in ("creator", "kind", "value")])
TABLE_ASSETS_WITH_OP = T.StructType(wide(TABLE_LEVEL_ASSETS).fields + [T.StructField("op", T.StringType())])


# The three rollups share one stored table keyed by (level, group_key): one plan,
# one write and one commit per micro-batch for all of them. The three result tables
# are views of it.
LEVELS = {"namespace": NAMESPACE_LEVEL_ASSETS, "domain": DOMAIN_LEVEL_ASSETS,
          "creator": USER_LEVEL_ASSETS}
GROUP_ASSETS = T.StructType([
    T.StructField("level", T.StringType()), T.StructField("group_key", T.StringType()),
    T.StructField("domain_counts", T.LongType()), T.StructField("namespace_counts", T.LongType()),
    T.StructField("table_counts", T.LongType()), T.StructField("partition_counts", T.LongType()),
    T.StructField("file_counts", T.LongType()), T.StructField("file_total_size", T.LongType())])


def group_rows(namespace: DataFrame, domain: DataFrame, user: DataFrame) -> DataFrame:
    """The three rollups as rows of the shared group table."""
    def level(df: DataFrame, key: str) -> DataFrame:
        extra = [F.col(c) if c in df.columns else F.lit(None).cast("bigint").alias(c)
                 for c in ("domain_counts", "namespace_counts")]
        return df.select(F.lit(key).alias("level"), F.col(key).alias("group_key"), *extra,
                         *[F.col(m) for m in rollups.MEASURES])
    return level(namespace, "namespace").unionByName(level(domain, "domain")) \
        .unionByName(level(user, "creator"))


@dataclass
class AssetTables:
    """What the job keeps under one folder: the looked-up state (``partition_state`` by
    partition, ``table_state`` with the descriptions and commit totals by table), the
    table-level assets (with the last ``op``, D3), the group assets, and helpers. With
    ``freeze_attributes`` a separate sink table keeps the first-written attributes (D2);
    otherwise the table-level sink is the asset table without ``op``."""
    partition_state: KeyedLog
    table_state: KeyedLog
    table_assets: KeyedLog
    group_assets: KeyedLog
    table_sink: KeyedLog
    partition_counts: KeyedLog
    seen_pairs: KeyedLog
    commit_state: KeyedLog
    commit_totals: KeyedLog
    quarantine_path: str

    @classmethod
    def at(cls, spark: SparkSession, base: str, writer: str = BATCH_WRITER) -> "AssetTables":
        """Per-table tables are looked up by ``table_id``; partitions by their full key, so the
        partitions of one huge table spread over all buckets; group rows by group. The rows of
        removed partitions mean the same as none, and a new base leaves them out (T4)."""
        def log(name, schema, key, by=None, **kw):
            return KeyedLog(spark, f"{base}/{name}", schema, key, bucket_by=by, writer=writer, **kw)
        return cls(
            log("partition_state", PARTITION_STATE, ["table_id", "partition_desc"], forget="deleted"),
            log("table_state", COMPACTED, KEYS, ["table_id"]),
            log("table_assets", TABLE_ASSETS_WITH_OP, "table_id"),
            log("group_assets", GROUP_ASSETS, ["level", "group_key"]),
            log("table_level_assets", wide(TABLE_LEVEL_ASSETS), "table_id"),
            log("partition_counts", PARTITION_COUNTS, "table_id"),
            log("seen_pairs", SEEN_PAIRS, ["creator", "kind", "value"], ["creator"]),
            log("commit_state", COMMIT_STATE, ["table_id", "commit_key"]),
            log("commit_totals", TOTALS, "table_id"),
            f"{base}/quarantine")

    def all(self) -> list[KeyedLog]:
        return [self.partition_state, self.table_state, self.table_assets, self.group_assets, self.table_sink,
                self.partition_counts, self.seen_pairs, self.commit_state, self.commit_totals]

    def quarantine(self) -> DataFrame:
        """Unusable changes so far, each once."""
        spark = self.table_assets.spark
        try:
            return spark.read.schema(QUARANTINE).parquet(self.quarantine_path).distinct()
        except AnalysisException:  # nothing was quarantined yet
            return spark.createDataFrame([], QUARANTINE)

    def table_level_assets(self) -> DataFrame:
        """The K1 result table: the sink table if one was written (frozen attributes, or
        results of batch runs), else the asset table without ``op``."""
        if self.table_sink.last_batch() is not None:
            return self.table_sink.current()
        return to_exact_schema(self.table_assets.current(), wide(TABLE_LEVEL_ASSETS))

    def level_assets(self, level: str) -> DataFrame:
        """K2-K4 result tables: ``namespace``, ``domain`` or ``creator`` level."""
        return self.as_level(self.group_assets.current(), level)

    @staticmethod
    def as_level(group_rows: DataFrame, level: str) -> DataFrame:
        rows = group_rows.where(F.col("level") == F.lit(level))
        return to_exact_schema(rows.withColumnRenamed("group_key", level), wide(LEVELS[level]))

    def within_int(self, rows: DataFrame, name: str, schema: T.StructType, batch_id: int) -> DataFrame:
        """``rows`` of the result table ``name`` for a sink with ``int`` counts; those it
        cannot hold go to ``result_quarantine`` with the reason, unchanged."""
        rows.where(~fits(schema)).select(
            F.lit("count_beyond_int").alias("problem"), F.lit(name).alias("table_name"),
            F.to_json(F.struct(*rows.columns)).alias("raw")) \
            .write.mode("overwrite").parquet(f"{self.quarantine_path}_results/batch={batch_id}/result={name}")
        return to_exact_schema(rows.where(fits(schema)), schema)

    def result_quarantine(self) -> DataFrame:
        """Result rows that a 32-bit sink could not hold, each once."""
        spark, columns = self.table_assets.spark, "problem string, table_name string, raw string"
        try:
            return spark.read.schema(columns).option("recursiveFileLookup", "true") \
                .parquet(f"{self.quarantine_path}_results").distinct()
        except AnalysisException:  # every row fitted
            return spark.createDataFrame([], columns)

    def upsert_groups(self, namespace: DataFrame, domain: DataFrame, user: DataFrame,
                      batch_id: int) -> bool:
        return self.group_assets.upsert(group_rows(namespace, domain, user), batch_id)


def _contributions(assets: DataFrame, sign: int) -> DataFrame:
    """What live tables add to (``sign`` 1) or take from (-1) their current groups."""
    live = assets.where(facts.not_delete(F.col("op")))
    sg = F.lit(sign).cast("bigint")
    return _levels(live, lambda: [sg.alias("table_counts")] + [
        (sg * F.col(m)).alias(m) for m in rollups.MEASURES[1:]])


def _levels(df: DataFrame, measures) -> DataFrame:
    """One row per level (namespace, domain, creator) of each input row."""
    each = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("group_key"))
                               for level in LEVELS]))
    return df.select(each.alias("g"), *measures()).select("g.*", *rollups.MEASURES) \
        .where(F.col("group_key").isNotNull())


def group_deltas(tables: AssetTables, assets: DataFrame, old_assets: DataFrame,
                 history: DataFrame, batch_id: int, scratch: list[str]) -> None:
    """Rollup rows of the touched groups from deltas, reading no table outside the
    touched ones: the stored group row, plus the new and minus the old contribution
    of each touched table. Every group in the history of a complete touched table gets
    a row (zeros if empty, R7). The creators' ever-seen domains and namespaces are a
    set of (creator, kind, value) pairs that only grows (R4, R5)."""
    zero = F.lit(0).cast("bigint")
    exist = _levels(history.distinct(), lambda: [zero.alias(m) for m in rollups.MEASURES])
    delta = (_contributions(assets, 1).unionByName(_contributions(old_assets, -1))
             .unionByName(exist)
             .groupBy("level", "group_key")
             .agg(*[F.sum(m).alias(m) for m in rollups.MEASURES]))
    delta = materialize(delta, f"group-deltas-{batch_id}", scratch)
    creators = history.select("creator").where(F.col("creator").isNotNull()).distinct()
    pairs = (history.select("creator", F.lit("domain").alias("kind"), F.col("domain").alias("value"))
             .unionByName(history.select("creator", F.lit("namespace").alias("kind"),
                                         F.col("namespace").alias("value")))
             .where(F.col("creator").isNotNull() & F.col("value").isNotNull()).distinct())
    known = tables.seen_pairs.current(batch_id - 1, creators)
    tables.seen_pairs.upsert(pairs.join(known, ["creator", "kind", "value"], "left_anti"), batch_id)
    seen = (tables.seen_pairs.current(batch_id, creators)
            .groupBy("creator")
            .agg(F.count_if(F.col("kind") == "domain").cast("bigint").alias("domain_counts"),
                 F.count_if(F.col("kind") == "namespace").cast("bigint").alias("namespace_counts"))
            .select(F.lit("creator").alias("level"), F.col("creator").alias("group_key"),
                    "domain_counts", "namespace_counts"))
    old = tables.group_assets.current(batch_id - 1, delta.select("level", "group_key"))
    rows = (delta.join(old.select("level", "group_key", *[F.col(m).alias(f"__old_{m}")
                                                          for m in rollups.MEASURES]),
                       ["level", "group_key"], "left")
            .join(seen, ["level", "group_key"], "left")
            .select("level", "group_key", "domain_counts", "namespace_counts",
                    *[(F.coalesce(F.col(f"__old_{m}"), zero) + F.col(m)).alias(m)
                      for m in rollups.MEASURES]))
    tables.group_assets.upsert(rows, batch_id)


def dedupe_totals(tables: AssetTables, commits: DataFrame, touched: DataFrame, batch_id: int) -> None:
    """The totals of the touched tables from what changed in the contribution of each touched commit.
    Only the commits of this micro-batch are looked up, so a table holding a third of all commits
    is spread over all buckets. A commit that never counted has null and adds no row."""
    now = commits.select("table_id", F.col("sub_key").alias("commit_key"), "file_counts", "file_total_size") \
        .where(F.col("file_counts").isNotNull())
    before = tables.commit_state.current(batch_id - 1, now.select("table_id", "commit_key"))
    measures = TOTALS.fieldNames()[1:]
    delta = now.drop("commit_key").unionByName(before.select("table_id", *[(-F.col(m)).alias(m) for m in measures])) \
        .groupBy("table_id").agg(*[F.sum(m).alias(f"d_{m}") for m in measures])
    zero = F.lit(0).cast("bigint")
    totals = delta.join(tables.commit_totals.current(batch_id - 1, touched), "table_id", "left").select(
        "table_id", *[(F.coalesce(m, zero) + F.col(f"d_{m}")).alias(m) for m in measures])
    tables.commit_totals.upsert(totals, batch_id)
    tables.commit_state.upsert(now, batch_id)


def apply_batch(tables: AssetTables, changed: DataFrame, batch_id: int,
                freeze_attributes: bool = False, dedupe_commits: bool = False) -> None:
    """``foreachBatch`` body: append the changed state rows, then the new rows of the touched
    tables and touched groups. Only what changed is written; look-ups go by the keys touched.

    Live partitions are maintained as deltas: only the partitions changed
    in this micro-batch are looked up for their previous values (a table holding a third of all
    partitions spreads over all buckets and is never one task's work). Group rows are
    maintained as deltas of the touched tables' contributions (``group_deltas``). A table
    is touched when any of its state keys changed; a group can change only through a
    touched table, and every group a table was ever in (the old group of a move included)
    is in its membership history. "Before" is always the table as the batches before this one
    left it, whatever a failed attempt has written, so a replay never takes a delta twice.
    """
    scratch: list[str] = []
    changed = materialize(changed, f"changed-{batch_id}", scratch)
    touched = materialize(changed.select("table_id").distinct(), f"touched-{batch_id}", scratch)
    is_p = F.col("kind") == "p"

    now = changed.where(is_p).select("table_id", F.col("sub_key").alias("partition_desc"),
                                     (F.col("op") == F.lit(OP_DELETE)).alias("deleted"))
    before = tables.partition_state.current(batch_id - 1, now.select("table_id", "partition_desc"))

    def live(df: DataFrame, sign: int) -> DataFrame:
        return df.select("table_id", F.when(~F.col("deleted"), F.lit(sign)).otherwise(F.lit(0))
                         .cast("bigint").alias("d"))
    delta = live(now, 1).unionByName(live(before, -1)).groupBy("table_id").agg(F.sum("d").alias("d"))
    counts = delta.join(tables.partition_counts.current(batch_id - 1, touched), "table_id", "left").select(
        "table_id", (F.coalesce("partition_counts", F.lit(0).cast("bigint")) + F.col("d")).alias("partition_counts"))
    tables.partition_counts.upsert(counts, batch_id)
    tables.partition_state.upsert(now, batch_id)
    kept = ~is_p
    if dedupe_commits:
        dedupe_totals(tables, changed.where(F.col("kind") == "c"), touched, batch_id)
        kept = F.col("kind") == "t"
    tables.table_state.upsert(changed.where(kept), batch_id)

    # Description and commit totals of the touched tables, looked up by their keys.
    c = split_compacted(materialize(tables.table_state.current(batch_id, touched), f"touched-state-{batch_id}", scratch))
    latest = facts.latest_table_info(c.table_info)
    counts = tables.partition_counts.current(batch_id, touched)
    totals = tables.commit_totals.current(batch_id, touched) if dedupe_commits else c.totals
    assets = materialize(facts.table_level_assets(facts.table_with_partitions(latest, counts),
                                                  totals), f"touched-assets-{batch_id}", scratch)
    old_assets = tables.table_assets.current(batch_id - 1, touched)
    history = materialize(facts.table_groups(c.table_info)
                          .join(assets.select("table_id"), "table_id", "left_semi"),
                          f"touched-history-{batch_id}", scratch)
    group_deltas(tables, assets, old_assets, history, batch_id, scratch)
    tables.table_assets.upsert(assets, batch_id)
    if freeze_attributes:
        tables.table_sink.upsert(assets, batch_id, frozen=FROZEN)
    for table in tables.all():
        table.maintain(batch_id)
    for folder in scratch:
        remove_folder(changed.sparkSession, folder)


FROZEN = ("table_name", "domain", "creator", "namespace")


def write_jdbc(tables: AssetTables, batch_id: int, url: str, properties: dict, batch_size: int = 50) -> None:
    """The rows that a micro-batch changed, upserted into the four result tables of a database (K1-K5): of
    existing rows only the measures are replaced at table level, every non-key column at group level. Rows
    whose counts the ``int`` columns cannot hold are quarantined (``AssetTables.within_int``)."""
    def write(rows: DataFrame, name: str, schema: T.StructType, key: str, update: list[str]) -> None:
        JdbcTable(url, name, key, update, properties, batch_size) \
            .upsert(tables.within_int(rows, name, schema, batch_id), batch_id)

    sink = tables.table_assets if tables.table_sink.last_batch() is None else tables.table_sink
    measures = [f.name for f in TABLE_LEVEL_ASSETS.fields if f.name not in ("table_id", *FROZEN)]
    write(to_exact_schema(sink.batch_rows(batch_id), wide(TABLE_LEVEL_ASSETS)), "table_level_assets",
          TABLE_LEVEL_ASSETS, "table_id", measures)
    groups = tables.group_assets.batch_rows(batch_id)
    for level, name in (("namespace", "namespace_level_assets"), ("domain", "domain_level_assets"),
                        ("creator", "user_level_assets")):
        write(tables.as_level(groups, level), name, LEVELS[level], level,
              [f.name for f in LEVELS[level].fields if f.name != level])


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint: made at its first use and stored beside it. Batch ids
    count within one checkpoint only."""
    path = f"{checkpoint}/writer"
    try:
        return spark.read.parquet(path).first()["writer"]
    except AnalysisException:  # a new checkpoint
        name = uuid.uuid4().hex
        spark.createDataFrame([(name,)], "writer string").coalesce(1).write.parquet(path)
        return name


def start_quarantine(decoded_stream: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                     qualify_ids: bool = False):
    """Starts the stateless query that appends unusable envelopes and commits, with the
    reason, to ``base/quarantine`` (exactly-once file sink)."""
    bad_commits = quarantined(tagged_changes(decoded_stream, qualify_ids)).select(
        "problem", F.lit(DATA_COMMIT_INFO).alias("table_name"), "commit_op", "seq", "table_id", "commit_id",
        F.lit(None).cast("string").alias("raw"))
    rejects = rejected(decoded_stream, qualify_ids).withColumn("commit_id", F.lit(None).cast("string"))
    rows = rejects.select(*QUARANTINE.fieldNames()).unionByName(bad_commits.select(*QUARANTINE.fieldNames()))
    return (rows.writeStream.format("parquet").option("path", f"{base}/quarantine")
            .option("checkpointLocation", f"{checkpoint}/quarantine")
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def start(decoded_stream: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
          freeze_attributes: bool = False, qualify_ids: bool = False,
          jdbc: dict | None = None, dedupe_commits: bool = False):
    """Starts the asset query (one stateful aggregate, ``foreachBatch``); returns its handle.

    ``qualify_ids`` (D15) and ``dedupe_commits`` (D5) as in batch; the latter keeps a row per commit
    and must not change on a checkpoint. ``jdbc`` (url, properties): the result tables are
    also upserted into a database after each micro-batch. Without ``dedupe_commits`` the state counts a
    commit once per delivery; a source that repeats events goes through ``changelog.land_once`` first.

    ``trigger``: e.g. ``{"processingTime": "30 seconds"}`` (the reference's checkpoint
    interval) or ``{"availableNow": True}`` for catch-up runs and tests.
    """
    spark = decoded_stream.sparkSession
    use_rocksdb(spark)
    tables = AssetTables.at(spark, base, writer_of(spark, checkpoint))

    def each(df: DataFrame, batch_id: int) -> None:
        apply_batch(tables, df, batch_id, freeze_attributes, dedupe_commits)
        if jdbc is not None:
            write_jdbc(tables, batch_id, **jdbc)

    trig = trigger or {"processingTime": "30 seconds"}
    return (compaction_agg(tagged_changes(decoded_stream, qualify_ids), dedupe_commits).writeStream.outputMode("update")
            .option("checkpointLocation", f"{checkpoint}/assets")
            .foreachBatch(each)
            .trigger(**trig).start())


def run_available(decoded_stream: DataFrame, base: str, checkpoint: str,
                  freeze_attributes: bool = False, qualify_ids: bool = False,
                  dedupe_commits: bool = False) -> AssetTables:
    """Processes everything available now, in as many micro-batches as the source
    makes, and returns the result tables."""
    now = {"availableNow": True}
    for query in (start(decoded_stream, base, checkpoint, now, freeze_attributes, qualify_ids,
                        dedupe_commits=dedupe_commits),
                  start_quarantine(decoded_stream, base, checkpoint, now, qualify_ids)):
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    spark = decoded_stream.sparkSession
    return AssetTables.at(spark, base, writer_of(spark, checkpoint))
