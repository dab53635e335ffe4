"""

Each takes ``(spark, sf_dir)``, reads the driver's tables through the fixture
bindings and returns a DataFrame whose column names match the oracle SQL of the same
key (``assetlens.oracle``). Keys that exercise streaming or sinks write into a fresh
folder under the shared work folder and return the table read back from storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.operators import facts, history
from assetlens.plans import batch
from assetlens.schemas import (DATA_COMMIT_INFO, DOMAIN_LEVEL_ASSETS, NAMESPACE_LEVEL_ASSETS, PARTITION_INFO, TABLE_INFO,
                               TABLE_LEVEL_ASSETS, USER_LEVEL_ASSETS, to_exact_schema)
from assetlens.session import fresh_dir
from assetlens.sources import changelog, envelope, snapshot
from assetlens.functions.fileops import decode_base64_text, parse_file_op
from assetlens.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]


def files_per_part(spark: SparkSession) -> int:
    """Files per part of a test feed (one part is one micro-batch of the file source): as
    many as the cluster shuffles with, so writing a part takes the whole cluster."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _logs(spark: SparkSession, sf_dir: str):
    return (fx.fx_table_info(spark, sf_dir), fx.fx_partition_info(spark, sf_dir),
            fx.fx_commit_changes(spark, sf_dir))


# ------------------------------------------------------------ fixture-level operators

def q_file_op_parse(spark, sf_dir):
    """F2 + F3: every file op of every commit, decoded from base64 and parsed."""
    ops = fx.fx_commit_changes(spark, sf_dir).select(
        "commit_id", F.explode("file_ops").alias("b64"))
    p = parse_file_op(decode_base64_text(F.col("b64")))
    return ops.select("commit_id", p["matched"].alias("matched"), p["path"].alias("path"),
                      p["action"].alias("action"), p["size"].alias("size"),
                      p["columns"].alias("columns"))


def q_commit_file_stats(spark, sf_dir):
    """A1: number and bytes of ``add`` ops per commit."""
    s = facts.commit_stats(fx.fx_commit_changes(spark, sf_dir))
    return s.select("table_id", "commit_id", "committed", "commit_op", "seq",
                    "file_count", "file_bytes")


def q_commit_totals(spark, sf_dir):
    """A2: signed running totals per table."""
    s = facts.commit_stats(fx.fx_commit_changes(spark, sf_dir))
    return facts.commit_totals(facts.signed_commit_deltas(s))


def q_live_partition_counts(spark, sf_dir):
    """A3: live distinct partitions per table."""
    return facts.live_partition_counts(facts.compact_partitions(fx.fx_partition_info(spark, sf_dir)))


def q_latest_table_info(spark, sf_dir):
    """Latest description per table."""
    return facts.latest_table_info(facts.compact_table_info(fx.fx_table_info(spark, sf_dir)))


def q_table_with_partitions(spark, sf_dir):
    """Latest description joined with the live partition count."""
    latest = q_latest_table_info(spark, sf_dir)
    return facts.table_with_partitions(latest, q_live_partition_counts(spark, sf_dir))


def q_table_level_assets(spark, sf_dir):
    """Table-level assets (with the last ``op``)."""
    c, _ = batch.compact(*_logs(spark, sf_dir))
    return batch.assets_from_compacted(c)


def _results(spark, sf_dir) -> batch.AssetResults:
    return batch.compute_assets(*_logs(spark, sf_dir))


def q_namespace_level_assets(spark, sf_dir):
    """R1 (+ R6, R7)."""
    return _results(spark, sf_dir).namespace_assets


def q_domain_level_assets(spark, sf_dir):
    """R2 (+ R6, R7)."""
    return _results(spark, sf_dir).domain_assets


def q_user_level_assets(spark, sf_dir):
    """R3 with R4, R5 (+ R6, R7)."""
    return _results(spark, sf_dir).user_assets


# ------------------------------------------------------------ change history

def _deltas(spark, sf_dir) -> DataFrame:
    """Signed deltas of the commit changes with their positions."""
    d_files, d_bytes = facts.signed_delta_columns()
    stats = facts.commit_stats(fx.fx_commit_changes(spark, sf_dir))
    return stats.select("table_id", "commit_id", "seq", d_files.alias("d_files"), d_bytes.alias("d_bytes"))


def q_commit_total_versions(spark, sf_dir):
    """A2 after each counted commit change."""
    return history.commit_total_versions(_deltas(spark, sf_dir))


def q_partition_count_versions(spark, sf_dir):
    """A3 after each partition change."""
    return history.partition_count_versions(fx.fx_partition_info(spark, sf_dir))


def q_table_asset_versions(spark, sf_dir):
    """The joined row after each change of any side."""
    return _table_versions(spark, sf_dir).drop("row")


def _table_versions(spark, sf_dir) -> DataFrame:
    return history.table_asset_versions(fx.fx_table_info(spark, sf_dir), fx.fx_partition_info(spark, sf_dir),
                                        _deltas(spark, sf_dir))


def _group_versions(spark, sf_dir, level: str) -> DataFrame:
    versions = _table_versions(spark, sf_dir)
    return history.group_asset_versions(history.group_steps(versions, fx.fx_table_info(spark, sf_dir)), level)


def q_namespace_asset_versions(spark, sf_dir):
    """R1, R6, R7 after each change of a table in the group."""
    return _group_versions(spark, sf_dir, "namespace")


def q_domain_asset_versions(spark, sf_dir):
    """R2, R6, R7 after each change of a table in the group."""
    return _group_versions(spark, sf_dir, "domain")


def q_user_asset_versions(spark, sf_dir):
    """R3 with R4, R5 (+ R6, R7) after each change of a table of the creator."""
    return _group_versions(spark, sf_dir, "creator")


# ------------------------------------------------------------ envelope-level operators

def _envelope_feed(spark, sf_dir) -> str:
    """The whole change feed of the fixtures written once as envelope text files."""
    path = fresh_dir(spark, "feed")
    changelog.write_feed(fx.fx_envelopes(spark, sf_dir), path)
    return path


def _size_or_null(arr):
    """Array size, null for a null array whatever the session's ANSI setting."""
    return F.when(arr.isNotNull(), F.size(arr)).cast("bigint")


def q_envelope_decode(spark, sf_dir):
    """S3 + S4: every usable envelope of the feed decoded (all tables, before routing)."""
    d = envelope.usable(changelog.read_changes(spark, _envelope_feed(spark, sf_dir)))
    return d.select("table_name", "commit_op", "seq",
                    F.col("before.table_id").alias("before_table_id"),
                    F.col("after.table_id").alias("after_table_id"),
                    _size_or_null(F.coalesce("after.file_ops", "before.file_ops"))
                    .alias("file_op_count"))


def q_row_image(spark, sf_dir):
    """The chosen image of each catalog-table change."""
    d = changelog.read_changes(spark, _envelope_feed(spark, sf_dir))
    ch = envelope.catalog_changes(d)
    return ch.select("table_name", "commit_op", "seq", "image_side",
                     F.col("img.table_id").alias("table_id"))


def _routed(spark, sf_dir):
    return envelope.route_all(changelog.read_changes(spark, _envelope_feed(spark, sf_dir)))


def q_route_table_info(spark, sf_dir):
    """P3 (+ P5)."""
    return _routed(spark, sf_dir)[0]


def q_route_partition_info(spark, sf_dir):
    """P2 (+ P5)."""
    return _routed(spark, sf_dir)[1]


def q_route_data_commit_info(spark, sf_dir):
    """P4 (+ P5, A1): routed commits with their folded file stats."""
    s = facts.commit_stats(_routed(spark, sf_dir)[2])
    return s.select("table_id", "commit_id", "committed", "commit_op", "seq",
                    "file_count", "file_bytes")


def q_cdc_scan(spark, sf_dir):
    """The feed read as a stream (file source, several micro-batches), catalog
    tables only, written to a parquet sink and read back."""
    feed = fresh_dir(spark, "feed")
    env = fx.fx_envelopes(spark, sf_dir)
    changelog.write_feed(env, feed, _seq_cuts(env, 3), files_per_part=files_per_part(spark))
    stream = changelog.read_change_stream(spark, f"{feed}/*",
                                          max_files_per_trigger=files_per_part(spark))
    out = fresh_dir(spark, "cdc_scan")
    q = (envelope.catalog_changes(stream)
         .select("table_name", "commit_op", "seq", F.col("img.table_id").alias("table_id"))
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"{out}-checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def _seq_cuts(envelopes: DataFrame, parts: int) -> list[int]:
    """Log positions that split the feed into ``parts`` ranges of about equal width.
    One small aggregate (two numbers) comes to the driver."""
    r = envelopes.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    lo, hi = int(r["lo"]), int(r["hi"])
    return [lo + (hi - lo) * i // parts for i in range(1, parts)]


def orders_mid(spark, sf_dir) -> int:
    """The snapshot position of the bootstrap fixture: the middle order key."""
    r = fx.table(spark, sf_dir, "orders").agg(F.min("o_orderkey").alias("lo"),
                                              F.max("o_orderkey").alias("hi")).first()
    return (int(r["lo"]) + int(r["hi"])) // 2


def q_snapshot_bootstrap(spark, sf_dir):
    """The three catalog tables as they stood at the snapshot position (exported as
    files), read as ``read`` changes ahead of the later log; routed rows of all three."""
    cut = orders_mid(spark, sf_dir)
    ti, pi, ci = _logs(spark, sf_dir)
    before = F.col("seq") <= cut
    state = {
        TABLE_INFO: facts.compact_table_info(ti.where(before)).where(facts.not_delete(F.col("op")))
        .select("table_id", "attrs.*"),
        PARTITION_INFO: facts.compact_partitions(pi.where(before)).where(~F.col("deleted"))
        .select("table_id", "partition_desc"),
        DATA_COMMIT_INFO: ci.where(before & facts.not_delete(F.col("commit_op")))
        .select("table_id", "commit_id", "file_ops", "committed"),
    }
    snapshots = {}
    for name, rows in state.items():
        export = fresh_dir(spark, f"snapshot-{name}")
        rows.write.parquet(export)
        snapshots[name] = changelog.read_snapshot_files(spark, export)
    log = fx.table_info_envelopes(ti).unionByName(fx.partition_envelopes(pi)).unionByName(fx.commit_envelopes(ci))
    path = fresh_dir(spark, "feed")
    changelog.write_feed(changelog.bootstrap(changelog.snapshot_feed(snapshots, cut), log, cut), path)
    t, p, c = envelope.route_all(changelog.read_changes(spark, path))
    rows = None
    for name, routed, detail in ((TABLE_INFO, t, "table_namespace"), (PARTITION_INFO, p, "partition_desc"),
                                 (DATA_COMMIT_INFO, c, "commit_id")):
        part = routed.select(F.lit(name).alias("table_name"), "table_id", F.col(detail).alias("detail"),
                             "commit_op", "seq")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _split_positions(spark, sf_dir) -> DataFrame:
    """Positions of a snapshot in four splits a table, each read at a position of its own: between
    a fifth and a half of the orders' log, later for the later tables; the positions before and after
    are a twentieth apart."""
    top = fx.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    rows = [(name, 4, split, high - top // 20, high) for t, name in enumerate((TABLE_INFO, PARTITION_INFO, DATA_COMMIT_INFO))
            for split in range(4) for high in [top * (2 + split) // 10 + 100 * t]]
    return spark.createDataFrame(rows, snapshot.POSITIONS)


def q_snapshot_reconciled(spark, sf_dir):
    """A snapshot whose splits were read at different positions, and the log that goes on
    meanwhile, reconciled; routed rows of all three tables."""
    log = changelog.read_changes(spark, _envelope_feed(spark, sf_dir))
    positions = _split_positions(spark, sf_dir)
    export = fresh_dir(spark, "snapshot")
    moments = positions.withColumn("high", F.col("high") - F.floor((F.col("high") - F.col("low")) / 2))
    snapshot.write_envelopes(snapshot.state_at(log, moments), export)
    feed = snapshot.reconciled(changelog.read_changes(spark, export), log, positions)
    img = F.col("img")
    detail = F.when(F.col("table_name") == TABLE_INFO, img["table_namespace"]) \
        .when(F.col("table_name") == PARTITION_INFO, img["partition_desc"]).otherwise(img["commit_id"])
    return envelope.catalog_changes(feed).select("table_name", img["table_id"].alias("table_id"), detail.alias("detail"),
                                                 "commit_op", "seq")


def _feed_results(spark, sf_dir) -> batch.AssetResults:
    """The batch job over the envelope feed, scanned and parsed once."""
    return batch.compute_assets_from_feed(
        changelog.read_changes(spark, _envelope_feed(spark, sf_dir)))


def q_commit_quarantine(spark, sf_dir):
    """Commits that cannot be counted, from the envelope feed."""
    return _feed_results(spark, sf_dir).quarantine


def q_envelope_rejects(spark, sf_dir):
    """S3: broken envelopes and changes without position, operation or table id."""
    return envelope.rejected(changelog.read_changes(spark, _envelope_feed(spark, sf_dir)))


def q_feed_table_level_assets(spark, sf_dir):
    """J2 from the envelope feed with the one-pass compaction."""
    return _feed_results(spark, sf_dir).table_assets


def q_feed_namespace_level_assets(spark, sf_dir):
    return _feed_results(spark, sf_dir).namespace_assets


def q_feed_domain_level_assets(spark, sf_dir):
    return _feed_results(spark, sf_dir).domain_assets


def q_feed_user_level_assets(spark, sf_dir):
    return _feed_results(spark, sf_dir).user_assets


# ------------------------------------------------------------ sinks and streaming

def _two_batch_sink(spark, sf_dir, frozen: tuple[str, ...] = ()):
    """The results of the first half of the logs, then of the whole logs, through the
    upsert sinks. The second write has the new and the changed rows only: the sink must
    keep the rest, replace the changed and insert the new."""
    from assetlens.streaming.job import AssetTables, group_rows
    cut = orders_mid(spark, sf_dir)
    tables = AssetTables.at(spark, fresh_dir(spark, "sink"))
    seen = None
    for batch_id, logs in enumerate((
            [log.where(F.col("seq") <= cut) for log in _logs(spark, sf_dir)], _logs(spark, sf_dir))):
        r = batch.compute_assets(*logs)
        rows = (r.table_assets.drop("op"), group_rows(r.namespace_assets, r.domain_assets, r.user_assets))
        if seen is not None:
            rows = tuple(new.exceptAll(old) for new, old in zip(rows, seen))
        seen = rows
        tables.table_sink.upsert(rows[0], batch_id, frozen=frozen)
        tables.group_assets.upsert(rows[1], batch_id)
    return tables


def q_upsert_table_assets(spark, sf_dir):
    return to_exact_schema(_two_batch_sink(spark, sf_dir).table_level_assets(), TABLE_LEVEL_ASSETS)


def q_upsert_frozen_table_assets(spark, sf_dir):
    """Existing rows keep their first attributes, only measures are replaced."""
    from assetlens.streaming.job import FROZEN
    return to_exact_schema(_two_batch_sink(spark, sf_dir, FROZEN).table_level_assets(), TABLE_LEVEL_ASSETS)


def q_upsert_namespace_assets(spark, sf_dir):
    return to_exact_schema(_two_batch_sink(spark, sf_dir).level_assets("namespace"), NAMESPACE_LEVEL_ASSETS)


def q_upsert_domain_assets(spark, sf_dir):
    return to_exact_schema(_two_batch_sink(spark, sf_dir).level_assets("domain"), DOMAIN_LEVEL_ASSETS)


def q_upsert_user_assets(spark, sf_dir):
    return to_exact_schema(_two_batch_sink(spark, sf_dir).level_assets("creator"), USER_LEVEL_ASSETS)


def _stream_run(spark, sf_dir):
    """The whole feed as 4 parts in log order, consumed by the streaming job with
    ``availableNow`` and one part per micro-batch."""
    from assetlens.streaming import job
    env = fx.fx_envelopes(spark, sf_dir)
    feed = fresh_dir(spark, "feed")
    changelog.write_feed(env, feed, _seq_cuts(env, 4), files_per_part=files_per_part(spark))
    stream = changelog.read_change_stream(spark, f"{feed}/*",
                                          max_files_per_trigger=files_per_part(spark))
    base = fresh_dir(spark, "stream")
    return job.run_available(stream, base, f"{base}-checkpoint")


def q_stream_table_assets(spark, sf_dir):
    return to_exact_schema(_stream_run(spark, sf_dir).table_level_assets(), TABLE_LEVEL_ASSETS)


def q_stream_namespace_assets(spark, sf_dir):
    return to_exact_schema(_stream_run(spark, sf_dir).level_assets("namespace"), NAMESPACE_LEVEL_ASSETS)


def q_stream_domain_assets(spark, sf_dir):
    return to_exact_schema(_stream_run(spark, sf_dir).level_assets("domain"), DOMAIN_LEVEL_ASSETS)


def q_stream_user_assets(spark, sf_dir):
    return to_exact_schema(_stream_run(spark, sf_dir).level_assets("creator"), USER_LEVEL_ASSETS)


def q_stream_table_asset_versions(spark, sf_dir):
    """The joined row after each change, by the streaming job in 4 micro-batches."""
    from assetlens.streaming import versions
    feed = fresh_dir(spark, "feed")
    changelog.write_feed(fx.fx_envelopes(spark, sf_dir), feed, lambda env: _seq_cuts(env, 4),
                         files_per_part=files_per_part(spark))
    stream = changelog.read_change_stream(spark, f"{feed}/*", max_files_per_trigger=files_per_part(spark))
    base = fresh_dir(spark, "stream")
    query = versions.start_versions(stream, base, f"{base}-checkpoint", {"availableNow": True})
    query.awaitTermination()
    return versions.read_versions(spark, base)


QUERIES: dict[str, Query] = {
    "file_op_parse": q_file_op_parse,
    "commit_file_stats": q_commit_file_stats,
    "commit_totals": q_commit_totals,
    "live_partition_counts": q_live_partition_counts,
    "latest_table_info": q_latest_table_info,
    "table_with_partitions": q_table_with_partitions,
    "table_level_assets": q_table_level_assets,
    "namespace_level_assets": q_namespace_level_assets,
    "domain_level_assets": q_domain_level_assets,
    "user_level_assets": q_user_level_assets,
    "commit_total_versions": q_commit_total_versions,
    "partition_count_versions": q_partition_count_versions,
    "table_asset_versions": q_table_asset_versions,
    "namespace_asset_versions": q_namespace_asset_versions,
    "domain_asset_versions": q_domain_asset_versions,
    "user_asset_versions": q_user_asset_versions,
    "envelope_decode": q_envelope_decode,
    "row_image": q_row_image,
    "route_table_info": q_route_table_info,
    "route_partition_info": q_route_partition_info,
    "route_data_commit_info": q_route_data_commit_info,
    "cdc_scan": q_cdc_scan,
    "snapshot_bootstrap": q_snapshot_bootstrap,
    "snapshot_reconciled": q_snapshot_reconciled,
    "feed_table_level_assets": q_feed_table_level_assets,
    "feed_namespace_level_assets": q_feed_namespace_level_assets,
    "feed_domain_level_assets": q_feed_domain_level_assets,
    "feed_user_level_assets": q_feed_user_level_assets,
    "commit_quarantine": q_commit_quarantine,
    "envelope_rejects": q_envelope_rejects,
    "upsert_table_assets": q_upsert_table_assets,
    "upsert_frozen_table_assets": q_upsert_frozen_table_assets,
    "upsert_namespace_assets": q_upsert_namespace_assets,
    "upsert_domain_assets": q_upsert_domain_assets,
    "upsert_user_assets": q_upsert_user_assets,
    "stream_table_level_assets": q_stream_table_assets,
    "stream_namespace_level_assets": q_stream_namespace_assets,
    "stream_domain_level_assets": q_stream_domain_assets,
    "stream_user_level_assets": q_stream_user_assets,
    "stream_table_asset_versions": q_stream_table_asset_versions,
}
