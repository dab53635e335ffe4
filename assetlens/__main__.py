"""Command line: run the batch job over a change feed, or start the streaming job.

    python -m assetlens batch  --feed /feeds/catalog --out /lake/assets
    python -m assetlens stream --feed /feeds/catalog --out /lake/assets [--once]
    python -m assetlens stream --kafka-servers host:9092 --topics 'srv.public.*' --out /lake/assets
    python -m assetlens batch|stream ... --snapshot /exports/catalog [--splits /exports/splits.json]

Submit it with ``spark-submit`` on a cluster; ``spark.checkpoint.dir`` must name a
shared folder (the work folder of every job).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from assetlens.plans.batch import compute_assets_from_feed
from assetlens.schemas import RESULT_TABLES, to_exact_schema, wide
from assetlens.session import BASE_CONF
from assetlens.sources import changelog
from assetlens.sources.snapshot import bootstrap_stream, positions_of, read_positions, reconciled
from assetlens.streaming import job
from assetlens.streaming.versions import start_versions


def run_batch(spark: SparkSession, feed: str, out: str, snapshot: str | None = None, splits: str | None = None,
              **options) -> None:
    """Whole feed (after the snapshot, if there is one) to the four result tables and the quarantine, as
    parquet under ``out``; ``options`` as in ``compute_assets_from_feed``."""
    changes = changelog.read_changes(spark, feed)
    if snapshot:
        rows = changelog.read_changes(spark, snapshot)
        changes = reconciled(rows, changes, read_positions(spark, splits) if splits else positions_of(rows))
    r = compute_assets_from_feed(changes, **options)
    frames = {"table_level_assets": r.table_assets, "namespace_level_assets": r.namespace_assets,
              "domain_level_assets": r.domain_assets, "user_level_assets": r.user_assets}
    for name, df in frames.items():
        schema, _ = RESULT_TABLES[name]
        to_exact_schema(df, wide(schema)).write.mode("errorifexists").parquet(f"{out}/{name}")
    r.quarantine.write.mode("errorifexists").parquet(f"{out}/quarantine")
    r.rejects.write.mode("errorifexists").parquet(f"{out}/rejects")
    r.unordered.write.mode("errorifexists").parquet(f"{out}/unordered")


def run_stream(spark: SparkSession, out: str, feed: str | None, kafka: dict | None,
               once: bool, snapshot: str | None = None, jdbc: dict | None = None, splits: str | None = None,
               freeze_attributes: bool = False, qualify_ids: bool = False, at_least_once: bool = False,
               dedupe_commits: bool = False, versions: bool = False, ascending: bool = False) -> None:
    stream = changelog.read_change_stream(spark, path=feed, kafka=kafka)
    if snapshot:
        log = changelog.read_changes(spark, feed) if feed else changelog.read_changes_kafka(spark, kafka)
        stream = bootstrap_stream(spark, changelog.read_changes(spark, snapshot), log, stream, f"{out}/_bootstrap",
                                  read_positions(spark, splits) if splits else None)
    trigger = {"availableNow": True} if once else None
    checkpoint = f"{out}/_checkpoint"
    if at_least_once:  # each change is landed once, and the results follow what has landed
        landing = changelog.land_once(stream, f"{out}/_landed", f"{checkpoint}/landing", trigger, ascending)
        if once:
            landing.awaitTermination()
        stream = changelog.read_landed(spark, f"{out}/_landed", stream.schema)
    queries = [job.start(stream, base=out, checkpoint=checkpoint, trigger=trigger, jdbc=jdbc,
                         freeze_attributes=freeze_attributes, qualify_ids=qualify_ids, dedupe_commits=dedupe_commits),
               job.start_quarantine(stream, base=out, checkpoint=checkpoint, trigger=trigger, qualify_ids=qualify_ids)]
    if versions:
        queries.append(start_versions(stream, out, checkpoint, trigger, qualify_ids))
    if once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="assetlens")
    p.add_argument("mode", choices=["batch", "stream"])
    p.add_argument("--out", required=True, help="folder of the result tables")
    p.add_argument("--feed", help="folder of JSON envelope files")
    p.add_argument("--kafka-servers", help="Kafka bootstrap servers (stream mode)")
    p.add_argument("--topics", help="Kafka topic pattern (stream mode; required with --kafka-servers)")
    p.add_argument("--snapshot", help="folder of snapshot envelope files; the log is taken up where they end")
    p.add_argument("--splits", help="JSON lines: log positions before and after each split of the snapshot was read "
                                    "(default: each table's rows show the position they carry)")
    p.add_argument("--jdbc-url", help="also upsert the result tables into this PostgreSQL database (stream mode)")
    p.add_argument("--jdbc-user"), p.add_argument("--jdbc-password-env", help="environment variable of the password")
    p.add_argument("--once", action="store_true", help="stream: process what is there, then stop")
    p.add_argument("--qualify-ids", action="store_true", help="table ids are <schema>.<table_id> (several schemas)")
    p.add_argument("--at-least-once", action="store_true", help="the feed may repeat changes; each counts once")
    p.add_argument("--ascending", action="store_true", help="stream, with --at-least-once: positions have gaps of their "
                                                            "own and ascend but for repeats")
    p.add_argument("--dedupe-commits", action="store_true", help="of each commit the last change counts only")
    p.add_argument("--versions", action="store_true", help="stream: also append a row per change of a table")
    p.add_argument("--freeze-attributes", action="store_true", help="stream: table rows keep their first attributes")
    a = p.parse_args(argv)
    if a.mode == "batch" and (a.freeze_attributes or a.versions or a.ascending):
        p.error(f"not an option of {a.mode}")
    if spark is None:
        builder = SparkSession.builder.appName("assetlens")
        for key, value in BASE_CONF.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    if a.mode == "batch":
        if not a.feed:
            p.error("batch needs --feed")
        run_batch(spark, a.feed, a.out, a.snapshot, a.splits, dedupe_commits=a.dedupe_commits, qualify_ids=a.qualify_ids,
                  at_least_once=a.at_least_once)
        return
    kafka = None
    if a.kafka_servers:
        if not a.topics:
            p.error("--kafka-servers needs --topics")
        kafka = {"kafka.bootstrap.servers": a.kafka_servers, "subscribePattern": a.topics}
    elif not a.feed:
        p.error("stream needs --feed or --kafka-servers")
    jdbc = None
    if a.jdbc_url:
        jdbc = {"url": a.jdbc_url, "properties": {"user": a.jdbc_user or "", "driver": "org.postgresql.Driver",
                                                  "password": os.environ.get(a.jdbc_password_env or "", "")}}
    run_stream(spark, a.out, a.feed, kafka, a.once, a.snapshot, jdbc, a.splits, a.freeze_attributes, a.qualify_ids,
               a.at_least_once, a.dedupe_commits, a.versions, a.ascending)


if __name__ == "__main__":
    main()
