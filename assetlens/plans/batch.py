"""The whole batch dataflow: routed change logs to the four asset tables.

Plan shape (README, "Plans and scale"): three compactions, each one exchange of its
change log with map-side partial aggregation (or, from a feed, one compaction of all of
them); two joins on ``table_id`` that reuse the aggregates' hash partitioning; the
table-level result materialized once (it feeds four consumers); three rollups with
partial aggregation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from assetlens.operators import facts, rollups
from assetlens.session import materialize


@dataclass
class AssetResults:
    table_assets: DataFrame       # J2 plus ``op``
    namespace_assets: DataFrame   # R1
    domain_assets: DataFrame      # R2
    user_assets: DataFrame        # R3
    quarantine: DataFrame         # commits that could not be counted
    rejects: DataFrame | None = None  # envelopes that could not be used (feeds only)
    unordered: DataFrame | None = None  # changes whose position does not order them (feeds only)


@dataclass
class Compacted:
    """One row per key of each change log: what the streaming state store holds."""
    table_info: DataFrame   # table_id, attrs, op, groups
    partitions: DataFrame   # table_id, partition_desc, deleted (last op was a delete)
    totals: DataFrame       # table_id, file_counts, file_total_size


def compact(table_info: DataFrame, partitions: DataFrame, commits: DataFrame,
            dedupe_commits: bool = False, keep: bool = False) -> tuple[Compacted, DataFrame]:
    """The three compactions, plus the quarantined commits. With ``keep`` the narrow
    per-commit stats (no file-op arrays) are written once, so the commit totals and the
    quarantine both read them instead of parsing the commit log twice."""
    stats = facts.commit_stats(commits)
    if keep:
        stats = materialize(stats.drop("file_ops"), "commit-stats")
    totals = facts.commit_totals(facts.signed_commit_deltas(stats, dedupe_commits))
    return (Compacted(facts.compact_table_info(table_info),
                      facts.compact_partitions(partitions), totals),
            facts.quarantine(stats))


def assets_from_compacted(c: Compacted) -> DataFrame:
    latest = facts.latest_table_info(c.table_info)
    counts = facts.live_partition_counts(c.partitions)
    return facts.table_level_assets(facts.table_with_partitions(latest, counts), c.totals)


def rollups_from(assets: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three rollups from one pass over the assets and one over the history."""
    hist = materialize(rollups.complete_history(groups, assets), "group-history")
    live = materialize(rollups.live_measures_by_level(assets), "group-measures")
    return (rollups.group_level_assets(live, hist, "namespace"),
            rollups.group_level_assets(live, hist, "domain"),
            rollups.user_level_assets(live, hist))


def compute_assets(table_info: DataFrame, partitions: DataFrame, commits: DataFrame,
                   dedupe_commits: bool = False, keep: bool = True) -> AssetResults:
    """Batch run over whole change logs.

    With ``keep`` the compacted table-info rows and the table-level assets are
    written once to the shared work folder (``spark.checkpoint.dir``) and read back:
    both feed several consumers, and a lost executor then costs a re-read of a small
    table instead of a replay of the change log.
    """
    c, quarantined = compact(table_info, partitions, commits, dedupe_commits, keep)
    if keep:
        c.table_info = materialize(c.table_info, "compacted-table-info")
    assets = assets_from_compacted(c)
    if keep:
        assets = materialize(assets, "table-assets")
    groups = facts.table_groups(c.table_info)
    ns, dom, user = rollups_from(assets, groups)
    return AssetResults(assets, ns, dom, user, quarantined)


def compute_assets_from_feed(decoded: DataFrame, dedupe_commits: bool = False, qualify_ids: bool = False,
                             at_least_once: bool = False) -> AssetResults:
    """Batch run over a decoded change feed (envelopes of all catalog tables).

    The feed is scanned and parsed **once** into narrow tagged rows, written to the shared
    work folder by kind; compactions, quarantine and rollups read those. The options:
    ``dedupe_commits`` (D5), ``qualify_ids`` (D15), and ``at_least_once`` for feeds that
    repeat changes (changes that are equal in everything, the position included, count once).
    """
    from assetlens.plans.compaction import compact_tagged, quarantined, tagged_changes
    from assetlens.sources.envelope import POSITION, rejected, with_position
    from assetlens.sources.order import unordered
    if at_least_once:
        decoded = with_position(decoded)
    tagged = tagged_changes(decoded, qualify_ids)
    if at_least_once:
        tagged = tagged.dropDuplicates([POSITION]).drop(POSITION)
    tagged = materialize(tagged, "tagged-feed", partition_by="kind")
    c = compact_tagged(tagged, dedupe_commits)
    c.table_info = materialize(c.table_info, "compacted-table-info")
    assets = materialize(assets_from_compacted(c), "table-assets")
    ns, dom, user = rollups_from(assets, facts.table_groups(c.table_info))
    return AssetResults(assets, ns, dom, user, quarantined(tagged), rejected(decoded, qualify_ids), unordered(tagged))
