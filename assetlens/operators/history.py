"""Change history of every keyed result: one row per change, in the order of the log.

The results elsewhere are last states. Here each counted change gives the value that holds right
after it: totals of a table after each commit (A2), live partitions after each partition change
(A3), the joined table row after any change of its three sides (J1, J2), and the group rows after
each change of a table in the group (R1-R7). All of it is prefix aggregates
(``operators.prefix``): no window is over a table or a group alone, so a table with a third of
all commits, or a namespace with a third of all tables, is spread over ranges of positions.

Order: by log position, then by log (``table_info``, ``partition_info``, ``data_commit_info``:
``side`` 0, 1, 2), then by the row changed (``row``), for groups then by table. The positions of one log are
unique but for the rows of a snapshot (D13, ``sources.order`` finds other ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.operators.facts import ATTRS, not_delete
from assetlens.operators.prefix import running
from assetlens.session import materialize

GROUP = ("namespace", "domain", "creator")
MEASURES = ("partition_counts", "file_counts", "file_total_size")


def commit_total_versions(deltas: DataFrame) -> DataFrame:
    """A2 after each counted commit change. ``deltas``: table_id, commit_id, seq, d_files, d_bytes (null where a
    change does not count). Gives table_id, seq, file_counts, file_total_size."""
    # Chosen from the written table: a filter before it would be pushed below the fold of the file ops and fold them again.
    counted = materialize(deltas.select(
        "table_id", "commit_id", "seq", F.col("d_files").alias("file_counts"), F.col("d_bytes").alias("file_total_size")),
        "counted-commits").where(F.col("file_counts").isNotNull())
    return running(counted, ["table_id"], ["seq", "commit_id"], sums=["file_counts", "file_total_size"]).drop("commit_id")


def partition_transitions(partitions: DataFrame) -> DataFrame:
    """What each partition change does to its table's live partitions: table_id, partition_desc, seq, live, d
    (+1, 0 or -1). A partition that lives is not added again, one that does not is not removed again (D8, D9)."""
    changes = materialize(partitions.where(F.col("partition_desc").isNotNull()).select(
        "table_id", "partition_desc", "seq", not_delete(F.col("commit_op")).cast("bigint").alias("live"),
        not_delete(F.col("commit_op")).cast("bigint").alias("was")), "partition-changes")
    # At the same position a delete comes last, as everywhere.
    changes = changes.withColumn("gone", 1 - F.col("live"))
    known = running(changes, ["table_id", "partition_desc"], ["seq", "gone"], previous=["was"])
    return known.select("table_id", "partition_desc", "seq", "gone", (F.col("live") - F.coalesce("was", F.lit(0).cast("bigint"))).alias("d"))


def partition_count_versions(partitions: DataFrame) -> DataFrame:
    """A3 after each partition change, one that changes nothing included: table_id, seq,
    partition_counts."""
    steps = materialize(partition_transitions(partitions).withColumnRenamed("d", "partition_counts"), "partition-steps")
    return running(steps, ["table_id"], ["seq", "partition_desc", "gone"], sums=["partition_counts"]) \
        .select("table_id", "seq", "partition_counts")


def described_row():
    """Tells descriptions of a table at one position apart; a delete comes last, as everywhere."""
    return F.concat_ws("/", (~not_delete(F.col("commit_op"))).cast("string"), *ATTRS)


def _events(table_info: DataFrame, partitions: DataFrame, deltas: DataFrame) -> DataFrame:
    """The three logs as one: table_id, seq, side, row (what tells changes of a side at one position apart), attrs and op (descriptions), steps of the three
    measures, and which side the change is of: -1 for a commit change that counts nothing, which a filter
    here would find by folding its file ops once more."""
    none, zero = F.lit(None), F.lit(0).cast("bigint")
    attrs = F.struct(F.col("table_name").alias("table_name"), F.col("table_namespace").alias("namespace"),
                     F.col("domain").alias("domain"), F.col("creator").alias("creator"))

    def side(df: DataFrame, number: int, row, described=none, op=none, steps=(zero, zero, zero), counts=F.lit(True)) -> DataFrame:
        return df.select("table_id", "seq", F.when(counts, F.lit(number)).otherwise(F.lit(-1)).alias("side"), row.alias("row"),
                         F.when(F.lit(True), described).cast("struct<table_name:string,namespace:string,domain:string,creator:string>")
                         .alias("attrs"), F.when(F.lit(True), op).cast("string").alias("op"),
                         *[s.cast("bigint").alias(m) for m, s in zip(MEASURES, steps)],
                         *[F.lit(int(number == n)).cast("bigint").alias(f"n{n}") for n in range(3)])

    described = side(table_info, 0, described_row(), F.when(not_delete(F.col("commit_op")), attrs), F.col("commit_op"))
    placed = side(partition_transitions(partitions), 1, F.concat_ws("/", "partition_desc", "gone"), steps=(F.col("d"), zero, zero))
    counted = side(deltas, 2, F.col("commit_id"), steps=(zero, F.col("d_files"), F.col("d_bytes")), counts=F.col("d_files").isNotNull())
    return described.unionByName(placed).unionByName(counted)


VERSION = ["table_id", "seq", "side", "row", "table_name", *GROUP, "op", *MEASURES]


def table_asset_versions(table_info: DataFrame, partitions: DataFrame, deltas: DataFrame) -> DataFrame:
    """J1, J2 after each change of any of the three logs: the change's side with the last known
    values of the other two; no row before all three are known. Columns ``VERSION``."""
    events = materialize(_events(table_info, partitions, deltas), "table-events").where("side >= 0")
    known = running(events, ["table_id"], ["seq", "side", "row"], sums=[*MEASURES, "n0", "n1", "n2"], latest=["attrs", "op"])
    return known.where("n0 > 0 AND n1 > 0 AND n2 > 0").select(
        "table_id", "seq", "side", "row", "attrs.table_name", *[F.col(f"attrs.{g}").alias(g) for g in GROUP], "op", *MEASURES)


def group_steps(versions: DataFrame, table_info: DataFrame) -> DataFrame:
    """What each change of a table does to its groups: per level (``GROUP``) and group, position and
    table, the steps of the table count and the measures and of the ever-seen domains and namespaces (creator level).

    A version takes away what the version before it of the same table had added (R6, D4) and adds its
    own unless the table is deleted (R7). The groups that a table was in before it was complete
    appear, unchanged, at its first version, as do the domains and namespaces seen there (D16).
    """
    zero = F.lit(0).cast("bigint")
    at = ["seq", "side", "row", "table_id"]
    held = F.struct(F.lit(1).cast("bigint").alias("table_counts"), *MEASURES, *GROUP, not_delete(F.col("op")).alias("live"))
    rows = materialize(versions.select(*at, held.alias("now"), held.alias("before")), "table-versions")
    pairs = materialize(running(rows, ["table_id"], ["seq", "side", "row"], previous=["before"]), "version-pairs")
    first = pairs.groupBy("table_id").agg(F.min(F.struct("seq", "side", "row")).alias("first"))
    measures = ["table_counts", *MEASURES]

    def levels(df: DataFrame, row: str, sign: int) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(g).alias("level"), F.col(f"{row}.{g}").alias("group_key")) for g in GROUP]))
        return df.select(*at, each.alias("g"), *[(F.col(f"{row}.{m}") * sign).alias(m) for m in measures]) \
            .select("g.level", "g.group_key", *at, *measures, zero.alias("domain_counts"), zero.alias("namespace_counts"))

    steps = levels(pairs.where("now.live"), "now", 1).unionByName(levels(pairs.where("before.live"), "before", -1))
    # Memberships outside deletes, at their own position or at the first version, whichever is later.
    own = F.struct(F.col("seq"), F.lit(0).alias("side"), described_row().alias("row"))
    seen = (table_info.where(not_delete(F.col("commit_op"))).join(first, "table_id")
            .select("table_id", F.greatest(own, F.col("first")).alias("p"), F.col("table_namespace").alias("namespace"),
                    "domain", "creator")
            .select("p.seq", "p.side", "p.row", "table_id", F.struct(zero.alias("table_counts"), *[zero.alias(m) for m in MEASURES],
                                                            *GROUP).alias("now")))
    steps = steps.unionByName(levels(seen, "now", 1))
    for level in ("domain", "namespace"):  # ever seen: the first position of a value counts 1
        firsts = (seen.where(F.col(f"now.{level}").isNotNull()).groupBy(F.col("now.creator").alias("group_key"), F.col(f"now.{level}"))
                  .agg(F.min(F.struct(*at)).alias("p")))
        one = {f"{other}_counts": F.lit(int(other == level)).cast("bigint") for other in ("domain", "namespace")}
        steps = steps.unionByName(firsts.select(F.lit("creator").alias("level"), "group_key", "p.*",
                                                *[zero.alias(m) for m in measures], *[c.alias(n) for n, c in one.items()]))
    sums = [*measures, "domain_counts", "namespace_counts"]
    return (steps.where(F.col("group_key").isNotNull()).groupBy("level", "group_key", *at)
            .agg(*[F.sum(m).cast("bigint").alias(m) for m in sums]))


def group_asset_versions(steps: DataFrame, level: str) -> DataFrame:
    """R1, R2, R3 (``level`` namespace, domain or creator) after each change of a table in the group: the
    group, seq, side, table_id (the change), and the columns of the level's result table."""
    counts = [*(("domain_counts", "namespace_counts") if level == "creator" else ()), "table_counts", *MEASURES]
    own = materialize(steps.where(F.col("level") == level).select(F.col("group_key").alias(level), "seq", "side", "row", "table_id",
                                                                 *counts), "group-steps")
    return running(own, [level], ["seq", "side", "row", "table_id"], sums=counts).drop("row")
