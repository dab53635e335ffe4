"""Per-table facts: latest description (J0), live partitions (A3), commit totals (A2),
and the two inner joins that assemble table-level assets (J1, J2).

Each measure is split into a *compaction* (change log to one row per key, a single
aggregate with map-side partial aggregation) and a *finish* (compacted rows to the
measure). Batch jobs run both; the streaming job keeps the compaction in its state
store and runs the finish inside ``foreachBatch``.

All aggregates and joins key on ``table_id`` (partitions on ``(table_id,
partition_desc)`` first, which spreads one huge table over many tasks), so the
exchanges produced for the aggregates are reused by the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlens.functions.fileops import action_and_size, file_stats_columns, fold_file_stats
from assetlens.schemas import OP_DELETE

ATTRS = ("table_name", "table_namespace", "domain", "creator")


def not_delete(op: Column) -> Column:
    """True unless the operation is a delete."""
    return op != F.lit(OP_DELETE)


def place() -> Column:
    """The order of a change among changes of one key, a struct: its log position; at the same position
    (D13: an input error that ``sources.order`` reports) deletes come last, then a hash decides, so
    results never depend on the order of input rows."""
    others = [F.col(a) for a in (*ATTRS, "commit_id")]
    return F.struct("seq", (F.col("commit_op") == F.lit(OP_DELETE)).alias("last"),
                    F.xxhash64("commit_op", *others).alias("tie"))


def live_place(order: Column) -> Column:
    """``place`` of non-delete changes; null for deletes, which ``max_by`` skips."""
    return F.when(not_delete(F.col("commit_op")), order)


# ---------------------------------------------------------------- J0: latest table_info

def latest_table_info_agg() -> list[Column]:
    """Aggregate expressions of J0 over ``table_info`` changes grouped by ``table_id``.

    ``attrs``: the attributes of the last non-delete change (a delete image may carry
    the key only, D12). ``op``: the last operation. ``groups``: every
    (namespace, domain, creator) the table ever had outside deletes, the history that
    keeps group rows and "ever seen" counts (R4, R5, R7); it grows only with moves.
    """
    attrs = F.struct(*[F.col(a) for a in ATTRS])
    group = F.struct(F.col("table_namespace").alias("namespace"), "domain", "creator")
    order = F.col("place")
    return [
        F.max_by(attrs, live_place(order)).alias("attrs"),
        F.max_by(F.col("commit_op"), order).alias("op"),
        F.collect_set(F.when(not_delete(F.col("commit_op")), group)).alias("groups"),
    ]


def placed(changes: DataFrame) -> DataFrame:
    """``changes`` of one log with their ``place``; columns that the log lacks count as null."""
    missing = {c: F.lit(None).cast("string") for c in (*ATTRS, "commit_id") if c not in changes.columns}
    return changes.withColumns(missing).withColumn("place", place()) if missing else changes.withColumn("place", place())


def compact_table_info(table_info: DataFrame) -> DataFrame:
    return placed(table_info).groupBy("table_id").agg(*latest_table_info_agg())


def latest_table_info(compacted: DataFrame) -> DataFrame:
    """J0 finish: (table_id, table_name, namespace, domain, creator, op)."""
    a = F.col("attrs")
    return compacted.select(
        "table_id", a["table_name"].alias("table_name"), a["table_namespace"].alias("namespace"),
        a["domain"].alias("domain"), a["creator"].alias("creator"), "op")


def table_groups(compacted: DataFrame) -> DataFrame:
    """History of group memberships: distinct (table_id, namespace, domain, creator)."""
    return compacted.select("table_id", F.explode("groups").alias("g")).select(
        "table_id", F.col("g.namespace").alias("namespace"), F.col("g.domain").alias("domain"),
        F.col("g.creator").alias("creator"))


# ---------------------------------------------------------------- A3: live partitions

def last_is_delete() -> Column:
    """Aggregate: whether the last operation was a delete; at the same position a delete is the last."""
    is_delete = F.col("commit_op") == F.lit(OP_DELETE)
    gone, live = F.max(F.when(is_delete, F.col("seq"))), F.max(F.when(~is_delete, F.col("seq")))
    return gone.isNotNull() & (live.isNull() | (gone >= live))


def compact_partitions(partitions: DataFrame) -> DataFrame:
    """A3 inner half (P6 included): per (table_id, partition_desc), whether the last
    operation was a delete. Two last positions are a fixed-width aggregation
    buffer, so this, the largest aggregate, runs as a hash aggregate with map-side
    partial aggregation (a string or struct buffer would force a sort-based aggregate)."""
    return (partitions.where(F.col("partition_desc").isNotNull())
            .groupBy("table_id", "partition_desc").agg(last_is_delete().alias("deleted")))


def live_partition_counts(compacted: DataFrame) -> DataFrame:
    """A3 outer half: (table_id, partition_counts); a deleted partition stops counting (D8),
    a table whose partitions are all deleted counts 0 (D9)."""
    return compacted.groupBy("table_id").agg(
        F.count_if(~F.col("deleted")).cast("bigint").alias("partition_counts"))


# ---------------------------------------------------------------- A1 + A2: commit totals

def commit_stats(commits: DataFrame) -> DataFrame:
    """A1 on each commit: adds ``file_count``, ``file_bytes`` and ``problem`` columns.

    Three projections: the ops are parsed once into a column, folded once in one pass,
    and the fold's fields read out. The optimizer does not inline a costly expression
    into several uses, so nothing is evaluated twice.
    """
    cols = commits.columns
    parsed = commits.select(*cols, action_and_size(F.col("file_ops")).alias("__ops"))
    folded = parsed.select(*cols, fold_file_stats(F.col("__ops")).alias("__fold"))
    count, size, problem = file_stats_columns(F.col("__fold"), F.col("file_ops"))
    return folded.select(*cols, count.alias("file_count"), size.alias("file_bytes"),
                         problem.alias("problem"))


def quarantine(stats: DataFrame) -> DataFrame:
    """Commits that cannot be counted (D10, D11), with the reason."""
    return stats.where(F.col("problem").isNotNull()).select(
        "table_id", "commit_id", "commit_op", "seq", "problem")


def signed_commit_deltas(stats: DataFrame, dedupe_commits: bool = False) -> DataFrame:
    """A2 rule per commit change, as signed deltas (table_id, d_files, d_bytes).

    A delete subtracts (even if never committed, D6); any other operation adds when
    committed (P7); a quarantined commit counts nothing. Changes that do not count
    keep their row with null deltas instead of being filtered out: a filter here
    would be pushed below the A1 projection and evaluate the fold once more per use.
    ``commit_totals`` drops the tables without any counted change, so an uncommitted
    commit still cannot make a table appear in J2. With ``dedupe_commits`` only the
    last change of each ``commit_id`` counts (D5 option, ``last_contribution``).
    """
    if dedupe_commits:
        d_files, d_bytes = signed_delta_columns()
        return (placed(stats).withColumns({"d_files": d_files, "d_bytes": d_bytes}).groupBy("table_id", "commit_id")
                .agg(*last_contribution()).drop("commit_id"))
    d_files, d_bytes = signed_delta_columns()
    return stats.select("table_id", d_files.alias("d_files"), d_bytes.alias("d_bytes"))


def signed_delta_columns() -> tuple[Column, Column]:
    """(d_files, d_bytes) of one commit change from ``commit_op``, ``committed``,
    ``file_count``, ``file_bytes`` and ``problem``: null when the change does not count."""
    is_delete = F.col("commit_op") == F.lit(OP_DELETE)
    counts = F.col("problem").isNull() & (is_delete | F.col("committed"))
    sign = F.when(is_delete, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
    return (F.when(counts, sign * F.col("file_count")),
            F.when(counts, sign * F.col("file_bytes")))


def last_contribution() -> list[Column]:
    """``d_files``, ``d_bytes`` of the last change of a commit, over its ``placed`` changes. Zero if that is
    a delete or counts nothing but an earlier one counted, so a table that had a counted commit
    keeps its row; null if no change ever counted."""
    ever = F.max(F.col("d_files").isNotNull())
    zero = F.lit(0).cast("bigint")
    return [F.when(ever, F.coalesce(F.max_by(F.when(not_delete(F.col("commit_op")), F.col(d)), F.col("place")), zero)).alias(d)
            for d in ("d_files", "d_bytes")]


def commit_totals(deltas: DataFrame) -> DataFrame:
    """A2: (table_id, file_counts, file_total_size), running signed totals over the
    counted changes; a table without any counted change has no row."""
    return (deltas.groupBy("table_id")
            .agg(F.sum("d_files").cast("bigint").alias("file_counts"),
                 F.sum("d_bytes").cast("bigint").alias("file_total_size"))
            .where(F.col("file_counts").isNotNull()))


# ---------------------------------------------------------------- J1, J2

def table_with_partitions(latest: DataFrame, partition_counts: DataFrame) -> DataFrame:
    """Inner join of the latest description with the live partition count."""
    return latest.join(partition_counts, "table_id", "inner")


def table_level_assets(with_partitions: DataFrame, totals: DataFrame) -> DataFrame:
    """(table_id, table_name, domain, creator, namespace, op, partition_counts,
    file_counts, file_total_size). A table without partitions or counted commits is absent."""
    return with_partitions.join(totals, "table_id", "inner").select(
        "table_id", "table_name", "domain", "creator", "namespace", "op",
        "partition_counts", "file_counts", "file_total_size")
