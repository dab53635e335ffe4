"""Group rollups of table-level assets: namespace (R1), domain (R2), creator.

Measures count each live table once, in its current group (D4). The set of group rows
comes from the history of complete tables (a table that appears in table-level
assets): a group keeps its row, with zeros, once every table left it or was deleted
(R7). Creators also count the distinct domains and namespaces ever seen among their
complete tables (R4, R5).

Everything is a plain grouped aggregate with partial aggregation, so a group holding
a third of all tables costs one partial row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.operators.facts import not_delete

MEASURES = ("table_counts", "partition_counts", "file_counts", "file_total_size")


LEVELS = ("namespace", "domain", "creator")


def live_measures_by_level(assets: DataFrame) -> DataFrame:
    """Totals over live tables (P9) for all three groupings in one pass: each live table
    becomes one row per level, and one aggregate keyed by (level, group_key) sums them."""
    groups = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("group_key"))
                                 for level in LEVELS]))
    rows = assets.where(not_delete(F.col("op"))).select(
        groups.alias("g"), "partition_counts", "file_counts", "file_total_size")
    return (rows.select("g.*", "partition_counts", "file_counts", "file_total_size")
            .where(F.col("group_key").isNotNull()).groupBy("level", "group_key")
            .agg(F.count(F.lit(1)).cast("bigint").alias("table_counts"),
                 F.sum("partition_counts").cast("bigint").alias("partition_counts"),
                 F.sum("file_counts").cast("bigint").alias("file_counts"),
                 F.sum("file_total_size").cast("bigint").alias("file_total_size")))


def complete_history(groups: DataFrame, assets: DataFrame) -> DataFrame:
    """Group memberships of complete tables only (left-semi join on ``table_id``)."""
    return groups.join(assets.select("table_id"), "table_id", "left_semi")


def _with_zero_rows(keys: DataFrame, live: DataFrame, key: str, extra: tuple = ()) -> DataFrame:
    """Every historical group, its live totals or zeros."""
    own = live.where(F.col("level") == F.lit(key)).select(F.col("group_key").alias(key), *MEASURES)
    return keys.join(own, key, "left").select(
        key, *extra, *[F.coalesce(F.col(m), F.lit(0).cast("bigint")).alias(m) for m in MEASURES])


def group_level_assets(live: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """R1 / R2 (key ``namespace`` / ``domain``): (key, table_counts, partition_counts,
    file_counts, file_total_size), from ``live_measures_by_level`` and the history of
    complete tables. A table without a group (null) is in no rollup of that level."""
    keys = history.select(key).where(F.col(key).isNotNull()).distinct()
    return _with_zero_rows(keys, live, key)


def user_level_assets(live: DataFrame, history: DataFrame) -> DataFrame:
    """R3 with R4, R5: (creator, domain_counts, namespace_counts, table_counts,
    partition_counts, file_counts, file_total_size)."""
    # Two distinct counts: Catalyst expands the rows per distinct column and
    # aggregates (creator, value) pairs first, each with partial aggregation, so a
    # creator with a huge history never becomes one distinct set in one task.
    keys = (history.where(F.col("creator").isNotNull())
            .groupBy("creator")
            .agg(F.count_distinct("domain").cast("bigint").alias("domain_counts"),
                 F.count_distinct("namespace").cast("bigint").alias("namespace_counts")))
    return _with_zero_rows(keys, live, "creator", extra=("domain_counts", "namespace_counts"))
