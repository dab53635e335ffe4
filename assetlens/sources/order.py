"""The total order of changes (D13): which changes have a position that does not order them.

Results never depend on the order of input rows (``facts.place``), but where two different changes of one
key share a position, or a table's changes have positions of different kinds, the log does not say which
came last. ``unordered`` lists these changes, with the reason:

* ``tied_position``: another change of the same key (the table, its partition, its commit) has the same position;
* ``mixed_positions``: some changes of the table carry a log position, others only the offset of the
  feed's partition that they came in; the two are not comparable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetlens.sources.envelope import ORIGIN

PROBLEM = "problem string, table_id string, sub_key string, commit_id string, commit_op string, seq long"


def unordered(tagged: DataFrame) -> DataFrame:
    """``tagged``: the narrow rows of ``plans.compaction.tagged_changes`` (a written table), repeats already
    removed. Both tests are aggregates with map-side combine over narrow keys; only the keys found
    are joined back."""
    columns = ["table_id", "sub_key", "commit_id", "commit_op", "seq"]
    family = F.when(F.col("kind") == "q", F.lit("c")).otherwise(F.col("kind")).alias("family")
    rows = tagged.select(family, *columns, *([ORIGIN] if ORIGIN in tagged.columns else []))
    key = ["family", "table_id", "sub_key", "seq"]
    same_commit = F.coalesce("commit_id", F.lit("")).alias("id")
    ties = rows.select("*", same_commit).groupBy(*key, "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    tied = rows.select("*", same_commit).join(ties, [*key, "id"], "left_semi") \
        .select(F.lit("tied_position").alias("problem"), *columns)
    if ORIGIN not in tagged.columns:
        return tied
    by_offset = F.col(ORIGIN).isNotNull()
    mixed = rows.groupBy("table_id").agg(F.max(by_offset).alias("some"), F.min(by_offset).alias("all")) \
        .where("some AND NOT all").select("table_id")
    return tied.unionByName(rows.join(mixed, "table_id", "left_semi").select(F.lit("mixed_positions").alias("problem"), *columns))
