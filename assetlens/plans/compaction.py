"""Compaction of the whole change feed (batch and streaming).

The feed is parsed once and each change becomes one narrow tagged row (a projection, not
a union of filtered branches, which Spark would scan once each). In streaming **one**
aggregate keyed by ``(kind, table_id, sub_key)`` compacts the tagged rows, since Spark
allows a single stateful aggregate per update-mode query:

* kind ``t`` (``table_info``): last op, attributes of the last non-delete change,
  set of (namespace, domain, creator) ever held outside deletes (J0);
* kind ``p`` (``partition_info``): last op per ``sub_key = partition_desc`` (A3, inner half);
* kind ``c`` (``data_commit_info``): signed running file count and byte total (A2);
* kind ``q``: a commit change that cannot be counted, with the reason; it never enters the
  state.

In batch the tagged rows are written once, partitioned by kind, and each kind has its own
aggregate (``operators.facts``): the two large ones, partitions and commits, then have
fixed-width buffers and run as hash aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlens.functions.fileops import text_to_bool
from assetlens.operators import facts
from assetlens.plans.batch import Compacted
from assetlens.schemas import DATA_COMMIT_INFO, OP_DELETE, PARTITION_INFO, TABLE_INFO
from assetlens.sources.envelope import ORIGIN, POSITION, catalog_changes

_S = T.StringType()
GROUP = T.StructType([T.StructField("namespace", _S), T.StructField("domain", _S),
                      T.StructField("creator", _S)])
ATTRS = T.StructType([T.StructField(a, _S) for a in facts.ATTRS])
COMPACTED = T.StructType([
    T.StructField("kind", _S), T.StructField("table_id", _S), T.StructField("sub_key", _S),
    T.StructField("op", _S), T.StructField("attrs", ATTRS),
    T.StructField("groups", T.ArrayType(GROUP)),
    T.StructField("file_counts", T.LongType()), T.StructField("file_total_size", T.LongType()),
    T.StructField("seq", T.LongType()),
])
KEYS = ["kind", "table_id", "sub_key"]


def tagged_changes(decoded: DataFrame, qualify_ids: bool = False) -> DataFrame:
    """The three routed logs and the uncountable commits as one tagged frame.

    One projection over the decoded feed, not a union of one filtered branch per table:
    the feed is scanned once. Each change gives exactly one row (a commit change is
    either counted, ``c``, or quarantined, ``q``). A ``position`` column of the feed
    (``with_position``) is passed on.
    """
    img = F.col("img")
    src = F.col("source")
    changes = (catalog_changes(decoded, qualify_ids).withColumnRenamed("table_name", "source")
               .where(~((src == PARTITION_INFO) & img["partition_desc"].isNull())))
    position = [c for c in (POSITION, ORIGIN) if c in changes.columns]
    rows = changes.select(
        "source", "commit_op", "seq", img["table_id"].alias("table_id"),
        img["partition_desc"].alias("partition_desc"),
        *[img[a].alias(a) for a in facts.ATTRS],
        img["commit_id"].alias("commit_id"),
        F.when(src == DATA_COMMIT_INFO, img["file_ops"]).alias("file_ops"),
        text_to_bool(img["committed"]).alias("committed"), *position)
    stats = facts.commit_stats(rows)
    kind = (F.when(src == TABLE_INFO, F.lit("t")).when(src == PARTITION_INFO, F.lit("p"))
            .when(F.col("problem").isNull(), F.lit("c")).otherwise(F.lit("q")))
    d_files, d_bytes = facts.signed_delta_columns()
    tagged = stats.select("*", kind.alias("kind"), d_files.alias("__d_files"),
                          d_bytes.alias("__d_bytes"))
    k = F.col("kind")
    only = lambda name, c: F.when(k == F.lit(name), c)
    # Changes the A2 rule ignores carry null deltas; a key whose sums stay null has no
    # counted change and is dropped when the state is split (no J2 match).
    return tagged.select(
        k, "table_id", F.when(k == "p", F.col("partition_desc")).otherwise(F.lit("")).alias("sub_key"),
        "commit_op", "seq", "commit_id",
        *[only("t", F.col(a)).alias(a) for a in facts.ATTRS],
        only("c", F.col("__d_files")).alias("d_files"),
        only("c", F.col("__d_bytes")).alias("d_bytes"),
        only("q", F.col("problem")).alias("problem"), *position)


def commit_key() -> Column:
    """A commit's ``sub_key``: never null, and a missing id is told from an empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col("commit_id")), F.lit(""))


def compaction_agg(tagged: DataFrame, dedupe_commits: bool = False) -> DataFrame:
    """The single streaming aggregate: J0, A3 (inner half) and A2 in one operator. With ``dedupe_commits``
    the rows of kind ``c`` are per commit (``commit_key`` in ``sub_key``) and hold its last contribution (D5);
    the totals of a table follow from the changes of these rows."""
    is_live = F.col("commit_op") != F.lit(OP_DELETE)
    group = F.struct(F.col("table_namespace").alias("namespace"), "domain", "creator")
    attrs = F.struct(*[F.col(a) for a in facts.ATTRS])
    # A commit that cannot be counted has null deltas and joins its table's commit row: it
    # leaves no state, and no filter is pushed below the fold that finds it.
    tagged = tagged.withColumn("kind", F.when(F.col("kind") == "q", F.lit("c")).otherwise(F.col("kind")))
    if dedupe_commits:
        tagged = tagged.withColumn("sub_key", F.when(F.col("kind") == "c", commit_key()).otherwise(F.col("sub_key")))
    files, size = facts.last_contribution() if dedupe_commits else (F.sum("d_files"), F.sum("d_bytes"))
    order = F.col("place")
    return facts.placed(tagged).groupBy(*KEYS).agg(
        F.max_by(F.col("commit_op"), order).alias("op"),
        F.max_by(attrs, F.when(is_live, order)).alias("attrs"),
        F.collect_set(F.when((F.col("kind") == "t") & is_live, group)).alias("groups"),
        files.alias("file_counts"),
        size.alias("file_total_size"),
        F.max("seq").alias("seq"))


def split_compacted(state: DataFrame) -> Compacted:
    """The compacted rows back to the per-log frames the finish functions take."""
    return Compacted(
        table_info=state.where(F.col("kind") == "t").select("table_id", "attrs", "op", "groups"),
        partitions=state.where(F.col("kind") == "p").select(
            "table_id", F.col("sub_key").alias("partition_desc"),
            (F.col("op") == F.lit(OP_DELETE)).alias("deleted")),
        totals=state.where((F.col("kind") == "c") & F.col("file_counts").isNotNull())
        .select("table_id", "file_counts", "file_total_size"))


def compact_tagged(tagged: DataFrame, dedupe_commits: bool = False) -> Compacted:
    """Batch: the tagged rows (a written table) compacted by one aggregate per kind. With
    ``dedupe_commits`` only the last change of each commit id counts (D5)."""
    of = lambda kind: tagged.where(F.col("kind") == kind)
    commits = of("c")
    if dedupe_commits:
        commits = facts.placed(commits).groupBy("table_id", "commit_id").agg(*facts.last_contribution())
    return Compacted(
        table_info=facts.compact_table_info(of("t")),
        partitions=facts.compact_partitions(of("p").withColumnRenamed("sub_key", "partition_desc")),
        totals=facts.commit_totals(commits))


def quarantined(tagged: DataFrame) -> DataFrame:
    """Commit changes that cannot be counted, one row per change."""
    return tagged.where(F.col("kind") == "q").select("table_id", "commit_id", "commit_op", "seq", "problem")
