"""Exact dedup with a persistent digest index (operator 10, DataFrame functions only).

Texts are equal when they are identical after each run of ASCII white space has become one
space. The SHA-256 of the normalised text is the key of an index table that is bucketed and
sorted by digest, so a new batch is matched by a sort-merge anti join in which only the
batch's distinct digests move, and unseen digests are appended bucket by bucket.

A hot group (one text holding a third of all rows) is one row after the map-side partial
aggregation; the only join that carries it row by row is a plain equi-join of two written
tables, whose large partitions adaptive execution splits.

The number of buckets follows from the size of the first batch. Each batch adds a file to every bucket,
and a bucket of several files has to be sorted again while it is read; so after some batches, or when
buckets have outgrown their size, ``maintain`` writes the index anew, one sorted file per bucket.

Defined cases: a null text counts as empty; null ids rank last; rows that repeat both id and
text are one document (all are reported, ``common.keep_marked`` leaves one); an empty batch gives an
empty report and leaves the index as it was.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlens.llm.common import SPACE_RUN, id_and_text, text_key
from assetlens.session import child_names, finished_folders, fresh_dir, materialize, remove_folder

LEAST_BUCKETS = 64
BUCKET_DIGESTS = 4_000_000
"""Digests of a bucket, about (some 200 MB); at four times as many the index gets more buckets."""
MOST_FILES = 16
"""Files of a bucket at which it is written anew."""


def buckets_for(digests: int) -> int:
    return max(LEAST_BUCKETS, -(-digests // BUCKET_DIGESTS))


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of a non-null text with white-space runs made one space."""
    return F.unhex(F.sha2(F.regexp_replace(text, SPACE_RUN, " "), 256))


class DigestIndex:
    """Digests seen so far with the id of the document that stays: ``digest, keep_id``.

    ``path`` is a folder on the shared store; the bucket count is stored with the index and
    an index opened with another count is refused (without one, the stored count holds). One writer at a
    time; a batch that failed before its append left nothing behind, and a batch given twice finds
    itself in the index and gets the same answer. ``rebuild`` writes a new generation beside the current
    one, which counts from the moment its settings are there.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.generation, stored = self._current()
        if stored is None:
            self._write_settings(0, buckets or LEAST_BUCKETS)
        elif buckets not in (None, stored):
            raise ValueError(f"index {self.path} has {stored} buckets, opened with {buckets}")
        self.buckets = stored or buckets or LEAST_BUCKETS
        self.table = self._create_table(self.generation, self.buckets)

    def _current(self) -> tuple[int, int | None]:
        """The newest generation whose settings are there, and its bucket count."""
        known = [int(n.partition("-")[2] or 0) for n in finished_folders(self.spark, self.path) if n.startswith("settings")]
        if not known:
            return 0, None
        return max(known), self.spark.read.parquet(self._folder("settings", max(known))).first()["buckets"]

    def _folder(self, what: str, generation: int) -> str:
        return f"{self.path}/{what}" + (f"-{generation}" if generation else "")

    def _write_settings(self, generation: int, buckets: int) -> None:
        self.spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1) \
            .write.mode("overwrite").parquet(self._folder("settings", generation))

    def _create_table(self, generation: int, buckets: int) -> str:
        folder = self._folder("digests", generation)
        table = "digest_index_" + hashlib.sha256(folder.encode()).hexdigest()[:16]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'")
        return table

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.read().hint("merge"), "digest", "left_anti")

    def append(self, fresh: DataFrame) -> None:
        """Adds ``digest, keep_id`` rows that the index lacks: one file per bucket."""
        fresh.select("digest", "keep_id").repartition(self.buckets, "digest") \
            .write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def files(self) -> int:
        """Data files of the index (the driver lists their names)."""
        return sum(name.endswith(".parquet") for name in child_names(self.spark, self._folder("digests", self.generation)))

    def maintain(self) -> bool:
        """Writes the index anew where that saves sorting or splits buckets that have grown too large."""
        needed = -(-self.read().count() // BUCKET_DIGESTS)
        if self.files() <= MOST_FILES * self.buckets and needed <= 4 * self.buckets:
            return False
        self.rebuild(max(needed, self.buckets))
        return True

    def rebuild(self, buckets: int) -> None:
        """A new generation with ``buckets`` buckets of one sorted file each; the one before it is kept until the
        next, for readers that are under way. What an attempt that died has left is removed first."""
        new = self.generation + 1
        self.spark.sql(f"DROP TABLE IF EXISTS {self._create_table(new, buckets)}")
        remove_folder(self.spark, self._folder("digests", new))
        table = self._create_table(new, buckets)
        self.read().repartition(buckets, "digest").write.insertInto(table)
        self._write_settings(new, buckets)
        self.spark.catalog.refreshTable(table)
        self.table, self.buckets, self.generation = table, buckets, new
        if new > 1:
            self._remove(new - 2)

    def _remove(self, generation: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._create_table(generation, self.buckets)}")
        for what in ("settings", "digests"):
            remove_folder(self.spark, self._folder(what, generation))

    def discard(self) -> None:
        """Removes the index, folder and catalog entries (a throw-away index of one run)."""
        for generation in range(max(0, self.generation - 1), self.generation + 1):
            self._remove(generation)
        remove_folder(self.spark, self.path)


def dedup_batch(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Deduplicates ``docs`` against the index and within itself, and adds it to the index.

    One row per row of ``docs``: doc_id, keep_id (the document that stays: the one already
    in the index, else the smallest id of the batch), group_size (rows of this batch with
    the text), kept, digest, text_key.
    """
    digests = materialize(id_and_text(docs).select("doc_id", text_key(F.col("text")).alias("text_key"),
                                                   text_digest(F.col("text")).alias("digest")), "exact-digests")
    groups = materialize(digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"),
                                                       F.count(F.lit(1)).alias("group_size")),
                         "exact-groups")
    # Written before it is appended: the insert must not read the table it writes.
    index.append(materialize(index.unseen(groups), "exact-unseen"))
    decided = materialize(groups.select("digest", "group_size")
                          .join(index.read().hint("merge"), "digest"), "exact-decided")
    index.maintain()
    report = digests.join(decided, "digest")
    return report.select("doc_id", "keep_id", "group_size",
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "text_key")


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in a new folder of the shared work folder."""
    return DigestIndex(spark, fresh_dir(spark, "digest-index"), buckets)


def dedup_once(docs: DataFrame) -> DataFrame:
    """The report of ``dedup_batch`` over an index of its own, with buckets for as many rows as ``docs`` has (a
    written table: they are counted), removed afterwards. There are at least as many buckets as the session
    shuffles into partitions: a task that writes the digests of a partition then writes one file, not one a bucket."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = new_index(spark, max(partitions, buckets_for(docs.count())))
    report = dedup_batch(docs, index)
    index.discard()
    return report


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Report of a first batch over an empty index, digests as lowercase hex."""
    return dedup_once(docs).select("doc_id", "keep_id", "group_size", "kept",
                                   F.lower(F.hex("digest")).alias("text_sha256"))
