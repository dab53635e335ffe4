"""Keyed result tables with upsert (K1-K6).

A sink takes the changed rows of a micro-batch: ``upsert(rows, batch_id)``, one row per key. Three fill
that interface: ``KeyedLog`` (Parquet files, below), ``MergeTable`` (any table format with MERGE)
and ``JdbcTable`` (PostgreSQL dialect, as the four asset tables are defined).

``KeyedLog`` is plain appended Parquet: each micro-batch writes its changed rows, and no others, to a folder of
its own, ``changes/batch=<id>``; readers take the row of the highest batch per key. When the appended
files pass a share of the base, a plain Spark job writes the resolved rows as the new base,
``base/upto=<id>-buckets=<n>``, and the folders that it replaces are removed. So:

* what a micro-batch writes depends on what it changed, not on the table;
* a folder counts once its job has finished (``_SUCCESS``), so a job that died leaves nothing behind;
* a batch that is there already is skipped, and what a batch looks up is the table as the batches
  before it left it (``upto``), so a replayed micro-batch computes the same and adds nothing;
* the base holds batches before the running one only, which the stream will not replay;
* look-ups by key read the buckets of the base that the keys fall in; the number of buckets is
  chosen anew with each base, from its size.

One writer per table; batch ids of another writer (a new checkpoint on an old folder) say nothing about
it, so such a write is refused. The driver sees folder names and bucket numbers, never rows.
"""

from __future__ import annotations

import re
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlens.schemas import to_exact_schema
from assetlens.session import finished_folders, folder_bytes, remove_folder

BUCKET, BATCH = "_bucket", "batch"
BATCH_WRITER = "batch"
COMPACT_SHARE = 0.5
"""Appended bytes, as a share of the base, at which a new base is written."""
LEAST_BYTES, MOST_BATCHES = 64 << 20, 50
"""Fewer appended bytes are left, unless they come from so many batches."""
BUCKET_BYTES = 128 << 20
KEPT_BASES = 2


class Sink(Protocol):
    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Inserts new keys and replaces existing ones, one row per key; False for a batch that is there."""


class ForeignWriter(RuntimeError):
    """The table was written by another writer, whose batch ids are not comparable."""


class KeyedLog:
    """``bucket_by``: the key columns that look-ups go by (all keys if not given). ``forget``: a
    condition on rows that a new base leaves out, for rows that mean the same as no row."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str | list[str],
                 bucket_by: list[str] | None = None, writer: str = BATCH_WRITER, forget: str | None = None):
        self.spark, self.path, self.schema, self.writer, self.forget = spark, path.rstrip("/"), schema, writer, forget
        self.keys = [key] if isinstance(key, str) else list(key)
        self.bucket_by = bucket_by or self.keys
        self._batches: set[int] | None = None
        self._bases: dict[int, int] = {}  # last batch in it: buckets

    def _load(self) -> None:
        """Lists the folders once per instance; its own writes keep it current afterwards."""
        if self._batches is None:
            self._batches = {int(n.removeprefix("batch=")) for n in finished_folders(self.spark, f"{self.path}/changes")}
            for name in finished_folders(self.spark, f"{self.path}/base"):
                upto, buckets = re.fullmatch(r"upto=(\d+)-buckets=(\d+)", name).groups()
                self._bases[int(upto)] = int(buckets)

    def _base(self) -> tuple[int, int] | None:
        return max(self._bases.items(), default=None)

    def last_batch(self) -> int | None:
        """The last batch that the table holds, or None for a new table."""
        self._load()
        return max([*self._batches, *self._bases], default=None)

    # -- reads --------------------------------------------------------------------
    def _base_path(self, upto: int) -> str:
        return f"{self.path}/base/upto={upto}-buckets={self._bases[upto]}"

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(buckets)).cast("int")

    def _read_batches(self, ids: list[int]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/changes") \
            .parquet(*[f"{self.path}/changes/batch={i}" for i in ids])

    def current(self, upto: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The table as it was after batch ``upto`` (default: now); with ``keys`` (distinct values of the
        ``bucket_by`` columns, a written frame) only the rows of those."""
        self._load()
        base = self._base()
        if base and upto is not None and upto < base[0]:
            raise ValueError(f"{self.path}: batch {upto} is folded into the base up to {base[0]}")
        ids = sorted(i for i in self._batches if (base is None or i > base[0]) and (upto is None or i <= upto))
        columns, parts = self.schema.fieldNames(), []
        if ids:
            parts.append(self._read_batches(ids).select(*columns, BATCH))
        if base:
            bucket = T.StructField(BUCKET, T.IntegerType())
            rows = self.spark.read.schema(T.StructType([*self.schema.fields, bucket])).parquet(self._base_path(base[0]))
            if keys is not None and base[1] > 1:  # at most as many small numbers as there are buckets
                wanted = [r[0] for r in keys.select(self._bucket(base[1])).distinct().collect()]
                rows = rows.where(F.col(BUCKET).isin(wanted))
            parts.append(rows.select(*columns, F.lit(-1).cast("bigint").alias(BATCH)))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if keys is not None:
            rows = rows.join(keys.select(*self.bucket_by), self.bucket_by, "left_semi")
        if len(ids) + bool(base) == 1:
            return rows.select(*columns)
        rest = [c for c in columns if c not in self.keys]
        if not rest:
            return rows.select(*columns).dropDuplicates()
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("r")) \
            .select(*self.keys, "r.*").select(*columns)

    def batch_rows(self, batch_id: int) -> DataFrame:
        """The rows that one batch changed."""
        self._load()
        return self._read_batches([batch_id]).select(*self.schema.fieldNames())

    # -- writes -------------------------------------------------------------------
    def _check_writer(self) -> None:
        try:
            known = self.spark.read.schema("writer string").parquet(f"{self.path}/writer").first()
        except AnalysisException:  # a new table
            known = None
        if known is None:
            self.spark.createDataFrame([(self.writer,)], "writer string").coalesce(1) \
                .write.mode("overwrite").parquet(f"{self.path}/writer")
        elif known["writer"] != self.writer:
            raise ForeignWriter(f"{self.path} was written by {known['writer']} up to batch {self.last_batch()}; {self.writer} "
                                "cannot tell which of its own batches it holds. Use that writer's checkpoint or a new folder.")

    def upsert(self, rows: DataFrame, batch_id: int, frozen: tuple[str, ...] = (), order_by: str | None = None) -> bool:
        """Appends the changed rows of a batch. ``rows`` must hold one row per key; with ``order_by`` the
        last row per key wins. ``frozen`` columns keep their stored value for existing keys (the
        reference's ON CONFLICT leaves them alone)."""
        first = self._batches is None
        self._load()
        if first or not (self._batches or self._bases):
            self._check_writer()
        base = self._base()
        if batch_id in self._batches or (base and batch_id <= base[0]):
            return False
        if order_by is not None:
            others = [c for c in rows.columns if c not in self.keys]
            rows = (rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), F.col(order_by)).alias("r"))
                    .select(*self.keys, "r.*"))
        rows = to_exact_schema(rows, self.schema)
        if frozen:
            stored = self.current(batch_id - 1, rows.select(*self.bucket_by)).select(*self.keys, F.lit(True).alias("__old"),
                                                       *[F.col(c).alias(f"__old_{c}") for c in frozen])
            rows = rows.join(stored, self.keys, "left").select(
                *[F.when(F.col("__old"), F.col(f"__old_{c}")).otherwise(F.col(c)).alias(c) if c in frozen else F.col(c)
                  for c in self.schema.fieldNames()])
        rows.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id}")
        self._batches.add(batch_id)
        return True

    def maintain(self, running: int) -> bool:
        """Writes a new base of the batches before ``running`` when enough has been appended."""
        self._load()
        base = self._base()
        ids = sorted(i for i in self._batches if i < running and (base is None or i > base[0]))
        if not ids:
            return False
        appended = sum(folder_bytes(self.spark, f"{self.path}/changes/batch={i}") for i in ids)
        below = folder_bytes(self.spark, self._base_path(base[0])) if base else 0
        if len(ids) < MOST_BATCHES and appended < max(LEAST_BYTES, COMPACT_SHARE * below):
            return False
        self.compact(ids[-1], appended + below)
        return True

    def compact(self, upto: int, size: int = 0) -> None:
        """Writes the table up to batch ``upto`` as a new base, and removes what only older bases need."""
        self._load()
        buckets = max(1, -(-size // BUCKET_BYTES))
        rows = self.current(upto)
        if self.forget:
            rows = rows.where(f"NOT ({self.forget})")
        rows = rows.withColumn(BUCKET, self._bucket(buckets)).repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, *self.bucket_by)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/base/upto={upto}-buckets={buckets}")
        self._bases[upto] = buckets
        for old in sorted(self._bases)[:-KEPT_BASES]:
            remove_folder(self.spark, self._base_path(old))
            del self._bases[old]
        if len(self._bases) == KEPT_BASES:  # readers of the base before may still read what follows it
            for i in [i for i in self._batches if i <= min(self._bases)]:
                remove_folder(self.spark, f"{self.path}/changes/batch={i}")
                self._batches.discard(i)


class MergeTable:
    """A table of a format with row-level MERGE, by its catalog name. Not exercised in this repository's
    tests (no such format is installed); the statement is."""

    def __init__(self, spark: SparkSession, table: str, key: str, update_cols: list[str]):
        self.spark, self.table, self.key, self.update_cols = spark, table, key, update_cols

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """A replay of a batch merges the same values again."""
        self.spark.sql(merge_statement(self.table, rows.columns, self.key, self.update_cols), changed=rows)
        return True


class JdbcTable:
    """A database table (K5: ``batch_size`` rows a write batch)."""

    def __init__(self, url: str, table: str, key: str, update_cols: list[str], properties: dict, batch_size: int = 50):
        self.url, self.table, self.key, self.update_cols = url, table, key, update_cols
        self.properties, self.batch_size = properties, batch_size

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """A replay of a batch merges the same values again."""
        jdbc_upsert(rows, self.url, self.table, self.key, self.update_cols, self.properties, self.batch_size)
        return True


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*([.][A-Za-z_][A-Za-z0-9_]*)?")


def merge_statement(table: str, columns: list[str], key: str, update_cols: list[str]) -> str:
    """The MERGE of the frame ``{changed}`` into ``table``."""
    for name in (key, *columns, *update_cols):
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain SQL name: {name!r}")
    return (f"MERGE INTO {table} t USING {{changed}} s ON t.{key} = s.{key} "
            f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in update_cols)} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})")


def jdbc_upsert_statement(table: str, columns: list[str], key: str, update_cols: list[str]) -> str:
    """The merge of the staging table into ``table``: new keys inserted, of existing ones
    ``update_cols`` replaced."""
    for name in (table, key, *columns, *update_cols):
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain SQL name: {name!r}")
    cols = ", ".join(columns)
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in update_cols)
    return (f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {table}__staging "
            f"ON CONFLICT ({key}) DO UPDATE SET {sets}")


def jdbc_upsert(rows: DataFrame, url: str, table: str, key: str, update_cols: list[str],
                properties: dict, batch_size: int = 50) -> None:
    """Upsert into a JDBC table: staging write from executors, one merge on the driver.

    The write and the merge need a database and are not exercised in this repository's
    tests; the statement is.
    """
    stmt = jdbc_upsert_statement(table, rows.columns, key, update_cols)
    (rows.write.mode("overwrite").option("batchsize", str(batch_size))
     .option("truncate", "true").jdbc(url, f"{table}__staging", properties=properties))
    jvm = rows.sparkSession.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(
        url, properties.get("user"), properties.get("password"))
    try:
        conn.createStatement().executeUpdate(stmt)
    finally:
        conn.close()
