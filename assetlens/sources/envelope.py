"""Change envelopes: decoding (S3, S4), row-image choice (P1) and routing.

An envelope is one JSON text per row change: ``{commitOp, tableName, before, after,
seq}`` or a connector's ``{op, before, after, source: {schema, table, lsn}}``. The same functions decode a file source (``value`` from ``spark.read.text``)
and a Kafka topic (``value`` cast to string, ``topic`` giving the table name), in
batch and in streaming.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetlens.functions.fileops import text_to_bool
from assetlens.schemas import (CATALOG_TABLES, CORRUPT, DATA_COMMIT_INFO, ENVELOPE, OP_CODES,
                               OP_CREATE, OP_DELETE, OP_READ, OP_UPDATE, PARTITION_INFO, ROW_IMAGE,
                               TABLE_INFO)


def normalize_op(op: Column) -> Column:
    """lower-cased operation name; single-letter change-feed codes mapped to names."""
    low = F.lower(F.trim(op))
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for code, name in OP_CODES.items():
        expr = expr.when(low == F.lit(code), F.lit(name))
    return expr.otherwise(low)


def table_from_topic(topic: Column) -> Column:
    """the table name is the third dot-separated part of ``server.schema.table``."""
    return F.element_at(F.split(topic, "[.]"), 3)


def schema_from_topic(topic: Column) -> Column:
    """The catalog schema is the second dot-separated part of ``server.schema.table``."""
    return F.element_at(F.split(topic, "[.]"), 2)


def normalize_envelopes(env: DataFrame, topic_col: str | None = None,
                        offset_col: str | None = None, partition_col: str | None = None) -> DataFrame:
    """Envelope columns (as parsed by the JSON file source or by ``from_json``) to
    ``commit_op, table_name, schema_name, before, after, seq, raw``; ``raw`` is the text of
    a broken envelope, null otherwise.

    The log position is ``seq``, else ``source.lsn``, else ``offset_col`` (Kafka: the
    changes of one row share a partition, whose offsets order them; positions are only
    ever compared among changes of one key). With ``partition_col`` (Kafka) a column
    ``origin`` says whose offset it is; it is null where the envelope has a position.
    """
    table, schema, seq = F.coalesce("tableName", "source.table"), F.col("source.schema"), F.coalesce("seq", "source.lsn")
    if topic_col is not None:
        table = F.coalesce(table, table_from_topic(F.col(topic_col)))
        schema = F.coalesce(schema, schema_from_topic(F.col(topic_col)))
    if offset_col is not None:
        seq = F.coalesce(seq, F.col(offset_col))
    own = F.coalesce("seq", "source.lsn")
    origin = [] if partition_col is None else [
        F.when(own.isNull(), F.concat_ws("/", F.col(topic_col), F.col(partition_col).cast("string"))).alias("origin")]
    whole = F.col(CORRUPT).isNull()
    return env.select(
        F.when(whole, normalize_op(F.coalesce("commitOp", "op"))).alias("commit_op"),
        F.when(whole, table).alias("table_name"),
        schema.alias("schema_name"),
        F.col("before"), F.col("after"), F.when(whole, seq).alias("seq"), F.col(CORRUPT).alias("raw"),
        *origin)


POSITION = "position"
ORIGIN = "origin"


def with_position(decoded: DataFrame) -> DataFrame:
    """Adds what tells a repeated delivery from another change: a hash of the whole decoded
    change (position, operation, table, both images, broken text, Kafka topic and partition
    of an offset). Changes that share a log position stay apart by their images."""
    return decoded.withColumn(POSITION, F.sha2(F.to_json(F.struct(*[F.col(c) for c in decoded.columns])), 256))


OPERATIONS = (OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ)


def reject_reason(table_id: Column, schema: Column | None = None) -> Column:
    """Why a decoded change of a catalog table cannot be used, null if it can:
    ``bad_json``, ``no_operation`` (none, or an unknown one), ``no_position``,
    ``no_table_id``; ``no_schema`` where ids are qualified by the ``schema``."""
    reason = (F.when(F.col("raw").isNotNull(), F.lit("bad_json"))
            .when(F.col("commit_op").isNull() | ~F.col("commit_op").isin(*OPERATIONS), F.lit("no_operation"))
            .when(F.col("seq").isNull(), F.lit("no_position"))
            .when(table_id.isNull(), F.lit("no_table_id")))
    return reason if schema is None else reason.when(schema.isNull(), F.lit("no_schema"))


def decode_envelopes(df: DataFrame, value_col: str = "value", topic_col: str | None = None,
                     offset_col: str | None = None, partition_col: str | None = None) -> DataFrame:
    """S3: JSON envelope text (e.g. Kafka ``value``) to typed columns ``commit_op,
    table_name, schema_name, before, after, seq, raw``.

    ``file_ops`` stays an array of base64 text (S4); it is decoded only by the commit
    fold. Only the columns of ``ROW_IMAGE`` are parsed, whatever else the rows carry.
    Envelope files are better read by the JSON file source (``changelog.read_changes``),
    which parses each line once while reading.
    """
    keep = [F.col(c) for c in (topic_col, offset_col, partition_col) if c is not None]
    parsed = df.select(F.from_json(F.col(value_col).cast("string"), ENVELOPE).alias("env"), *keep)
    return normalize_envelopes(parsed.select("env.*", *keep), topic_col, offset_col, partition_col)


def image_present(img: Column) -> Column:
    """True when a row image has at least one non-null field.

    An absent image arrives as ``{}``, which parses to a non-null struct of nulls, so a
    null test on the struct itself is not enough.
    """
    return F.coalesce(*[img[f.name].cast("string") for f in ROW_IMAGE.fields]).isNotNull()


def row_image(before: Column, after: Column) -> Column:
    """The ``after`` image unless it is empty, else the ``before`` image."""
    return F.when(image_present(after), after).otherwise(before)


def with_row_image(decoded: DataFrame, qualify_ids: bool = False) -> DataFrame:
    """Adds ``img`` (chosen image), ``image_side`` ('after' / 'before') and ``reason`` (why
    a change of a catalog table cannot be used, null if it can).

    ``qualify_ids``: a feed that captures several schemas (D15) gets table ids
    ``<schema>.<table_id>``, so equal ids of different schemas stay apart.
    """
    img = row_image(F.col("before"), F.col("after"))
    if qualify_ids:
        img = img.withField("table_id", F.concat_ws(".", F.col("schema_name"), img["table_id"]))
    table_id = row_image(F.col("before"), F.col("after"))["table_id"]
    return decoded.select(
        "commit_op", "table_name", "seq",
        img.alias("img"),
        F.when(image_present(F.col("after")), F.lit("after")).otherwise(F.lit("before"))
        .alias("image_side"),
        F.when(F.col("raw").isNotNull() | F.col("table_name").isin(*CATALOG_TABLES),
               reject_reason(table_id, F.col("schema_name") if qualify_ids else None)).alias("reason"),
        "raw", *[c for c in (POSITION, ORIGIN) if c in decoded.columns],
    )


def catalog_changes(decoded: DataFrame, qualify_ids: bool = False) -> DataFrame:
    """P5 (shared part): usable changes of the three catalog tables; other tables are
    dropped, and unusable changes are in ``rejected``."""
    return with_row_image(decoded.where(F.col("table_name").isin(*CATALOG_TABLES)), qualify_ids) \
        .where(F.col("reason").isNull()).drop("reason", "raw")


def usable(decoded: DataFrame) -> DataFrame:
    """The decoded changes without the rejected ones (``rejected`` has those)."""
    table_id = row_image(F.col("before"), F.col("after"))["table_id"]
    unusable = F.col("raw").isNotNull() | (F.col("table_name").isin(*CATALOG_TABLES)
                                           & reject_reason(table_id).isNotNull())
    return decoded.where(~F.coalesce(unusable, F.lit(False)))


def rejected(decoded: DataFrame, qualify_ids: bool = False) -> DataFrame:
    """Broken envelopes and unusable changes of the catalog tables: (problem, table_name,
    commit_op, seq, table_id, raw); one row per ``with_position`` hash, if there is one."""
    rows = with_row_image(decoded, qualify_ids).where(F.col("reason").isNotNull())
    if POSITION in rows.columns:
        rows = rows.dropDuplicates([POSITION])
    return rows.select(
        F.col("reason").alias("problem"), "table_name", "commit_op", "seq",
        F.when(F.col("raw").isNull(), F.col("img.table_id")).alias("table_id"), "raw")


def route_table_info(changes: DataFrame) -> DataFrame:
    """``table_info`` changes as (table_id, table_name, table_namespace, domain, creator, commit_op, seq)."""
    img = F.col("img")
    return changes.where(F.col("table_name") == TABLE_INFO).select(
        img["table_id"].alias("table_id"), img["table_name"].alias("table_name"),
        img["table_namespace"].alias("table_namespace"), img["domain"].alias("domain"),
        img["creator"].alias("creator"), "commit_op", "seq")


def route_partition_info(changes: DataFrame) -> DataFrame:
    """``partition_info`` changes as (table_id, partition_desc, commit_op, seq)."""
    img = F.col("img")
    return changes.where(F.col("table_name") == PARTITION_INFO).select(
        img["table_id"].alias("table_id"), img["partition_desc"].alias("partition_desc"),
        "commit_op", "seq")


def route_data_commit_info(changes: DataFrame) -> DataFrame:
    """``data_commit_info`` changes as (table_id, commit_id, file_ops, committed, commit_op, seq)."""
    img = F.col("img")
    return changes.where(F.col("table_name") == DATA_COMMIT_INFO).select(
        img["table_id"].alias("table_id"), img["commit_id"].alias("commit_id"),
        img["file_ops"].alias("file_ops"), text_to_bool(img["committed"]).alias("committed"),
        "commit_op", "seq")


def route_all(decoded: DataFrame, qualify_ids: bool = False
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P5: one decoded stream into (table_info, partition_info, data_commit_info) changes."""
    changes = catalog_changes(decoded, qualify_ids)
    return route_table_info(changes), route_partition_info(changes), route_data_commit_info(changes)
