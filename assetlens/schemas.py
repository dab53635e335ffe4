"""Explicit schemas: change envelope, row images, routed changes and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
I = T.IntegerType()
B = T.BooleanType()

# Names of the catalog tables whose changes are consumed, and the
# operation names of the change envelope.
TABLE_INFO = "table_info"
PARTITION_INFO = "partition_info"
DATA_COMMIT_INFO = "data_commit_info"
CATALOG_TABLES = (PARTITION_INFO, TABLE_INFO, DATA_COMMIT_INFO)
OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ = "create", "update", "delete", "read"
# Single-letter operation codes some change feeds use instead of the names above.
OP_CODES = {"c": OP_CREATE, "u": OP_UPDATE, "d": OP_DELETE, "r": OP_READ}

# One row image holds the union of the columns read from the three catalog tables.
# Absent images arrive as ``{}`` and parse to a struct whose fields are all null.
ROW_IMAGE = T.StructType([
    T.StructField("table_id", S),
    T.StructField("table_namespace", S),
    T.StructField("table_name", S),
    T.StructField("domain", S),
    T.StructField("creator", S),
    T.StructField("partition_desc", S),
    T.StructField("commit_id", S),
    T.StructField("file_ops", T.ArrayType(S)),
    T.StructField("committed", S),
])

# The change envelope, in either shape a connector may write: the operation as
# ``commitOp`` or ``op``, the table as ``tableName`` or ``source.table``, the log position
# (a unique total order of changes) as ``seq`` or ``source.lsn``. A line that is no JSON of
# this shape is kept whole in ``_corrupt_record``.
CORRUPT = "_corrupt_record"
ENVELOPE = T.StructType([
    T.StructField("commitOp", S),
    T.StructField("op", S),
    T.StructField("tableName", S),
    T.StructField("source", T.StructType([T.StructField("schema", S), T.StructField("table", S),
                                          T.StructField("lsn", L)])),
    T.StructField("before", ROW_IMAGE),
    T.StructField("after", ROW_IMAGE),
    T.StructField("seq", L),
    T.StructField(CORRUPT, S),
])

# Routed changes, one DataFrame per catalog table.
TABLE_INFO_CHANGES = T.StructType([
    T.StructField("table_id", S), T.StructField("table_name", S),
    T.StructField("table_namespace", S), T.StructField("domain", S),
    T.StructField("creator", S), T.StructField("commit_op", S), T.StructField("seq", L),
])
PARTITION_CHANGES = T.StructType([
    T.StructField("table_id", S), T.StructField("partition_desc", S),
    T.StructField("commit_op", S), T.StructField("seq", L),
])
COMMIT_CHANGES = T.StructType([
    T.StructField("table_id", S), T.StructField("commit_id", S),
    T.StructField("file_ops", T.ArrayType(S)), T.StructField("committed", B),
    T.StructField("commit_op", S), T.StructField("seq", L),
])

# Result tables and their primary keys (the DDL of the four asset tables).
TABLE_LEVEL_ASSETS = T.StructType([
    T.StructField("table_id", S, False), T.StructField("table_name", S),
    T.StructField("domain", S), T.StructField("creator", S),
    T.StructField("namespace", S), T.StructField("partition_counts", I),
    T.StructField("file_counts", I), T.StructField("file_total_size", L),
])
DOMAIN_LEVEL_ASSETS = T.StructType([
    T.StructField("domain", S, False), T.StructField("table_counts", I),
    T.StructField("partition_counts", I), T.StructField("file_counts", I),
    T.StructField("file_total_size", L),
])
USER_LEVEL_ASSETS = T.StructType([
    T.StructField("creator", S, False), T.StructField("domain_counts", I),
    T.StructField("namespace_counts", I), T.StructField("table_counts", I),
    T.StructField("partition_counts", I), T.StructField("file_counts", I),
    T.StructField("file_total_size", L),
])
NAMESPACE_LEVEL_ASSETS = T.StructType([
    T.StructField("namespace", S, False), T.StructField("table_counts", I),
    T.StructField("partition_counts", I), T.StructField("file_counts", I),
    T.StructField("file_total_size", L),
])

RESULT_TABLES = {
    "table_level_assets": (TABLE_LEVEL_ASSETS, "table_id"),
    "namespace_level_assets": (NAMESPACE_LEVEL_ASSETS, "namespace"),
    "domain_level_assets": (DOMAIN_LEVEL_ASSETS, "domain"),
    "user_level_assets": (USER_LEVEL_ASSETS, "creator"),
}


INT_MAX = 2**31 - 1


def wide(schema: T.StructType) -> T.StructType:
    """The schema with its ``int`` counts as ``bigint``: what is stored and what the results
    are given as, so that no count is ever cut and deltas of stored counts stay exact."""
    return T.StructType([T.StructField(f.name, L if isinstance(f.dataType, T.IntegerType) else f.dataType, f.nullable)
                         for f in schema.fields])


def fits(schema: T.StructType):
    """Whether a row's counts are within the ``int`` columns of ``schema``."""
    from pyspark.sql import functions as F
    ok = F.lit(True)
    for f in schema.fields:
        if isinstance(f.dataType, T.IntegerType):
            ok = ok & F.coalesce(F.abs(F.col(f.name).cast("bigint")) <= INT_MAX, F.lit(True))
    return ok


def to_exact_schema(df, schema: T.StructType):
    """Select by name and cast to the schema's types; a count that an ``int`` column cannot
    hold fails the write (whatever the session's ANSI setting) instead of being changed."""
    from pyspark.sql import functions as F

    def typed(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            c = F.when(F.abs(c.cast("bigint")) > INT_MAX, F.raise_error(F.lit(f"{f.name} is beyond int"))).otherwise(c)
        return c.cast(f.dataType).alias(f.name)

    return df.select([typed(f) for f in schema.fields])


def to_result_schema(df, schema: T.StructType):
    """Select by name (never by position) and cast to the result table's types. A count
    beyond the range of the result table's ``int`` becomes that range's end, so this is for
    ``wide`` schemas or for display only: the stored tables and the sinks use
    ``to_exact_schema`` or ``fits``."""
    from pyspark.sql import functions as F

    def typed(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.IntegerType):
            top = 2**31 - 1
            c = F.when(c > top, F.lit(top)).when(c < -top, F.lit(-top)).otherwise(c)
        return c.cast(f.dataType).alias(f.name)

    return df.select([typed(f) for f in schema.fields])
