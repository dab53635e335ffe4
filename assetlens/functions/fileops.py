"""File-operation text: decoding and parsing as built-in column expressions.

A commit row of ``data_commit_info`` carries ``file_ops``, an array of base64 text.
Each element decodes to ``(path,action,size,"col,col")``. Everything here is a
JVM-side expression (``transform`` / ``aggregate`` over the array), so a commit is folded
in its own row without an explode, a shuffle or Python. Lambdas over arrays are
interpreted, not compiled, and do not share subexpressions: each text is decoded in one
``transform`` and read in the next.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the file-op pattern. Groups: 1 path, 2 action, 3 size, 4 column list.
# Written with bracket classes instead of backslashes so the same text means the
# same in Spark and DuckDB SQL.
FILE_OP_PATTERN = '[(]([^,]+),([^,]+),([^,]+),"([^"]+)"[)]'
# Fixed value: the same pattern with groups 2 and 3 as one, ``action,size``; neither holds a comma.
ACTION_SIZE_PATTERN = '[(][^,]+,([^,]+,[^,]+),"[^"]+"[)]'
# Fixed value: the action that adds a file; every other action adds nothing.
ACTION_ADD = "add"


def decode_base64_text(b64: Column) -> Column:
    """base64 text to UTF-8 text; malformed base64 gives null, not an error."""
    return F.decode(F.try_to_binary(b64, F.lit("base64")), "UTF-8")


def parse_file_op(text: Column) -> Column:
    """struct(matched, path, action, size, columns) of one decoded file op.

    The first match anywhere in the text counts, as with a regex ``find``. A text
    without a match gives ``matched = false`` and empty strings; a size that is not a
    number gives a null ``size``.
    """
    pat = F.lit(FILE_OP_PATTERN)
    return F.struct(
        F.coalesce(F.regexp_like(text, pat), F.lit(False)).alias("matched"),
        F.regexp_extract(text, FILE_OP_PATTERN, 1).alias("path"),
        F.regexp_extract(text, FILE_OP_PATTERN, 2).alias("action"),
        F.regexp_extract(text, FILE_OP_PATTERN, 3).try_cast("bigint").alias("size"),
        F.regexp_extract(text, FILE_OP_PATTERN, 4).alias("columns"),
    )


def action_and_size(file_ops: Column) -> Column:
    """Per file op of a commit: struct(action, size); one regex evaluation per op.

    ``action`` is '' when the text does not match (group 2 of a match is never
    empty), ``size`` null when it is not a number.
    """
    def both(b64: Column) -> Column:
        return F.regexp_extract(decode_base64_text(b64), ACTION_SIZE_PATTERN, 1)

    def one(text: Column) -> Column:
        return F.struct(
            F.coalesce(F.substring_index(text, ",", 1), F.lit("")).alias("action"),
            F.substring_index(text, ",", -1).try_cast("bigint").alias("size"))
    return F.transform(F.transform(file_ops, both), one)


def fold_file_stats(ops: Column) -> Column:
    """A1 fold over the output of ``action_and_size``, in one pass over the array:
    struct(n, bytes, unmatched, bad_size). ``n`` is the number of ``add`` ops and
    ``bytes`` the sum of their sizes; ``del`` ops add nothing."""
    zero = F.lit(0).cast("bigint")
    init = F.struct(zero.alias("n"), zero.alias("bytes"), F.lit(False).alias("unmatched"),
                    F.lit(False).alias("bad_size"))

    def step(acc: Column, op: Column) -> Column:
        is_add = op["action"] == F.lit(ACTION_ADD)
        return F.struct(
            (acc["n"] + F.when(is_add, 1).otherwise(0)).alias("n"),
            (acc["bytes"] + F.when(is_add, F.coalesce(op["size"], zero)).otherwise(zero)).alias("bytes"),
            (acc["unmatched"] | (op["action"] == F.lit(""))).alias("unmatched"),
            (acc["bad_size"] | (is_add & op["size"].isNull())).alias("bad_size"))

    return F.aggregate(ops, init, step)


def file_stats_columns(folded: Column, file_ops: Column) -> tuple[Column, Column, Column]:
    """(file_count, file_bytes, problem) from the fold. ``problem`` is null for a clean
    commit, else the reason it goes to quarantine instead of being counted: a missing
    array, an op that does not match the pattern, or an ``add`` whose size is not a
    number."""
    zero = F.lit(0).cast("bigint")
    problem = (F.when(file_ops.isNull(), F.lit("missing_file_ops"))
               .when(folded["unmatched"], F.lit("unparsed_file_op"))
               .when(folded["bad_size"], F.lit("bad_file_size")))
    return (F.coalesce(folded["n"], zero), F.coalesce(folded["bytes"], zero), problem)


def text_to_bool(text: Column) -> Column:
    """F4 for flags: ``true`` in any case is true; anything else, null included, false."""
    return F.coalesce(F.lower(F.trim(text.cast("string"))) == F.lit("true"), F.lit(False))
