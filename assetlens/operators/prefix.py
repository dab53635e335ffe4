"""Distributed prefix aggregates: what came before each change of a key.

A running value over the changes of one key is usually a window over that key, which is one
task's work for a key that holds a third of all rows. Here each key's changes are cut into
ranges of positions. A window runs inside (key, range) only; what a range needs from the ones
before it comes from the ranges' totals, without any window: the ranges before range r are the
left siblings on r's way up a binary tree, so each range adds its total to the tree nodes above
it and takes one node per set bit of r. All of it is grouping and equi-joins on
(key, level, node), with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetlens.session import materialize

Combine = Callable[[Column], Column]
"""An associative and commutative aggregate that combines totals: sum, max, bit_xor."""


def before_ranges(totals: DataFrame, keys: Sequence[str], range_col: str, combine: Mapping[str, Combine],
                  levels: int) -> DataFrame:
    """For each row (keys, range) of ``totals``: the ``combine`` columns taken over the earlier
    ranges of the same keys, null where there are none. ``totals`` has one row per keys and
    range (a written table: it is read twice), ranges are from 0 to ``2 ** levels - 1``, and
    keys are never null."""
    r = F.col(range_col)
    steps = F.sequence(F.lit(0), F.lit(max(levels, 1) - 1))

    def node(level: Column, wanted: int) -> Column:
        index = F.call_function("shiftright", r, level.cast("int"))
        return F.when(index % 2 == wanted, F.struct(level.alias("level"), (index - wanted).alias("node")))

    def nodes(wanted: int, columns: list[str]) -> DataFrame:
        each = F.explode(F.filter(F.transform(steps, lambda level: node(level, wanted)), lambda n: n.isNotNull()))
        return totals.select(*keys, *columns, each.alias("__n")).select(*keys, *columns, "__n.level", "__n.node")

    left = (nodes(0, list(combine)).groupBy(*keys, "level", "node")
            .agg(*[f(F.col(name)).alias(name) for name, f in combine.items()]))
    found = nodes(1, [range_col]).join(left, [*keys, "level", "node"])
    return found.groupBy(*keys, range_col).agg(*[f(F.col(name)).alias(name) for name, f in combine.items()])


def levels_for(ranges: int) -> int:
    """Tree levels for range numbers below ``ranges``."""
    return max(int(ranges) - 1, 0).bit_length()


RANGE = "__range"
RANGE_ROWS = 1_000_000
"""Rows of the whole log in a range of positions, about; a task sorts at most those of one key."""


def with_ranges(rows: DataFrame, position: str = "seq") -> tuple[DataFrame, int]:
    """``rows`` (a written table) with the number of the position's range, and the tree levels:
    ranges of equal width, as many as the row count asks for. Three numbers come to the driver."""
    lo, hi, n = rows.agg(F.min(position), F.max(position), F.count(F.lit(1))).first()
    if not n:
        return rows.withColumn(RANGE, F.lit(0).cast("bigint")), 0
    ranges = -(-n // RANGE_ROWS)
    width = (hi - lo) // ranges + 1
    number = F.expr(f"(`{position}` - {lo}L) DIV {width}L")
    return rows.withColumn(RANGE, number.cast("bigint")), levels_for((hi - lo) // width + 1)


def running(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str] = (),
            latest: Sequence[str] = (), previous: Sequence[str] = ()) -> DataFrame:
    """``rows`` (a written table) with its columns ``sums`` replaced by their running sums (the row
    itself included, a null adds nothing), ``latest`` by the last value that is not null up to the
    row, and ``previous`` by the last such value before the row, in the order ``order`` within
    ``keys``. The first of ``order`` is the position; together they tell the rows of a key apart."""
    ranged, levels = with_ranges(rows, order[0])
    zero = F.lit(0).cast("bigint")
    merge: dict[str, Combine] = {c: F.sum for c in sums} | {c: F.max for c in (*latest, *previous)}
    totals = [F.coalesce(F.sum(c), zero).alias(c) for c in sums]
    totals += [F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("value")))).alias(c)
               for c in (*latest, *previous)]
    per_range = materialize(ranged.groupBy(*keys, RANGE).agg(*totals), "range-totals")
    before = before_ranges(per_range, keys, RANGE, merge, levels)
    before = before.select(*keys, RANGE, *[F.col(c).alias(f"__before_{c}") for c in merge])
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        *[c for c in ranged.columns if c not in merge], *[F.coalesce(F.sum(c).over(upto), zero).alias(c) for c in sums],
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in latest],
        *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in previous])
    joined = local.join(before, [*keys, RANGE], "left")

    def column(c: str) -> Column:
        if c in sums:
            return (F.col(c) + F.coalesce(f"__before_{c}", zero)).cast("bigint").alias(c)
        return F.coalesce(c, F.col(f"__before_{c}.value")).alias(c) if c in merge else F.col(c)

    return joined.select(*[column(c) for c in rows.columns])
