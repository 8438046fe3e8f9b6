"""Row numbers and running totals over a whole table's order, without a window that one task would have to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import stage

#: Bits of a row's place that name it within its part of the order.
_BITS = 33


def _free(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    while name in df.columns:
        name += "_"
    return name


def _placed(df: DataFrame, order: Sequence[Column], at: str) -> DataFrame:
    """`df` sorted over all partitions and stored; `at` grows along the order and names the part in its high bits.

    Rows equal in `order` are dealt over parts by their place in the input, so no key is too hot for a part.
    """
    spread = _free(df, "spread")
    rows = df.withColumn(spread, F.monotonically_increasing_id())
    return stage(rows.orderBy(*order, spread).drop(spread).withColumn(at, F.monotonically_increasing_id()))


def _parts(placed: DataFrame, at: str, part: str, sums: dict[str, Column]) -> DataFrame:
    """For each part of the order the totals of all parts before it: one row a partition, so it may be broadcast."""
    totals = placed.groupBy(F.shiftright(at, _BITS).alias(part)).agg(*[v.alias(k) for k, v in sums.items()])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(k) for k in sums])


def number_rows(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """`df` with each row's place in `order`, from 1, as `name`.

    The rows are sorted by range and stored once; a row's number is its place in its part plus the rows of the
    parts before. Rows that `order` does not tell apart get different numbers in any order.
    """
    at, part, rows = (_free(df, n) for n in ("row_at", "row_part", "rows_before"))
    placed = _placed(df, order, at).withColumn(part, F.shiftright(at, _BITS))
    before = _parts(placed, at, part, {rows: F.count(F.lit(1))})
    number = F.col(rows) + F.col(at).bitwiseAND((1 << _BITS) - 1) + 1
    joined = placed.join(F.broadcast(before), part)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """`df` with running totals along `order`: for each `new: column`, the sum of `column` up to and with the row.

    The order must tell rows apart. Totals run within each part of a sort by range, and the totals of the parts
    before are added; no task holds more than its part.
    """
    at, part = _free(df, "row_at"), _free(df, "row_part")
    placed = _placed(df, order, at).withColumn(part, F.shiftright(at, _BITS))
    earlier = {new: _free(df, f"{new}_before") for new in sums}
    before = _parts(placed, at, part, {earlier[new]: F.sum(old) for new, old in sums.items()})
    upto = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(old).over(upto).alias(new) for new, old in sums.items()])
    joined = local.join(F.broadcast(before), part)
    totals = [(F.col(new) + F.col(earlier[new])).alias(new) for new in sums]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *totals)
