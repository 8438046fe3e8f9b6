"""Joins from many rows to one, where a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one row in so many, so there are never more hot keys than this.
HOT_SHARE = 1000


def look_up(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`rows` joined with the one row of `table` that has their `key`.

    Rows without one are left out, or with `how="left"` kept with nulls. Hot keys are counted with partial sums first.
    Their rows of `table`, at most HOT_SHARE, are broadcast, so the rows of a hot key stay where they are; all other
    rows are shuffled. `rows` is read twice and should be stored.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows_of_key"))
    hot = counts.where(F.col("rows_of_key") * HOT_SHARE > total).select(key)
    few = table.join(F.broadcast(hot), key, "inner" if how == "inner" else "right")
    cold = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(F.broadcast(few), key).unionByName(cold.join(table, key, how))
