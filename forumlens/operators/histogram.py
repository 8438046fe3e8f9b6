"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """Counts in `bins` equal-width bins between the smallest and largest value.

    The last bin includes the maximum; a constant column falls into bin 0. The limits reach the rows
    as one scalar subquery, so the values are counted where they are and only bin counts are shuffled.
    """
    values = df.select(value.cast("double").alias("v")).where(F.col("v").isNotNull())
    limits = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    width = (F.col("l.hi") - F.col("l.lo")) / bins
    slot = F.coalesce(F.try_divide((F.col("v") - F.col("l.lo")) * bins, F.col("l.hi") - F.col("l.lo")), F.lit(0.0))
    return (
        values.withColumn("l", limits)
        .groupBy(F.least(F.floor(slot), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.first("l").alias("l"))
        .select(
            "bin",
            (F.col("l.lo") + width * F.col("bin")).alias("bin_start"),
            (F.col("l.lo") + width * (F.col("bin") + 1)).alias("bin_end"),
            "n",
        )
    )
