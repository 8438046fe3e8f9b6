"""Distinct counts over any period from stored sketches: one scan builds them, any union of them answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions.time import year_month

#: Binary logarithm of a sketch's buckets: a relative error of about 0.8 % and at most 10 KB a sketch.
LOG_BUCKETS = 14


def monthly_sketches(posts: DataFrame, columns: Sequence[str] = ("author", "id"), log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """For each community and month, posts and a mergeable sketch of the different values of each column.

    Sketches of map tasks are merged, so a hot community sends one sketch a task.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(log_buckets)).alias(f"{c}_sketch") for c in columns]
    return posts.groupBy("subreddit", year_month().alias("year_month")).agg(F.count(F.lit(1)).alias("num_posts"), *sketches)


def merged(sketches: DataFrame, by: Sequence[str] = (), first: str | None = None, last: str | None = None) -> DataFrame:
    """Sketches of months `first` to `last` (both included, as `2024-03`) put together by the columns `by`; posts are never read again."""
    chosen = sketches
    if first is not None:
        chosen = chosen.where(F.col("year_month") >= first)
    if last is not None:
        chosen = chosen.where(F.col("year_month") <= last)
    unions = [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.endswith("_sketch")]
    return chosen.groupBy(*by).agg(F.sum("num_posts").alias("num_posts"), *unions)


def estimates(sketches: DataFrame) -> DataFrame:
    """The number of different values that each sketch stands for, as `distinct_<column>`, in place of the sketches."""
    out = []
    for c in sketches.columns:
        short = c.removesuffix("_sketch")
        out.append(F.hll_sketch_estimate(c).alias(f"distinct_{short}") if c != short else F.col(c))
    return sketches.select(*out)
