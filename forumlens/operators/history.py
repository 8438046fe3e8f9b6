"""What a key did before a time: counts and moments over strictly earlier rows, for keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400
_SUMS = ("n_rows", "n", "total", "squares")


def history_before(
    rows: DataFrame, probes: DataFrame, key: str = "author", at: str = "created_utc", value: str = "score"
) -> DataFrame:
    """`probes` with n_before, avg_before, sd_before and seconds_since_last of the rows of the same `key` strictly earlier.

    An as-of join on prefix sums. Rows are summed by (key, second) and then by (key, day). A day's prefix is a
    window over its key's days, a second's one over the seconds of its key and day, at most 86,400; so no task
    holds all rows of a hot key, and rows of one second never see one another. The moments are sums of whole
    numbers, exact in any order. `value` is an integer column; its nulls count as rows but not in the moments. Probes without a key or time
    have no history (0 rows, nulls). The mean is null without values, the deviation without two.
    """
    v = F.col(value).cast("decimal(38,0)")
    second = [F.col(key), F.col(at), F.floor(F.col(at) / DAY).alias("day")]
    counted = rows.groupBy(*second).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares")
    )
    zero = [F.lit(0).cast(counted.schema[c].dataType).alias(c) for c in _SUMS]
    times = counted.unionByName(probes.select(*second, *zero)).groupBy(key, at, "day").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.max(F.when(F.col("n_rows") > 0, F.col(at))).alias("last")
    )
    times = times.where(F.col(key).isNotNull() & F.col(at).isNotNull())

    def before(keys: list[str], order: str):
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.sum(c).over(window).alias(f"{c}_{order}") for c in _SUMS] + [F.max("last").over(window).alias(f"last_{order}")]

    days = times.groupBy(key, "day").agg(*[F.sum(c).alias(c) for c in _SUMS], F.max("last").alias("last"))
    earlier_days = days.select(key, F.col("day"), *before([key], "day"))
    within = times.select(key, "day", at, *before([key, "day"], at))
    both = within.join(earlier_days, [key, "day"])

    def sums(c: str):
        return F.coalesce(F.col(f"{c}_day"), F.lit(0)) + F.coalesce(F.col(f"{c}_{at}"), F.lit(0))

    n = sums("n")
    spread = (n * sums("squares") - sums("total") * sums("total")).cast("double")
    history = both.select(
        key,
        at,
        sums("n_rows").alias("n_before"),
        F.try_divide(sums("total").cast("double"), n).alias("avg_before"),
        F.sqrt(F.try_divide(spread, F.nullif(n * (n - 1), F.lit(0)).cast("double"))).alias("sd_before"),
        (F.col(at) - F.coalesce(f"last_{at}", "last_day")).alias("seconds_since_last"),
    )
    joined = probes.join(history, [key, at], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in probes.columns], F.coalesce("n_before", F.lit(0)).alias("n_before"),
        "avg_before", "sd_before", "seconds_since_last",
    )


def author_history(posts: DataFrame) -> DataFrame:
    """Each post with its author's history before it."""
    return history_before(posts, posts)


def history_effect(with_history: DataFrame) -> DataFrame:
    """Mean score of posts by how many earlier ones their author had, in powers of two, with the mean of the means before."""
    size = F.when(F.col("n_before") > 0, F.floor(F.log2(F.col("n_before") + F.lit(0.5)))).otherwise(-1)
    return with_history.groupBy(size.cast("long").alias("log2_before")).agg(
        F.count(F.lit(1)).alias("n_posts"), F.avg("score").alias("avg_score"), F.avg("avg_before").alias("avg_before"),
        F.corr(F.col("avg_before"), F.col("score").cast("double")).alias("correlation"),
    )
