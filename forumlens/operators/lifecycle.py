"""The life of a submission: how its replies come in over time, when they peak and when half of them are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Steps of the time grid: step 0 is the first minute, step k runs from 2^(k/2) minutes on, the last one has no end.
STEPS = 40


def reply_curve(replies: DataFrame) -> DataFrame:
    """Replies of each submission on a grid of time since it: (root, step, n, upto), with the sum up to and with the step.

    `replies` has root, posted (when the submission was made) and created_utc. Steps grow by the root of two, so a curve has
    at most STEPS rows whatever the number of replies, which are counted before they are sorted. Replies older than
    their submission count in step 0.
    """
    minutes = F.greatest((F.col("created_utc") - F.col("posted")) / 60, F.lit(0.0))
    step = F.when(minutes < 1, 0).otherwise(F.least(F.floor(2 * F.log2(minutes) + 1e-9) + 1, F.lit(STEPS - 1)))
    counts = replies.groupBy("root", step.cast("int").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("root").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("upto", F.sum("n").over(upto))


def lifecycle(replies: DataFrame, observed_to: int | None = None, quiet: int = 2 * 86400) -> DataFrame:
    """One row per submission with replies: how many, when they peak, the time to half of them, and whether more may come.

    `peak_hour` is the busiest hour since the submission (the first of equals), `half_life` the number of hours after which
    at least half of the replies had come, both from counts by hour. A submission is `unfinished` if its last reply is
    less than `quiet` seconds before `observed_to` (the latest reply of all if not given): more replies may follow, so
    its half life is a lower bound, a censored value.
    """
    hours = replies.withColumn("hour", F.floor(F.greatest(F.col("created_utc") - F.col("posted"), F.lit(0)) / 3600))
    by_hour = hours.groupBy("root", "hour").agg(F.count(F.lit(1)).alias("n"), F.max("created_utc").alias("last"))
    order = Window.partitionBy("root").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    sums = by_hour.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("root")))
    per_root = sums.groupBy("root").agg(
        F.max("all").alias("n_replies"),
        F.min_by("hour", F.struct(-F.col("n"), F.col("hour"))).alias("peak_hour"),
        F.max("n").alias("peak_replies"),
        F.min(F.when(2 * F.col("upto") >= F.col("all"), F.col("hour") + 1)).alias("half_life"),
        F.max("last").alias("last"),
    )
    end = F.lit(observed_to) if observed_to is not None else replies.agg(F.max("created_utc")).scalar()
    return per_root.withColumn("unfinished", F.col("last") > end - quiet).drop("last")


def survival(lives: DataFrame) -> DataFrame:
    """The share of submissions whose half life is longer than each number of hours, unfinished ones censored (Kaplan-Meier).

    Returns half_life, at_risk, ended, censored and survival, by the values that occur: one row an hour at most. Lives are
    counted by value first; the running product is a window over these few rows.
    """
    counts = lives.groupBy("half_life").agg(F.count_if(~F.col("unfinished")).alias("ended"), F.count_if("unfinished").alias("censored"))
    later = Window.orderBy(F.desc("half_life")).rowsBetween(Window.unboundedPreceding, 0)
    risk = counts.withColumn("at_risk", F.sum(F.col("ended") + F.col("censored")).over(later))
    keep = F.log(F.try_divide(F.col("at_risk") - F.col("ended"), F.col("at_risk")))
    stays = F.when(F.col("at_risk") > F.col("ended"), keep)
    so_far = Window.orderBy("half_life").rowsBetween(Window.unboundedPreceding, 0)
    gone = F.max((F.col("at_risk") == F.col("ended")).cast("int")).over(so_far)
    return risk.select(
        "half_life", "at_risk", "ended", "censored",
        F.when(gone == 1, 0.0).otherwise(F.exp(F.sum(stays).over(so_far))).alias("survival"),
    )
