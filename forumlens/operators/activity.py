"""Volume and score over time and per community."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions import time as t


def kind_count(kind: str) -> Column:
    return F.count_if(F.col("data_type") == kind)


def kind_avg(kind: str, value: str = "score") -> Column:
    return F.avg(F.when(F.col("data_type") == kind, F.col(value)))


def monthly_activity(posts: DataFrame) -> DataFrame:
    """Comments, submissions and all rows per month.

    Both kinds are counted in one aggregate, so a month that lacks one kind gets 0 without an outer join.
    """
    return (
        posts.groupBy(t.year_month().alias("year_month"))
        .agg(kind_count("comment").alias("num_comments"), kind_count("submission").alias("num_submissions"))
        .withColumn("total_rows", F.col("num_comments") + F.col("num_submissions"))
        .orderBy("year_month")
    )


def monthly_activity_joined(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """The same result from two separate tables: aggregate each side, then full outer join the months."""

    def months(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(t.year_month().alias("year_month")).agg(F.count(F.lit(1)).alias(name))

    joined = months(comments, "num_comments").join(
        months(submissions, "num_submissions"), "year_month", "full_outer"
    )
    return (
        joined.fillna(0, ["num_comments", "num_submissions"])
        .withColumn("total_rows", F.col("num_comments") + F.col("num_submissions"))
        .orderBy("year_month")
    )


def community_stats(posts: DataFrame) -> DataFrame:
    """Counts, mean scores and date range per community.

    `avg_score_balanced` is the plain mean of the comment mean and the submission mean, with an absent
    side counted as 0; `avg_score` weighs every row alike. A kind that is absent has a NULL count.
    """

    def present(kind: str) -> Column:
        n = kind_count(kind)
        return F.when(n > 0, n)

    day = t.created_date()
    stats = posts.groupBy("subreddit").agg(
        present("comment").alias("num_comments"),
        present("submission").alias("num_submissions"),
        F.count(F.lit(1)).alias("total_rows"),
        F.avg("score").alias("avg_score"),
        kind_avg("comment").alias("_comment"),
        kind_avg("submission").alias("_submission"),
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
    )
    zero = F.lit(0.0)
    return stats.select(
        "subreddit", "num_comments", "num_submissions", "total_rows", "avg_score",
        ((F.coalesce("_comment", zero) + F.coalesce("_submission", zero)) / 2).alias("avg_score_balanced"),
        F.concat_ws(" to ", F.col("_first"), F.col("_last")).alias("date_range"),
    ).orderBy(F.desc("total_rows"), "subreddit")


def community_stats_joined(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Counts, balanced mean score and date range from two tables: aggregate each, full outer join."""

    def side(df: DataFrame, kind: str) -> DataFrame:
        day = t.created_date()
        return df.groupBy("subreddit").agg(
            F.count(F.lit(1)).alias(f"num_{kind}s"),
            F.avg("score").alias(f"avg_{kind}"),
            F.min(day).alias(f"first_{kind}"),
            F.max(day).alias(f"last_{kind}"),
        )

    zero = F.lit(0)
    return (
        side(comments, "comment")
        .join(side(submissions, "submission"), "subreddit", "full_outer")
        .select(
            "subreddit", "num_comments", "num_submissions",
            (F.coalesce("num_comments", zero) + F.coalesce("num_submissions", zero)).alias("total_rows"),
            ((F.coalesce("avg_comment", zero) + F.coalesce("avg_submission", zero)) / 2).alias(
                "avg_score_balanced"
            ),
            F.concat_ws(
                " to ",
                F.least("first_comment", "first_submission"),
                F.greatest("last_comment", "last_submission"),
            ).alias("date_range"),
        )
        .orderBy(F.desc("total_rows"), "subreddit")
    )


def community_monthly(posts: DataFrame) -> DataFrame:
    """Monthly counts per community with the balanced mean score rounded to 2."""
    zero = F.lit(0.0)
    ts = t.created_ts()
    monthly = posts.groupBy("subreddit", F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        kind_count("comment").alias("num_comments"),
        kind_count("submission").alias("num_submissions"),
        kind_avg("comment").alias("_comment"),
        kind_avg("submission").alias("_submission"),
    )
    return monthly.select(
        "subreddit", "year", "month", "num_comments", "num_submissions",
        (F.col("num_comments") + F.col("num_submissions")).alias("total_rows"),
        F.round((F.coalesce("_comment", zero) + F.coalesce("_submission", zero)) / 2, 2).alias("avg_score"),
    )


def roll_up_years(monthly: DataFrame) -> DataFrame:
    """Yearly sums and the mean of the monthly means, all years in one table."""
    return monthly.groupBy("subreddit", "year").agg(
        F.sum("num_comments").alias("num_comments"),
        F.sum("num_submissions").alias("num_submissions"),
        F.sum("total_rows").alias("total_rows"),
        F.avg("avg_score").alias("avg_score"),
    )


def time_slots(posts: DataFrame) -> DataFrame:
    """Posts and mean score per (community, day, hour) and per (day, hour).

    The overall level is built from the community level's sums, so the rows are read and shuffled
    once. Overall rows have a NULL community and `level = 'overall'`.
    """
    base = posts.groupBy(
        "subreddit", t.day_of_week().alias("day_of_week"), t.hour_of_day().alias("hour")
    ).agg(
        F.count("id").alias("num_posts"), F.sum("score").alias("_sum"), F.count("score").alias("_scored")
    )
    return (
        base.groupingSets(
            [["subreddit", "day_of_week", "hour"], ["day_of_week", "hour"]], "subreddit", "day_of_week", "hour"
        )
        .agg(
            F.grouping("subreddit").alias("_overall"),
            F.sum("num_posts").alias("num_posts"),
            F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("avg_score"),
        )
        .select(
            F.when(F.col("_overall") == 1, "overall").otherwise("community").alias("level"),
            "subreddit", "day_of_week", "hour", "num_posts", "avg_score",
        )
    )


def overall_slots(posts: DataFrame) -> DataFrame:
    return posts.groupBy(t.day_of_week().alias("day_of_week"), t.hour_of_day().alias("hour")).agg(
        F.count("id").alias("num_posts"), F.avg("score").alias("avg_score")
    )


def community_slots(posts: DataFrame) -> DataFrame:
    return posts.groupBy(
        "subreddit", t.day_of_week().alias("day_of_week"), t.hour_of_day().alias("hour")
    ).agg(F.count("id").alias("num_posts"), F.avg("score").alias("avg_score"))


def slot_roll_up(slots: DataFrame) -> DataFrame:
    """Posts summed and slot means averaged, per hour and per day, as `(part, value)` rows."""
    hours = slots.select(F.lit("hour").alias("part"), F.col("hour").alias("value"), "num_posts", "avg_score")
    days = slots.select(F.lit("day").alias("part"), F.col("day_of_week").alias("value"), "num_posts", "avg_score")
    return (
        hours.union(days)
        .groupBy("part", "value")
        .agg(F.sum("num_posts").alias("num_posts"), F.avg("avg_score").alias("avg_score"))
    )


def peaks(rolled: DataFrame) -> DataFrame:
    """Busiest and quietest, best and worst scored hour and day; ties go to the lower value."""
    value = F.col("value")

    def highest(by: str) -> Column:
        return F.max_by("value", F.struct(F.col(by), -value))

    def lowest(by: str) -> Column:
        return F.min_by("value", F.struct(F.col(by), value))

    return rolled.groupBy("part").agg(
        highest("num_posts").alias("peak_volume"),
        lowest("num_posts").alias("lowest_volume"),
        highest("avg_score").alias("peak_score"),
        lowest("avg_score").alias("lowest_score"),
    )


def community_slot_summary(slots: DataFrame) -> DataFrame:
    """Sum of posts and mean of slot means per community, largest first."""
    return (
        slots.groupBy("subreddit")
        .agg(F.sum("num_posts").alias("num_posts"), F.avg("avg_score").alias("avg_score"))
        .orderBy(F.desc("num_posts"), "subreddit")
    )


def slot_matrix(slots: DataFrame, value: str = "num_posts", by: Sequence[str] = ()) -> DataFrame:
    """Day rows by 24 hour columns `h0`..`h23`, optionally per community."""
    columns = [F.max(F.when(F.col("hour") == h, F.col(value))).alias(f"h{h}") for h in range(24)]
    return slots.groupBy(*by, "day_of_week").agg(*columns).withColumn(
        "day_name", t.day_name(F.col("day_of_week"))
    )


def top_slots(slots: DataFrame, by: str = "num_posts", n: int = 10) -> DataFrame:
    """The `n` slots with the largest volume or mean score."""
    return (
        slots.select(t.day_name(F.col("day_of_week")).alias("day_name"), "day_of_week", "hour", "num_posts", "avg_score")
        .orderBy(F.desc(by), "day_of_week", "hour")
        .limit(n)
    )


def basic_counts(posts: DataFrame) -> DataFrame:
    """Rows, unique ids and unique authors."""
    def different(column: str) -> Column:
        return posts.agg(F.count_distinct(column)).scalar()

    # One distinct count each: two in one aggregate would send every row twice.
    return posts.agg(F.count(F.lit(1)).alias("num_rows")).select(
        "num_rows", different("id").alias("unique_posts"), different("author").alias("unique_users")
    )


def top_communities(posts: DataFrame, n: int = 10) -> DataFrame:
    return (
        posts.groupBy("subreddit")
        .agg(F.count(F.lit(1)).alias("num_posts"))
        .orderBy(F.desc("num_posts"), "subreddit")
        .limit(n)
    )


def hourly_distribution(posts: DataFrame) -> DataFrame:
    return posts.groupBy(t.hour_of_day().alias("hour")).agg(F.count(F.lit(1)).alias("num_posts"))
