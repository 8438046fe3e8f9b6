"""Title style and engagement per category, and engagement around release dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import categories, text
from forumlens.functions.time import created_date


def with_category(df: DataFrame) -> DataFrame:
    return df.withColumn("category", categories.by_name())


def with_title_features(df: DataFrame) -> DataFrame:
    return df.withColumns(text.title_features())


def without_outliers(df: DataFrame, max_comments: int = 500, max_title: int = 300) -> DataFrame:
    """Categorised posts below the comment and title-length limits."""
    return df.where(
        F.col("category").isNotNull()
        & (F.col("num_comments") < max_comments)
        & (F.col("title_length") < max_title)
    )


def category_summary(df: DataFrame) -> DataFrame:
    """Sixteen statistics per category over posts with title features."""

    def share(column: str):
        return F.sum(column) / F.count(F.lit(1)) * 100

    return (
        df.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("total_posts"),
            F.avg("title_length").alias("avg_title_length"),
            F.stddev("title_length").alias("std_title_length"),
            F.avg("title_word_count").alias("avg_word_count"),
            share("is_question").alias("question_pct"),
            share("starts_with_how").alias("how_pct"),
            share("starts_with_what").alias("what_pct"),
            share("starts_with_why").alias("why_pct"),
            F.avg("num_comments").alias("avg_comments"),
            F.stddev("num_comments").alias("std_comments"),
            F.percentile_approx("num_comments", 0.5).alias("median_comments"),
            F.avg("score").alias("avg_score"),
            F.stddev("score").alias("std_score"),
            F.percentile_approx("score", 0.5).alias("median_score"),
            F.max("num_comments").alias("max_comments"),
            F.max("score").alias("max_score"),
        )
        .orderBy(F.desc("avg_comments"))
    )


def question_impact(df: DataFrame) -> DataFrame:
    """Mean comments and score of question and other posts side by side; 0 where a side is empty."""

    def mean(column: str, flag: int):
        return F.coalesce(F.avg(F.when(F.col("is_question") == flag, F.col(column))), F.lit(0.0))

    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.count_if(F.col("is_question") == 0).alias("posts_non_question"),
            F.count_if(F.col("is_question") == 1).alias("posts_question"),
            mean("num_comments", 0).alias("comments_non_question"),
            mean("num_comments", 1).alias("comments_question"),
            mean("score", 0).alias("score_non_question"),
            mean("score", 1).alias("score_question"),
        )
    )


def title_length_bins(df: DataFrame, min_posts: int = 10) -> DataFrame:
    """Means per category and title-length bin, for bins with enough posts."""
    return (
        df.where(F.col("category").isNotNull())
        .groupBy("category", text.length_bin(F.col("title_length")).alias("length_bin"))
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.avg("num_comments").alias("avg_comments"),
            F.avg("score").alias("avg_score"),
        )
        .where(F.col("post_count") >= min_posts)
    )


def bin_matrix(
    bins: DataFrame, value: str = "avg_comments", categories_: Sequence[str] = tuple(vocab.SIX_WAY_CATEGORY)
) -> DataFrame:
    """Bins as rows, categories as columns."""
    return bins.groupBy("length_bin").pivot("category", list(categories_)).agg(F.first(value))


def length_trend(df: DataFrame) -> DataFrame:
    """Least-squares line and correlation of comments on title length per category, over all posts."""
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("num_comments", "title_length").alias("slope"),
        F.regr_intercept("num_comments", "title_length").alias("intercept"),
        F.corr("title_length", "num_comments").alias("pearson_r"),
    )


def daily_engagement(posts: DataFrame) -> DataFrame:
    """Posts, mean score and mean comments per community and day."""
    return posts.groupBy("subreddit", created_date().alias("day")).agg(
        F.count(F.lit(1)).alias("num_posts"),
        F.avg("score").alias("avg_score"),
        F.avg("num_comments").alias("avg_comments"),
    )


# Days relative to the release: two weeks before, two weeks after, four to eight weeks before.
EVENT_WINDOWS = {"pre": (-14, -1), "post": (0, 13), "baseline": (-56, -29)}


def event_days(daily: DataFrame, events: Sequence[tuple[str, str]] = tuple(vocab.RELEASE_EVENTS)) -> DataFrame:
    """Daily rows tagged with the release and the window they fall into.

    The windows are spread out to one row per release and day (84 rows per release, a bound set by the
    caller's list), so the match is an equality join on the day rather than a range join.
    """
    spark = daily.sparkSession
    windows = F.array(
        *[
            F.struct(F.lit(name).alias("phase"), F.lit(first).alias("first"), F.lit(last).alias("last"))
            for name, (first, last) in EVENT_WINDOWS.items()
        ]
    )
    calendar = (
        spark.createDataFrame(list(events), "event string, event_date string")
        .select("event", F.to_date("event_date").alias("event_date"), F.explode(windows).alias("w"))
        .select("event", "event_date", "w.phase", F.explode(F.sequence("w.first", "w.last")).alias("offset"))
        .withColumn("day", F.date_add("event_date", F.col("offset")))
    )
    return daily.join(calendar, "day")


def event_study(
    daily: DataFrame,
    value: str = "avg_score",
    events: Sequence[tuple[str, str]] = tuple(vocab.RELEASE_EVENTS),
    critical_t: float = 2.0,
    hold: float = 0.5,
) -> DataFrame:
    """Before/after comparison of a daily measure per release and community.

    Welch t, Cohen's d and Mann-Whitney U (with its z score, average ranks on ties) compare the 14 days
    before with the 14 days from the release on. `pattern` is `none` when |t| stays below `critical_t`,
    `sustained` when the second week keeps at least `hold` of the change, else `spike`.
    """
    rows = event_days(daily, events).where(F.col(value).isNotNull()).withColumn("x", F.col(value).cast("double"))
    keys = ["event", "event_date", "subreddit"]
    pair = F.col("phase").isin("pre", "post")
    # at most 28 daily rows per group
    group = Window.partitionBy(*keys, pair)
    ranked = rows.withColumn(
        "avg_rank",
        F.rank().over(group.orderBy("x"))
        + (F.count(F.lit(1)).over(Window.partitionBy(*keys, pair, "x")) - 1) / 2,
    )

    def of(phase: str, column: str = "x"):
        return F.when(F.col("phase") == phase, F.col(column))

    second_week = F.when((F.col("phase") == "post") & (F.col("offset") >= 7), F.col("x"))
    stats = ranked.groupBy(*keys).agg(
        F.count(of("pre")).alias("n_pre"),
        F.count(of("post")).alias("n_post"),
        F.avg(of("baseline")).alias("mean_baseline"),
        F.avg(of("pre")).alias("mean_pre"),
        F.avg(of("post")).alias("mean_post"),
        F.avg(second_week).alias("mean_second_week"),
        F.var_samp(of("pre")).alias("_vpre"),
        F.var_samp(of("post")).alias("_vpost"),
        F.sum(of("post", "avg_rank")).alias("_rank"),
    )
    n1, n2 = F.col("n_pre"), F.col("n_post")
    diff = F.col("mean_post") - F.col("mean_pre")
    pooled = F.sqrt(F.try_divide((n1 - 1) * F.col("_vpre") + (n2 - 1) * F.col("_vpost"), n1 + n2 - 2))
    error = F.sqrt(F.try_divide(F.col("_vpre"), n1) + F.try_divide(F.col("_vpost"), n2))
    u = F.col("_rank") - n2 * (n2 + 1) / 2
    kept = F.try_divide(F.col("mean_second_week") - F.col("mean_pre"), diff)
    return (
        stats.withColumn("lift", diff)
        .withColumn("welch_t", F.try_divide(diff, error))
        .withColumn("cohens_d", F.try_divide(diff, pooled))
        .withColumn("mann_whitney_u", u)
        .withColumn(
            "u_z", F.try_divide(u - n1 * n2 / 2, F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0))
        )
        .withColumn(
            "pattern",
            F.when(F.col("welch_t").isNull() | (F.abs("welch_t") < critical_t), "none")
            .when(kept >= hold, "sustained")
            .otherwise("spike"),
        )
        .drop("_vpre", "_vpost", "_rank")
    )
