"""Author activity, top contributors, best posts and community footprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions.categories import breadth_class
from forumlens.functions.time import SECONDS_PER_YEAR
from forumlens.operators.histogram import histogram

POST_COLUMNS = ["subreddit", "author", "title", "body", "score", "created_utc"]


def _by_score() -> list[Column]:
    """Score order with ties broken, so that every run ranks alike."""
    return [F.desc("score"), F.col("created_utc"), F.col("id"), F.col("data_type")]


def author_community_stats(posts: DataFrame) -> DataFrame:
    """Posts per kind, mean and best score, first and last time per (community, author)."""
    stats = posts.groupBy("subreddit", "author").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.count_if(F.col("data_type") == "comment").alias("num_comments"),
        F.count_if(F.col("data_type") == "submission").alias("num_submissions"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("scored_posts"),
        F.max("score").alias("max_score"),
        F.min("created_utc").alias("first_post"),
        F.max("created_utc").alias("last_post"),
    )
    return stats.withColumn("avg_score", F.try_divide("score_sum", "scored_posts")).withColumn(
        "active_span_seconds", F.col("last_post") - F.col("first_post")
    )


def author_stats(posts: DataFrame) -> DataFrame:
    """Posts per kind, communities, mean and best score, first and last time per author.

    Two steps: (community, author) first, which spreads an author who wrote a third of all rows over
    many groups, then the author over at most one row per community.
    """
    stats = (
        author_community_stats(posts)
        .groupBy("author")
        .agg(
            F.sum("total_posts").alias("total_posts"),
            F.count(F.lit(1)).alias("num_subreddits"),
            F.try_divide(F.sum("score_sum"), F.sum("scored_posts")).alias("avg_score"),
            F.max("max_score").alias("max_score"),
            F.min("first_post").alias("first_post"),
            F.max("last_post").alias("last_post"),
            F.sum("num_comments").alias("num_comments"),
            F.sum("num_submissions").alias("num_submissions"),
            F.array_sort(F.collect_list("subreddit")).alias("communities"),
        )
    )
    return stats.withColumn("active_span_seconds", F.col("last_post") - F.col("first_post"))


def footprint(stats: DataFrame) -> DataFrame:
    """Community names of an author in alphabetical order, as a list, a size and a string."""
    return stats.withColumn("num_tech_subreddits", F.size("communities")).withColumn(
        "tech_subreddits_str", F.concat_ws(", ", "communities")
    )


def author_kind_counts(posts: DataFrame, by: Sequence[str] = ("author",)) -> DataFrame:
    """Comments and submissions per author as two columns."""
    return posts.groupBy(*by).agg(
        F.count_if(F.col("data_type") == "comment").alias("num_comments"),
        F.count_if(F.col("data_type") == "submission").alias("num_submissions"),
    )


def top_authors(stats: DataFrame, quantile: float = 0.99, value: str = "total_posts") -> DataFrame:
    """Authors at or above the global activity quantile, ties included.

    The threshold is a scalar subquery, so it never visits the driver.
    """
    threshold = stats.agg(F.percentile_approx(value, quantile)).scalar()
    return stats.where(F.col(value) >= threshold).withColumn("p99_posts", threshold)


def community_thresholds(stats: DataFrame, quantile: float = 0.99, value: str = "total_posts") -> DataFrame:
    """Activity quantile per community over its authors."""
    return stats.groupBy("subreddit").agg(F.percentile_approx(value, quantile).alias("p99_posts"))


def top_authors_by_community(
    stats: DataFrame,
    quantile: float = 0.99,
    value: str = "total_posts",
    communities: Sequence[str] | None = None,
) -> DataFrame:
    """Authors at or above the quantile of their community, ties included.

    The join key is the community, and one community may hold most authors; the thresholds have a row for
    each community, and the planner sizes them at run time.
    """
    if communities is not None:
        stats = stats.where(F.col("subreddit").isin(*communities))
    thresholds = community_thresholds(stats, quantile, value)
    return stats.join(thresholds, "subreddit").where(F.col(value) >= F.col("p99_posts"))


def posts_of(posts: DataFrame, authors: DataFrame, keys: Sequence[str] = ("author",)) -> DataFrame:
    """Posts written by the selected authors."""
    return posts.join(authors.select(*keys).distinct(), list(keys), "left_semi")


def _winners(posts: DataFrame, by: Sequence[str], n: int, rank: str) -> DataFrame:
    """The `n` first posts by score in each group, with all their columns.

    Only narrow columns are ranked: each map task keeps `n` rows of a group before the shuffle, and no text
    is sorted or sent. The winners' texts come back by group and a hash of the whole row. Rows equal in every
    column keep a rank each.
    """
    keyed = posts.withColumn("_row", F.xxhash64(*posts.columns))
    narrow = keyed.select(*dict.fromkeys([*by, "score", "created_utc", "id", "data_type", "_row"]))
    window = Window.partitionBy(*by).orderBy(*_by_score(), "_row")
    won = narrow.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n).select(*by, "_row", rank)
    same = F.col("p._row") == F.col("w._row")
    for column in by:
        same = same & F.col(f"p.{column}").eqNullSafe(F.col(f"w.{column}"))
    found = keyed.alias("p").join(won.alias("w"), same).select(*[f"p.`{c}`" for c in posts.columns], f"w.{rank}")
    return found.dropDuplicates([*by, rank])


def top_posts(posts: DataFrame, n: int = 5, by: str = "subreddit") -> DataFrame:
    """The `n` highest-scored posts per community."""
    return _winners(posts, [by], n, "rank")


def best_posts(posts: DataFrame, by: Sequence[str] = ("author",)) -> DataFrame:
    """The highest-scored post per author, or per (community, author)."""
    return _winners(posts, list(by), 1, "_rank").drop("_rank")


def top_author_profile(posts: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Top authors with their footprint and best post."""
    top = footprint(top_authors(author_stats(posts), quantile))
    best = best_posts(posts_of(posts, top)).select(
        "author",
        F.col("subreddit").alias("best_subreddit"),
        F.col("title").alias("best_title"),
        F.col("body").alias("best_body"),
        F.col("score").alias("best_score"),
        F.col("created_utc").alias("best_created_utc"),
    )
    return top.join(best, "author", "left")


def top_author_profile_by_community(
    posts: DataFrame, quantile: float = 0.99, communities: Sequence[str] | None = None
) -> DataFrame:
    """Top authors of each community with their best post there."""
    keys = ["subreddit", "author"]
    top = top_authors_by_community(author_community_stats(posts), quantile, communities=communities)
    best = best_posts(posts_of(posts, top, keys), keys).select(
        *keys,
        F.col("title").alias("best_title"),
        F.col("body").alias("best_body"),
        F.col("score").alias("best_score"),
        F.col("created_utc").alias("best_created_utc"),
    )
    return top.join(best, keys, "left")


def breadth_distribution(stats: DataFrame) -> DataFrame:
    """Authors per breadth class with percent rounded to 2."""
    total = F.sum("n_authors").over(Window.partitionBy())  # over at most three rows
    return (
        stats.groupBy(breadth_class(F.col("num_subreddits")).alias("author_category"))
        .agg(F.count(F.lit(1)).alias("n_authors"))
        .withColumn("percent", F.round(F.col("n_authors") / total * 100, 2))
        .orderBy("author_category")
    )


def span_years() -> Column:
    return F.col("active_span_seconds") / F.lit(SECONDS_PER_YEAR)


def span_histogram(stats: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram of years between an author's first and last post."""
    return histogram(stats, span_years(), bins)


def home_community(stats: DataFrame) -> DataFrame:
    """Community with most posts, and with the highest total score, per author; ties go by name.

    Takes `author_community_stats`; the buffers are fixed-size structs of one row per community.
    """
    def by(value: str) -> Column:
        # min_by over (-value, name): largest value first, then the alphabetically first name
        return F.min_by("subreddit", F.struct(-F.col(value), F.col("subreddit")))

    return stats.groupBy("author").agg(
        by("total_posts").alias("most_posts_in"), by("score_sum").alias("most_score_in")
    )
