"""Quality, activity, engagement and author tables of a filtered archive.

    spark-submit forumlens/jobs/eda.py SOURCE TARGET

SOURCE holds `comments/` and `submissions/`; every table becomes a CSV directory below TARGET.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.operators import activity, authors, engagement, overlap, quality
from forumlens.session import build_session
from forumlens.sources import readers, writers


def tables(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    """All result tables by name, each lazy."""
    comments = readers.read_parquet(spark, f"{source}/comments")
    submissions = readers.read_parquet(spark, f"{source}/submissions")
    posts = readers.unify(comments, submissions)
    tech = posts.where(F.col("subreddit").isin(*vocab.TECH_COMMUNITIES))
    slots = activity.overall_slots(posts)
    titles = engagement.with_title_features(engagement.with_category(submissions))
    stats = authors.author_stats(tech)
    pairs = overlap.overlap_pairs(tech)
    missing = quality.missingness(posts)
    return {
        "dataset_summary": quality.with_size(
            quality.dataset_summary(posts), {"comment": f"{source}/comments", "submission": f"{source}/submissions"}
        ),
        "missingness": quality.missingness_pct(missing),
        "sentinel_rates": quality.sentinel_rates(posts),
        "duplicate_ids": quality.duplicate_ids(posts),
        "duplicate_authors": quality.duplicate_authors(posts),
        "time_range": quality.time_range(posts),
        "score_summary": quality.score_summary(posts),
        "text_quality": quality.text_quality(posts),
        "monthly_activity": activity.monthly_activity(posts),
        "community_stats": activity.community_stats(posts),
        "community_years": activity.roll_up_years(activity.community_monthly(posts)),
        "time_slots": activity.time_slots(posts),
        "slot_roll_up": activity.slot_roll_up(slots),
        "top_slots": activity.top_slots(slots),
        "category_summary": engagement.category_summary(titles),
        "question_impact": engagement.question_impact(titles),
        "title_length_bins": engagement.title_length_bins(titles),
        "length_trend": engagement.length_trend(engagement.without_outliers(titles)),
        "event_study": engagement.event_study(engagement.daily_engagement(posts)),
        "top_authors": authors.top_author_profile(tech).drop("communities"),
        "top_authors_by_community": authors.top_author_profile_by_community(tech, communities=vocab.TECH_COMMUNITIES),
        "breadth_distribution": authors.breadth_distribution(stats),
        "top_posts": authors.top_posts(tech).select("rank", *authors.POST_COLUMNS),
        "home_community": authors.home_community(authors.author_community_stats(tech)),
        "overlap_pairs": pairs,
        "overlap_top": overlap.top_pairs(pairs),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--only", nargs="*", help="names of the tables to write")
    args = parser.parse_args()
    spark = build_session("forumlens-eda")
    for name, df in tables(spark, args.source).items():
        if not args.only or name in args.only:
            writers.write_csv(df, f"{args.target}/{name}")


if __name__ == "__main__":
    main()
