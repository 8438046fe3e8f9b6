"""Schemas of the forum tables and the column guard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_COMMENTS = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("author_flair_css_class", T.StringType()),
        T.StructField("author_flair_text", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("controversiality", T.LongType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("distinguished", T.StringType()),
        T.StructField("edited", T.DoubleType()),
        T.StructField("gilded", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("retrieved_on", T.LongType()),
        T.StructField("score", T.LongType()),
        T.StructField("stickied", T.BooleanType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("subreddit_id", T.StringType()),
    ]
)

COMMENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("link_id", T.StringType()),
        T.StructField("controversiality", T.LongType()),
        T.StructField("gilded", T.LongType()),
    ]
)

SUBMISSIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("num_comments", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("over_18", T.BooleanType()),
    ]
)

TRIPS = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("passenger_count", T.DoubleType()),
    ]
)

COMMENT_COLUMNS = COMMENTS.fieldNames()
SUBMISSION_COLUMNS = SUBMISSIONS.fieldNames()

# Raw columns worth reporting when a table is profiled.
INTERESTING_COLUMNS = [
    "id", "subreddit", "author", "title", "body", "selftext", "score", "num_comments",
    "created_utc", "upvote_ratio", "over_18", "url", "parent_id", "link_id", "link_flair_text",
    "controversiality", "gilded",
]


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return `df`, or raise a clear error naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    return df
