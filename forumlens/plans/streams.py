"""Queries that run as streams over the tables' files and read back what the sink holds."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.plans.registry import query
from forumlens.session import checkpoint_dir
from forumlens.sources import sample_tables as st
from forumlens.streaming import posts as streams

@query(
    "stream_hourly_counts",
    """WITH {meta} SELECT subreddit, data_type, epoch(date_trunc('hour', ts))::BIGINT AS hour_start, count(*) AS num_posts, count(score) AS scored,
      CAST(sum(score) AS BIGINT) AS score_sum FROM meta GROUP BY ALL""",
)
def stream_hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = streams.read_new(spark, f"{sf}/events.parquet*", st.table(spark, sf, "events").schema)
    folder = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    streams.write_hourly_counts(st.meta_of(events), f"{folder}/counts", f"{folder}/log").awaitTermination()
    counts = streams.read_hourly_counts(spark, f"{folder}/counts")
    return counts.select("subreddit", "data_type", F.unix_seconds("hour").alias("hour_start"), "num_posts", "scored", "score_sum")
