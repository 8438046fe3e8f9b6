"""Posts as they arrive: new files are filtered, counted and cut into sessions with Structured Streaming.

Every query is written with a sink that a repeated micro-batch overwrites, so results after a crash and a restart are those
of one batch over all files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from forumlens import schemas, vocab
from forumlens.sources.ingest import filtered

RAW = {"comments": schemas.RAW_COMMENTS, "submissions": schemas.SUBMISSIONS}


def read_new(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """The Parquet files of a folder or pattern as a stream, each file once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def with_time(posts: DataFrame, late: str) -> DataFrame:
    """Posts with their time as `ts`; rows more than `late` behind the latest time of the batches before are dropped."""
    return posts.withColumn("ts", F.timestamp_seconds("created_utc")).withWatermark("ts", late)


def new_posts(posts: DataFrame, late: str = "7 days") -> DataFrame:
    """The first of the rows that share an id, as long as they are no more than `late` apart."""
    return with_time(posts, late).dropDuplicatesWithinWatermark(["id"]).drop("ts")


def count_hours(posts: DataFrame) -> DataFrame:
    """Posts, scores and their sum per hour, community and kind; sums of parts of the posts add up to those of all."""
    counts = posts.groupBy(F.window("ts", "1 hour").alias("window"), "subreddit", "data_type").agg(
        F.count(F.lit(1)).alias("num_posts"), F.count("score").alias("scored"), F.sum("score").alias("score_sum")
    )
    return counts.withColumn("window", F.col("window.start")).withColumnRenamed("window", "hour")


def closed_hours(posts: DataFrame, late: str = "7 days") -> DataFrame:
    """`count_hours` of a stream in append mode: an hour is given out when no accepted post can add to it any more.

    The state holds one row for each hour still open, community and kind. What is dropped as too late depends on how files
    fall into micro-batches, and the first one after a restart drops nothing; a late post then comes as a further row of its hour.
    """
    return count_hours(with_time(posts, late))


def author_sessions(posts: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """An author's posts no more than `gap` apart as one session: first and last time, posts and communities met.

    A session leaves the state and is given out once no post that may still be accepted can add to it. Sessions are merged
    in map tasks too if `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition` is set.
    """
    return (
        with_time(posts, late)
        .groupBy(F.session_window("ts", gap).alias("session"), "author")
        .agg(F.count(F.lit(1)).alias("num_posts"), F.approx_count_distinct("subreddit").alias("communities"))
        .select("author", F.col("session.start").alias("start"), F.col("session.end").alias("end"), "num_posts", "communities")
    )


def write_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived and stop. A micro-batch writes its own folder, which a repetition of it replaces.

    Offsets are logged in `checkpoint` before a micro-batch runs, so a restart repeats it with the same files.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def write_hourly_counts(posts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the counts of what has arrived to `path`, and stop.

    Each micro-batch counts its own posts and no state is kept, so posts may be late by any time.
    """

    def write(batch: DataFrame, number: int) -> None:
        timed = batch.withColumn("ts", F.timestamp_seconds("created_utc"))
        count_hours(timed).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = posts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def read_hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts that micro-batches or closed hours left in `path`, added up."""
    sums = [F.sum(c).alias(c) for c in ("num_posts", "scored", "score_sum")]
    return spark.read.parquet(path).groupBy("hour", "subreddit", "data_type").agg(*sums)


def ingest_new(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    communities: Sequence[str] = tuple(vocab.INGEST_COMMUNITIES),
    files_per_batch: int = 1000,
) -> list[StreamingQuery]:
    """Filter the new files of `source/{comments,submissions}` into `target`, like the batch ingest, and stop.

    Each kind is its own query; `target/<kind>` has a folder a micro-batch and is read as one table.
    """
    queries = []
    for kind, schema in RAW.items():
        rows = filtered(read_new(spark, f"{source}/{kind}", schema, files_per_batch), kind, communities)
        queries.append(write_batches(rows, f"{target}/{kind}", f"{checkpoint}/{kind}"))
    return queries
