"""Streams against batches over the same files, with late rows, restarts and repeated micro-batches."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from forumlens import schemas, vocab
from forumlens.jobs import stream
from forumlens.sources.ingest import ingest
from forumlens.streaming import posts as streams

COLUMNS = "id string, subreddit string, author string, data_type string, created_utc long, score long"
DAY = 86400


def rows_of(df):
    return sorted(map(str, df.collect()))


def add(spark, rows, path, schema=COLUMNS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def forget_commit(log):
    """As after a crash between a micro-batch's write and its commit."""
    last = max((p for p in (Path(log) / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)


def raw(rng, n, first):
    comments, submissions = [], []
    for k in range(first, first + n):
        base = {"id": f"i{k}", "subreddit": rng.choice([*vocab.INGEST_COMMUNITIES[:3], "other", None]), "author": f"u{k % 7}"}
        base |= {"score": k, "created_utc": 1_700_000_000 + 600 * k}
        comments.append(base | {"body": "b", "parent_id": "t3_x", "link_id": "t3_x", "controversiality": 0, "gilded": None})
        submissions.append(base | {"title": "t", "selftext": None, "num_comments": 1, "url": None, "over_18": False})
    return comments, submissions


def test_streamed_ingest_equals_batch_after_restart_and_repetition(spark, tmp_path):
    rng = random.Random(1)
    source, target, log = (str(tmp_path / n) for n in ("raw", "streamed", "log"))
    for part in range(3):
        for kind, rows in zip(("comments", "submissions"), raw(rng, 60, 100 * part)):
            schema = schemas.RAW_COMMENTS if kind == "comments" else schemas.SUBMISSIONS
            add(spark, rows, f"{source}/{kind}", schema)
        # A new query on the old log: the second and third run are restarts.
        for query in streams.ingest_new(spark, source, target, log, files_per_batch=1):
            query.awaitTermination()
    ingest(spark, source, str(tmp_path / "batch"))
    for kind in ("comments", "submissions"):
        want = spark.read.parquet(f"{tmp_path}/batch/{kind}")
        got = spark.read.parquet(f"{target}/{kind}")
        assert got.select("batch").distinct().count() == 3
        assert want.count() > 50 and rows_of(got.select(*want.columns)) == rows_of(want)
        forget_commit(f"{log}/{kind}")
    for query in streams.ingest_new(spark, source, target, log):
        query.awaitTermination()
    for kind in ("comments", "submissions"):
        want = spark.read.parquet(f"{tmp_path}/batch/{kind}")
        assert rows_of(spark.read.parquet(f"{target}/{kind}").select(*want.columns)) == rows_of(want)


def parts_of(rng):
    """Three files of posts over five days, the last one with a post that is nine days late."""
    parts = [
        [(f"{p}-{k}", rng.choice("xy"), "a", "comment", 10 * DAY + 2 * DAY * p + rng.randrange(3 * DAY), rng.choice([None, 3])) for k in range(80)]
        for p in range(3)
    ]
    parts[2].append(("late", "x", "a", "comment", DAY, 100))
    return parts


def counted(spark, rows):
    return streams.count_hours(spark.createDataFrame(rows, COLUMNS).withColumn("ts", F.timestamp_seconds("created_utc")))


def test_hourly_counts_equal_batch_whatever_comes_late(spark, tmp_path):
    path, out, log = (str(tmp_path / n) for n in ("posts", "out", "log"))
    parts = parts_of(random.Random(2))
    want = rows_of(counted(spark, [r for rows in parts for r in rows]))
    for rows in [*parts, None]:
        if rows:
            add(spark, rows, path)
        else:
            forget_commit(log)
        streams.write_hourly_counts(streams.read_new(spark, path, spark.read.parquet(path).schema), out, log).awaitTermination()
    assert rows_of(streams.read_hourly_counts(spark, out)) == want


def test_closed_hours_come_once_and_without_what_is_too_late(spark, tmp_path):
    path, out, log = (str(tmp_path / n) for n in ("posts", "out", "log"))
    parts = parts_of(random.Random(2))
    for rows in parts:
        add(spark, rows, path)
        time.sleep(1.1)
    schema = spark.read.parquet(path).schema
    hours = streams.closed_hours(streams.read_new(spark, path, schema, files_per_batch=1), "4 days")
    streams.write_batches(hours, out, log).awaitTermination()
    on_time = [r for rows in parts for r in rows if r[0] != "late"]
    closed = max(r[4] for r in on_time) - 4 * DAY
    want = counted(spark, on_time).where(F.unix_seconds("hour") + 3600 <= closed)
    got = spark.read.parquet(out).drop("batch")
    assert rows_of(got) == rows_of(want) and 0 < want.count() < counted(spark, on_time).count()


def test_sessions_close_when_nothing_can_add_to_them(spark, tmp_path):
    path, out, log = (str(tmp_path / n) for n in ("posts", "out", "log"))
    first = [("1", "x", "a", "c", 1000, 1), ("2", "y", "a", "c", 2000, 1), ("3", "x", "b", "c", 1500, 1)]
    # The second file goes on with a's session, and is late enough for others to close.
    second = [("4", "x", "a", "c", 3700, 1), ("5", "x", "b", "c", 9000, 1), ("6", "x", "c", "c", 10 * DAY, 1)]
    for rows in (first, second):
        add(spark, rows, path)
        sessions = streams.author_sessions(streams.read_new(spark, path, spark.read.parquet(path).schema))
        streams.write_batches(sessions, out, log).awaitTermination()
    batch = streams.author_sessions(spark.read.parquet(path))
    got = spark.read.parquet(out).drop("batch")
    assert rows_of(got) == rows_of(batch.where("author <> 'c'"))
    assert {(r.author, r.num_posts) for r in got.collect()} == {("a", 3), ("b", 1)}


def test_ids_are_taken_once(spark, tmp_path):
    path, out, log = (str(tmp_path / n) for n in ("posts", "out", "log"))
    for part in range(2):
        add(spark, [(f"i{k}", "x", "a", "c", 1000 + k, 1) for k in range(20 * part, 30 + 20 * part)], path)
        fresh = streams.new_posts(streams.read_new(spark, path, spark.read.parquet(path).schema))
        streams.write_batches(fresh, out, log).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 50 and got.select("id").distinct().count() == 50
    assert got.where(F.col("batch") == 0).count() == 30


def test_stream_job_takes_in_what_is_new(spark, tmp_path):
    rng = random.Random(4)
    source, target, log = (str(tmp_path / n) for n in ("raw", "streamed", "log"))
    for part in range(2):
        for kind, rows in zip(("comments", "submissions"), raw(rng, 40, 100 * part)):
            add(spark, rows, f"{source}/{kind}", schemas.RAW_COMMENTS if kind == "comments" else schemas.SUBMISSIONS)
        stream.run(spark, source, target, log)
    for kind in ("comments", "submissions"):
        posts = spark.read.parquet(f"{target}/{kind}")
        hours = streams.read_hourly_counts(spark, f"{target}/hourly_{kind}")
        assert posts.count() == hours.agg(F.sum("num_posts")).first()[0] > 30
        assert [r.data_type for r in hours.select("data_type").distinct().collect()] == [kind.removesuffix("s")]
