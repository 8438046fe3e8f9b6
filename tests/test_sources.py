"""Readers, writers and the ingest job."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from forumlens import schemas, session
from forumlens.session import path_bytes
from forumlens.operators import quality
from forumlens.sources import ingest, readers, sample_tables, writers

COMMENT = ("1", "OpenAI", "u", "text", 5, 1704067200, "t3_a", "t3_a", 0, 0)


def raw_tables(spark, folder):
    comments = spark.createDataFrame(
        [COMMENT, ("2", "elsewhere", *COMMENT[2:])], schemas.COMMENTS
    ).withColumn("extra", F.lit(1))
    submissions = spark.createDataFrame(
        [("3", "OpenAI", "u", "title", None, 5, 1706745600, 3, None, False)], schemas.SUBMISSIONS
    )
    comments.write.parquet(f"{folder}/comments")
    submissions.write.parquet(f"{folder}/submissions")


def test_ingest_round_trip(spark, tmp_path):
    raw_tables(spark, f"{tmp_path}/raw")
    written = ingest.ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/out", partition_by_month=True)
    assert written == {"comments": 1, "submissions": 1}
    comments = readers.read_parquet(spark, f"{tmp_path}/out/comments")
    assert "extra" not in comments.columns and comments.first()["year_month"] == "2024-01"
    plan = comments.where("year_month = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    both = readers.unify(comments, readers.read_parquet(spark, f"{tmp_path}/out/submissions"))
    assert both.where("data_type = 'submission'").first()["body"] is None
    summary = quality.with_size(quality.dataset_summary(both), {k: f"{tmp_path}/out/{k}s" for k in ("comment", "submission")})
    assert {r["data_type"]: r["size_gb"] for r in summary.collect()} == {"comment": 0.0, "submission": 0.0}
    assert path_bytes(spark, f"{tmp_path}/out/comments") >= sum(f.stat().st_size for f in (tmp_path / "out/comments").rglob("*.parquet")) > 0


def test_partitioned_scan_needs_no_loop(spark, tmp_path):
    for month in ("06", "07"):
        spark.createDataFrame([COMMENT], schemas.COMMENTS).write.parquet(f"{tmp_path}/c/yyyy=2023/mm={month}")
    df = readers.read_parquet(spark, f"{tmp_path}/c")
    assert {(r["yyyy"], r["mm"]) for r in df.collect()} == {(2023, 6), (2023, 7)}
    assert df.where("mm = 6").count() == 1


def test_read_first(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    assert readers.read_first(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).count() == 3
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        readers.read_first(spark, [f"{tmp_path}/a"])
    with pytest.raises(ValueError):
        readers.read_files(spark, [])


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("; comment\n  Good \n\ngood\nBAD\n")
    words = readers.read_word_list(spark, str(tmp_path / "w.txt"))
    assert readers.word_list_values(words) == ["bad", "good"]
    with pytest.raises(ValueError, match="exceeds"):
        readers.word_list_values(words, limit=1)


def test_survey(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c\n,,\nTitle,x,\n,,\n,Benefit,Percent\n,Faster coding,55.5\n,\"a, b\",10\n,Note,n/a\n")
    rows = readers.read_survey(spark, str(tmp_path / "s.csv")).collect()
    assert [tuple(r) for r in rows] == [("Faster coding", 55.5), ("a, b", 10.0)]


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1, Vectors.dense([0.5, 1.0])), ("b", 2, Vectors.dense([1.0, 0.0]))], ["s", "n", "v"]
    )
    writers.write_csv(df, f"{tmp_path}/p", ["s"])
    back = readers.read_csv(spark, f"{tmp_path}/p", "n int, v string, s string")
    assert {(r["s"], r["n"], r["v"]) for r in back.collect()} == {("a", 1, "[0.5,1.0]"), ("b", 2, "[1.0,0.0]")}
    writers.write_single_csv(df, f"{tmp_path}/one")
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    writers.write_single_parquet(df, f"{tmp_path}/onep")
    assert len(list((tmp_path / "onep").glob("part-*.parquet"))) == 1
    with pytest.raises(ValueError, match="exceeds"):
        writers.write_single_parquet(df, f"{tmp_path}/refused", max_rows=1)
    assert not (tmp_path / "refused").exists()


def test_profile_and_guard(spark):
    df = spark.createDataFrame([("1", None), ("2", 3)], "id string, score bigint")
    rows = {r["column_name"]: r for r in readers.profile_table(df).collect()}
    assert rows["score"]["non_null"] == 1 and rows["id"]["n_rows"] == 2 and rows["id"]["interesting"]
    assert schemas.require(df, ["id"]) is df
    with pytest.raises(ValueError, match="body"):
        schemas.require(df, ["id", "body"])


def test_sampling_is_reproducible(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    first = {r["id"] for r in readers.sample_posts(df, 0.1).collect()}
    again = {r["id"] for r in readers.sample_posts(df.repartition(13), 0.1).collect()}
    assert first == again and 1800 < len(first) < 2200
    assert readers.cap_documents(df, 50).count() == 50


def test_checkpoint_folder_comes_from_the_session(spark, monkeypatch):
    folder = session.checkpoint_dir(spark)
    assert folder and session.checkpoint_dir(spark) == folder
    df = spark.range(10)
    assert session.stage(df).count() == 10


def test_metric_rows_and_export(spark):
    assert writers.metric_rows(spark, [("auc", 0.5)]).first()["value"] == 0.5
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    assert [r["id"] for r in writers.first_rows(df, 2).collect()] == ["a", "b"]


def post_tables(spark, folder):
    """Small tables that posts are derived from, with more events than texts."""
    kinds = ["view", "signup", "purchase", "click"]
    events = [(i, 1_700_000_000 + 60 * i, i % 5, kinds[i % 4], float(i % 9), '{"k": 3}') for i in range(60)]
    spark.createDataFrame(events, "event_id long, t long, user_id long, event_type string, value double, props string").selectExpr(
        "event_id", "timestamp_seconds(t) AS ts", "user_id", "event_type", "value", "props"
    ).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(i, f"text {i}") for i in range(7)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    pages = [(i, f"http://h.org/{i}", f"<title>head {i}</title>") for i in range(5)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def test_texts_join_posts_last(spark, tmp_path):
    post_tables(spark, str(tmp_path))
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    try:
        posts = sample_tables.posts(spark, str(tmp_path))
        plan = posts._jdf.queryExecution().executedPlan().toString()
        rows = {r["event_id"]: r for r in posts.collect()}
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
    joins = [line for line in plan.splitlines() if "Join [" in line]
    # The topmost join brings the texts, so that no exchange above it moves them once per post.
    assert len(joins) == 2 and "doc_id" in joins[0] and "Exchange" not in plan[: plan.index(joins[0])]
    assert len(rows) == 60 and rows[10]["body"] is None and rows[8]["body"].startswith("text 1") and "head 2" in rows[2]["title"]


def test_posts_leave_the_splits_of_a_small_file_before_they_meet_their_texts(spark, tmp_path):
    events = spark.range(0, 400, 1, 1).selectExpr(
        "id AS event_id", "timestamp'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "10.0D AS value", "'{}' AS props"
    )
    documents = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "'text ' || id AS text")
    pages = spark.range(0, 5, 1, 1).selectExpr("id AS page_id", "'u' AS url", "'<title>t</title>' AS html")
    for name, df in (("events", events), ("documents", documents), ("pages", pages)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    comments = sample_tables.comments(spark, str(tmp_path))
    parts = comments.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in parts) == 400 and len(parts) > 4
    bodies = {r["event_id"]: r["body"] for r in comments.select("event_id", "body").collect()}
    assert len(bodies) == 400 and all(b.startswith(f"text {i % 40}") for i, b in bodies.items() if i % 17)
