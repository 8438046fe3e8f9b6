"""Queries that write a table with a sink and read it back, so that both sides are compared with SQL."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.ml import features
from forumlens.operators import activity, quality
from forumlens.plans.registry import query
from forumlens.session import checkpoint_dir
from forumlens.sources import readers, sample_tables as st, writers

COLUMNS = ["event_id", "data_type", "id", "subreddit", "author", "score", "created_utc", "controversiality", "over_18"]
POST_SQL = f"WITH {{meta}} SELECT {', '.join(COLUMNS)} FROM meta"
SCHEMA = (
    "event_id long, data_type string, id string, subreddit string, author string, score long, created_utc long, "
    "controversiality long, over_18 boolean"
)


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return st.posts_meta(spark, sf).select(*COLUMNS)


@query("sink_parquet", POST_SQL)
def sink_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Written twice: the second run replaces the first."""
    path, posts = _folder(spark), _posts(spark, sf)
    writers.write_parquet(posts.where("score > 50"), path)
    writers.write_parquet(posts, path)
    return readers.read_parquet(spark, path).select(*COLUMNS)


@query("sink_parquet_months", POST_SQL.replace("FROM meta", ", year(ts) AS yyyy, month(ts) AS mm FROM meta WHERE month(ts) IN (1, 6)"))
def sink_parquet_months(spark: SparkSession, sf: str) -> DataFrame:
    """Year and month folders, found when the table is read; the filter reads two months' folders only."""
    path, ts = _folder(spark), F.timestamp_seconds("created_utc")
    posts = _posts(spark, sf).withColumns({"yyyy": F.year(ts), "mm": F.month(ts)})
    writers.write_parquet(posts, path, ["yyyy", "mm"])
    return readers.read_parquet(spark, path).where(F.col("mm").isin(1, 6)).select(*COLUMNS, "yyyy", "mm")


@query("source_first_readable", POST_SQL)
def source_first_readable(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    writers.write_parquet(_posts(spark, sf), path)
    return readers.read_first(spark, [f"{path}-not-there", path, f"{path}-nor-there"]).select(*COLUMNS)


@query("sink_csv", POST_SQL)
def sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    writers.write_csv(_posts(spark, sf), path)
    return readers.read_csv(spark, path, SCHEMA)


@query("sink_csv_by_community", POST_SQL)
def sink_csv_by_community(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    writers.write_csv(_posts(spark, sf), path, ["subreddit"])
    in_files = SCHEMA.replace("subreddit string, ", "") + ", subreddit string"
    return readers.read_csv(spark, path, in_files).select(*COLUMNS)


MONTHS_SQL = """WITH {meta}
    SELECT strftime(ts, '%Y-%m') AS year_month, count(*) FILTER (data_type = 'comment') AS num_comments,
      count(*) FILTER (data_type = 'submission') AS num_submissions, count(*) AS total_rows FROM meta GROUP BY ALL"""


@query("sink_single_csv", MONTHS_SQL)
def sink_single_csv(spark: SparkSession, sf: str) -> DataFrame:
    path, months = _folder(spark), activity.monthly_activity(st.posts_meta(spark, sf))
    writers.write_single_csv(months, path)
    return readers.read_csv(spark, path, months.schema)


@query("sink_single_parquet", MONTHS_SQL)
def sink_single_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark)
    writers.write_single_parquet(activity.monthly_activity(st.posts_meta(spark, sf)), path)
    return readers.read_parquet(spark, path)


@query("dataset_summary_sized")
def dataset_summary_sized(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, time range and stored size of each kind, from the folders they are ingested to."""
    path, posts = _folder(spark), _posts(spark, sf)
    folders = {kind: f"{path}/{kind}" for kind in ("comment", "submission")}
    for kind, folder in folders.items():
        writers.write_parquet(posts.where(F.col("data_type") == kind), folder)
    stored = readers.stack(*[readers.read_parquet(spark, folder) for folder in folders.values()])
    return quality.with_size(quality.dataset_summary(stored), folders)


# --- the arithmetic of fitted stages: counts and weights from a stored pipeline --------------------

@query(
    "tfidf_from_stored_pipeline",
    """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS term FROM documents),
    d AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term <> '' GROUP BY ALL),
    f AS (SELECT term, count(*) AS df FROM d GROUP BY term HAVING count(*) >= 20),
    n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS term_count, round(sum(tf * ln((n + 1) / (df + 1))), 6) AS weight_sum,
      round(max(tf * ln((n + 1) / (df + 1))), 6) AS weight_max
    FROM d JOIN f USING (term), n GROUP BY doc_id""",
)
def tfidf_from_stored_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and IDF weights of a pipeline that was fitted, saved and loaded; all terms of twenty documents or more."""
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda w: w != "")
    docs = st.table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", words.alias("words_clean"))
    path = _folder(spark)
    writers.save_model(features.fit(features.tfidf_stages(vocab_size=1 << 20, min_df=20), docs), path)
    found = PipelineModel.load(path).transform(docs)
    # The non-zero entries only: a vector is as long as the vocabulary.
    counts, weights = (F.unwrap_udt(c)["values"] for c in ("tf_features", "tfidf_features"))
    sums = found.select("doc_id", counts.alias("c"), weights.alias("w")).where(F.size("c") > 0)

    def total(column: str):
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    return sums.select(
        "doc_id", F.size("c").alias("n_terms"), total("c").cast("long").alias("term_count"), total("w").alias("weight_sum"), F.array_max("w").alias("weight_max")
    )
