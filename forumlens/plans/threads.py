"""Queries over reply forests, over what authors did before a post, and over the speed of keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import post_text
from forumlens.operators import history, threads, velocity
from forumlens.plans.registry import query
from forumlens.sources import sample_tables as st

# The forest from the roots down, one level a step; circles are never reached.
FOREST_SQL = """RECURSIVE {threads}, tops AS (
      SELECT name, parent_name IS NOT NULL AS broken FROM threads t
      WHERE NOT EXISTS (SELECT 1 FROM threads p WHERE p.name = t.parent_name)
    ), walk AS (
      SELECT name, name AS root, 0 AS depth, [name] AS path FROM tops
      UNION ALL SELECT t.name, w.root, w.depth + 1, list_append(w.path, t.name) FROM walk w JOIN threads t ON t.parent_name = w.name
    ), below AS (
      SELECT above AS name, count(*) - 1 AS n_below FROM (SELECT unnest(path) AS above FROM walk) GROUP BY above
    ), forest AS (
      SELECT t.name, w.root, w.depth, b.n_below,
        CASE WHEN w.root IS NULL THEN 'loop' WHEN o.broken THEN 'orphan' ELSE 'thread' END AS status
      FROM threads t LEFT JOIN walk w USING (name) LEFT JOIN below b USING (name) LEFT JOIN tops o ON o.name = w.root
    )"""


def _forest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    posts = st.thread_posts(spark, sf)
    return posts, threads.reply_forest(posts)


@query("reply_forest", f"WITH {FOREST_SQL} SELECT name, root, depth, n_below, status FROM forest")
def reply_forest(spark: SparkSession, sf: str) -> DataFrame:
    return _forest(spark, sf)[1]


TABLE_SQL = f"""{FOREST_SQL}, table_ AS (
      SELECT s.name AS root, s.subreddit, s.score, length(s.title) AS title_length, hour(make_timestamp(s.created_utc * 1000000)) AS hour,
        count(c.name) AS n_comments, count(c.name) FILTER (f.depth = 1) AS n_direct, count(DISTINCT c.author) AS n_authors,
        coalesce(max(f.depth), 0) AS max_depth, avg(f.depth) AS mean_depth, avg(c.score) AS mean_comment_score,
        min(c.created_utc) - s.created_utc AS seconds_to_first, max(c.created_utc) - min(c.created_utc) AS seconds_active
      FROM threads s JOIN forest x ON x.name = s.name AND x.depth = 0 AND x.status = 'thread'
      LEFT JOIN forest f ON f.root = s.name AND f.depth > 0 LEFT JOIN threads c ON c.name = f.name
      GROUP BY s.name, s.subreddit, s.score, s.title, s.created_utc
    )"""


@query(
    "thread_table",
    f"""WITH {TABLE_SQL} SELECT * REPLACE (round(mean_depth, 6) AS mean_depth, round(mean_comment_score, 6) AS mean_comment_score)
    FROM table_""",
)
def thread_table(spark: SparkSession, sf: str) -> DataFrame:
    return threads.thread_table(*_forest(spark, sf))


def _correlation_sql() -> str:
    pairs = [(x, y) for x in threads.FEATURES for y in threads.MEASURES]
    both = "FILTER ({0} IS NOT NULL AND {1} IS NOT NULL)"
    return " UNION ALL ".join(
        f"""SELECT '{x}' AS feature, '{y}' AS measure, count(*) {both.format(x, y)} AS n_threads,
        round(corr({x}, {y}), 6) AS correlation FROM table_"""
        for x, y in pairs
    )


@query("thread_correlations", f"WITH {TABLE_SQL} {_correlation_sql()}")
def thread_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return threads.thread_correlations(threads.thread_table(*_forest(spark, sf)))


@query(
    "thread_depth_profile",
    f"""WITH {FOREST_SQL} SELECT depth, count(*) AS n_posts, round(avg(score), 6) AS avg_score, round(avg(n_below), 6) AS avg_below
    FROM forest JOIN threads USING (name) WHERE status = 'thread' GROUP BY depth""",
)
def thread_depth_profile(spark: SparkSession, sf: str) -> DataFrame:
    posts, forest = _forest(spark, sf)
    return threads.depth_profile(forest, posts)


# --- author history ------------------------------------------------------------------------------

HISTORY_SQL = """h AS (
      SELECT event_id, author, score, count(*) OVER w AS n_before, avg(score) OVER w AS avg_before, stddev_samp(score) OVER w AS sd_before,
        created_utc - max(created_utc) OVER w AS seconds_since_last
      FROM meta WINDOW w AS (PARTITION BY author ORDER BY created_utc RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )"""


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return history.author_history(st.posts_meta(spark, sf).select("event_id", "author", "created_utc", "score"))


@query(
    "author_history",
    f"""WITH {{meta}}, {HISTORY_SQL} SELECT event_id, author, n_before, round(avg_before, 6) AS avg_before, round(sd_before, 6) AS sd_before,
    seconds_since_last FROM h""",
)
def author_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).drop("created_utc", "score")


# The same for one name that holds a third of the rows.
@query(
    "author_history_hot",
    f"""WITH {{meta}}, {HISTORY_SQL.replace("FROM meta", "FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE author END AS author) FROM meta)")}
    SELECT event_id, author, n_before, round(avg_before, 6) AS avg_before, round(sd_before, 6) AS sd_before, seconds_since_last FROM h""",
)
def author_history_hot(spark: SparkSession, sf: str) -> DataFrame:
    posts = st.posts_meta(spark, sf).select("event_id", "author", "created_utc", "score")
    hot = posts.withColumn("author", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("author")))
    return history.author_history(hot).drop("created_utc", "score")


@query(
    "author_history_effect",
    f"""WITH {{meta}}, {HISTORY_SQL}
    SELECT CASE WHEN n_before > 0 THEN CAST(floor(log2(n_before + 0.5)) AS BIGINT) ELSE -1 END AS log2_before, count(*) AS n_posts,
      round(avg(score), 6) AS avg_score, round(avg(avg_before), 6) AS avg_before, round(corr(avg_before, score), 6) AS correlation
    FROM h GROUP BY 1""",
)
def author_history_effect(spark: SparkSession, sf: str) -> DataFrame:
    return history.history_effect(_history(spark, sf))


# --- keyword velocity ----------------------------------------------------------------------------

KEYWORDS = {
    "chatgpt": ["chatgpt", "gpt"], "midjourney": ["midjourney"], "tutorial": ["tutorial", "tutorials", "learn"],
    "risk": ["risk", "scared"], "coding": ["coding", "docs"], "never said": ["zyzzyva"],
}

_GROUPS_SQL = "VALUES " + ", ".join(f"('{w}', '{k}')" for k, words in KEYWORDS.items() for w in words)
VELOCITY_SQL = f"""{{posts}}, tokens AS (
      SELECT event_id, date AS day, unnest(regexp_split_to_array(lower(CASE WHEN data_type = 'comment' THEN body
        ELSE concat_ws(' ', coalesce(title, ''), coalesce(selftext, '')) END), '[^a-z]+')) AS word FROM posts
    ), groups(word, keyword) AS ({_GROUPS_SQL}),
    counts AS (SELECT day, keyword, count(DISTINCT event_id) AS n_posts, count(*) AS n_uses FROM tokens JOIN groups USING (word) GROUP BY ALL),
    days AS (SELECT unnest(generate_series((SELECT min(date) FROM posts), (SELECT max(date) FROM posts), INTERVAL 1 DAY))::DATE AS day),
    filled AS (
      SELECT day, keyword, coalesce(n_posts, 0) AS n_posts, coalesce(n_uses, 0) AS n_uses
      FROM (SELECT day, keyword FROM days, (SELECT DISTINCT keyword FROM groups)) LEFT JOIN counts USING (day, keyword)
    ), sums AS (
      SELECT keyword, day, CAST(sum(n_posts) OVER w AS BIGINT) AS in_window, row_number() OVER (PARTITION BY keyword ORDER BY day) AS k FROM filled
      WINDOW w AS (PARTITION BY keyword ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
    ), changes AS (
      SELECT a.*, CASE WHEN a.k >= 14 THEN a.in_window - b.in_window END AS velocity FROM sums a LEFT JOIN sums b ON b.keyword = a.keyword AND b.day = a.day - 7
    ), v AS (
      SELECT keyword, day, in_window, velocity, CASE WHEN count(velocity) OVER w >= 14 AND stddev_samp(velocity) OVER w > 0
        THEN (velocity - avg(velocity) OVER w) / stddev_samp(velocity) OVER w END AS z_score
      FROM changes WINDOW w AS (PARTITION BY keyword ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    )"""


def _velocity(spark: SparkSession, sf: str) -> DataFrame:
    counts = velocity.keyword_counts(st.posts(spark, sf), F.split(F.lower(post_text()), "[^a-z]+"), KEYWORDS)
    days = st.posts_meta(spark, sf).select(F.col("date").alias("day"))
    return velocity.velocity(velocity.fill_days(counts, list(KEYWORDS), days))


@query("keyword_velocity", f"WITH {VELOCITY_SQL} SELECT * REPLACE (round(z_score, 6) AS z_score) FROM v")
def keyword_velocity(spark: SparkSession, sf: str) -> DataFrame:
    return _velocity(spark, sf)


@query(
    "keyword_alerts",
    f"""WITH {VELOCITY_SQL}, a AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY keyword ORDER BY day) AS INTEGER) AS run FROM v WHERE z_score >= 2)
    SELECT keyword, min(day) AS first_day, max(day) AS last_day, count(*) AS n_days, round(max(z_score), 6) AS peak_z,
      arg_max(in_window, (round(z_score, 9), -date_diff('day', DATE '1970-01-01', day))) AS peak_window
    FROM a GROUP BY keyword, run""",
)
def keyword_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return velocity.alerts(_velocity(spark, sf), threshold=2.0)
