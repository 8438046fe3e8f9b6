"""Forum posts derived from the generic `events`, `documents` and `pages` tables.

Every event becomes one post. Text comes whole from the document `event_id mod count(documents)`, and
titles and URLs whole from the page `event_id mod count(pages)`; the count is a scalar subquery, and
both joins are plain equalities. The same definition is kept as SQL beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Communities by `event_id mod 31`, the first one taking 17 of 31 shares.
COMMUNITIES = [
    "neoliberal", "ChatGPT", "singularity", "Futurology", "StableDiffusion", "LocalLLaMA", "OpenAI",
    "programming", "datascience", "MachineLearning", "ClaudeAI", "computerscience", "GPT4", "PerplexityAI",
]
# Phrases by `event_id mod 12`, the rest empty.
PHRASES = [
    "happy and excited about it",
    "this is bad, wrong and terrible",
    "scared of the risk",
    "angry rant, I hate it",
    "so sad today",
    "wow that was unexpected",
    "faster coding and better docs",
    "ChatGPT and Midjourney compared",
    "learn with a tutorial",
]
MONTH_SECONDS = 2592000
# Threads: a comment answers one of the three events before it. Some parents are missing, and some comments answer the
# event after them, which makes a few circles.
ANSWER = """CASE WHEN event_id % 1009 = 5 THEN event_id + 1 WHEN event_id % 10 = 1 THEN event_id - 1
  ELSE event_id - 1 - event_id % 3 END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_case(key: str, values: dict[int, str], default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items())
    return f"CASE {key} {whens} ELSE '{default}' END"


# One community has comments only.
IS_SUBMISSION = "(event_type IN ('signup', 'purchase') AND event_id % 31 <> 30)"
# A third of the users post under a name per community, a third under a name per three neighbouring ones, and a
# third under two names, so that no author spans all communities and some pairs share nobody.
ALIAS = "CASE user_id % 3 WHEN 0 THEN event_id % 31 WHEN 1 THEN 100 + (event_id % 31) DIV 3 ELSE 200 + (event_id % 31) DIV 24 END"
ALIAS_SQL = ALIAS.replace(" DIV ", " // ")
# Ids repeat between neighbouring events, which differ in community, and between events of one community.
SAME_ID = "CASE WHEN event_id % 101 = 1 THEN event_id - 1 WHEN event_id % 103 = 50 THEN event_id - 31 ELSE event_id END"
COMMUNITY = _sql_case("event_id % 31", {17 + i: n for i, n in enumerate(COMMUNITIES)}, "AskReddit")
PHRASE = _sql_case("event_id % 12", {i: f" {p}" for i, p in enumerate(PHRASES)}, "")
TITLE_START = "CASE event_id % 5 WHEN 0 THEN 'How ' WHEN 1 THEN 'Why ' ELSE '' END"
TITLE_END = "CASE WHEN event_id % 3 = 0 THEN '?' WHEN event_id % 7 = 0 THEN '!' ELSE '' END"
TITLE = f"{TITLE_START} || repeat(head || ' ', CAST(1 + event_id % 6 AS INT)) || {TITLE_END}"
NAME = "CASE WHEN data_type = 'submission' THEN 't3_p' ELSE 't1_p' END || event_id"
PARENT = """CASE WHEN data_type = 'comment' THEN CASE WHEN event_id % 211 = 7 OR to_submission IS NULL THEN 't1_gone'
  WHEN to_submission THEN 't3_p' || answered ELSE 't1_p' || answered END END"""
BODY = f"""CASE WHEN event_id % 17 = 0 THEN '[removed]' ELSE text || {PHRASE}
  || CASE WHEN event_id % 6 = 0 THEN ' https://ex.org/a?b=1' ELSE '' END
  || CASE WHEN event_id % 8 = 0 THEN ' [label](http://l.org)' ELSE '' END
  || CASE WHEN event_id % 9 = 0 THEN ' u/some_one' ELSE '' END
  || CASE WHEN event_id % 10 = 0 THEN ' r/some_sub' ELSE '' END END"""


def posts_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post columns that need no text: no join, and only the event columns used are read."""
    return meta_of(table(spark, sf_dir, "events"))


def meta_of(events: DataFrame) -> DataFrame:
    """Events, a table or a stream of them, as posts without text."""
    return events.selectExpr(
        "event_id",
        f"CASE WHEN {IS_SUBMISSION} THEN 'submission' ELSE 'comment' END AS data_type",
        f"'p' || {SAME_ID} AS id",
        f"{COMMUNITY} AS subreddit",
        f"CASE WHEN event_id % 29 = 0 THEN '[deleted]' ELSE 'user_' || user_id || '_' || {ALIAS} END AS author",
        f"unix_seconds(CAST(ts AS TIMESTAMP)) + {MONTH_SECONDS} * (event_id % 14 - 7) AS created_utc",
        "CAST(floor(value) - 5 AS BIGINT) AS score",
        f"CASE WHEN NOT {IS_SUBMISSION} THEN 't3_p' || (event_id - event_id % 10) END AS link_id",
        f"CASE WHEN NOT {IS_SUBMISSION} THEN 't3_p' || (event_id - event_id % 10) END AS parent_id",
        f"CASE WHEN NOT {IS_SUBMISSION} THEN CAST(event_id % 11 = 0 AS BIGINT) END AS controversiality",
        f"CASE WHEN NOT {IS_SUBMISSION} THEN CAST(event_id % 97 = 0 AS BIGINT) END AS gilded",
        f"CASE WHEN {IS_SUBMISSION} THEN CAST(get_json_object(props, '$.k') AS BIGINT) END AS num_comments",
        f"CASE WHEN {IS_SUBMISSION} THEN event_id % 19 = 0 END AS over_18",
    ).selectExpr("*", "to_date(timestamp_seconds(created_utc)) AS date")


def thread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts under unique full names with nested replies, and the submissions' titles; no document texts."""
    meta = posts_meta(spark, sf_dir)
    kinds = table(spark, sf_dir, "events").selectExpr("event_id AS answered", f"{IS_SUBMISSION} AS to_submission")
    pages = table(spark, sf_dir, "pages").selectExpr("page_id", "regexp_extract(html, '<title>([^<]*)</title>', 1) AS head")
    n_pages = pages.agg(F.count(F.lit(1))).scalar()
    numbered = meta.select("*", F.expr(ANSWER).alias("answered"), (F.col("event_id") % n_pages).alias("page_id"))
    return (
        numbered.join(kinds, "answered", "left")
        .join(pages, "page_id", "left")
        .selectExpr(
            "event_id", f"{NAME} AS name", f"{PARENT} AS parent_name", "data_type", "subreddit", "author", "score", "created_utc",
            f"CASE WHEN data_type = 'submission' THEN {TITLE} END AS title",
        )
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the unified posts."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url AS page_url", "regexp_extract(html, '<title>([^<]*)</title>', 1) AS head"
    )
    n_documents = documents.agg(F.count(F.lit(1))).scalar()
    n_pages = pages.agg(F.count(F.lit(1))).scalar()
    # Each text returns once per event, so the join makes far more bytes than its inputs hold. Spreading
    # both sides on the join key first keeps that work, and all that is done with the texts later, off the few
    # splits of a small file, also when the documents are broadcast; a join that shuffles anyway reuses this partitioning.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    documents = documents.repartition(tasks, "doc_id")
    return (
        posts_meta(spark, sf_dir)
        .select("*", (F.col("event_id") % n_documents).alias("doc_id"), (F.col("event_id") % n_pages).alias("page_id"))
        # Titles first: whole texts meet a post last, so no shuffle carries them once per post.
        .join(pages, "page_id")
        .repartition(tasks, "doc_id")
        .join(documents, "doc_id")
        .selectExpr(
            "event_id", "data_type", "id", "subreddit", "author", "created_utc", "score",
            f"CASE WHEN data_type = 'comment' THEN {BODY} END AS body",
            "link_id", "parent_id", "controversiality", "gilded",
            f"""CASE WHEN data_type = 'submission' THEN {TITLE_START}
              || repeat(head || ' ', CAST(1 + event_id % 6 AS INT)) || {TITLE_END} END AS title""",
            f"""CASE WHEN data_type = 'submission' AND event_id % 4 <> 0 THEN
              CASE WHEN event_id % 13 = 0 THEN '[removed]' ELSE text || {PHRASE} END END AS selftext""",
            "num_comments",
            "CASE WHEN data_type = 'submission' AND event_id % 2 = 0 THEN page_url END AS url",
            "over_18", "date",
        )
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment table with its own columns only."""
    return posts(spark, sf_dir).where("data_type = 'comment'").select(
        "event_id", "id", "subreddit", "author", "body", "score", "created_utc", "parent_id", "link_id",
        "controversiality", "gilded",
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission table with its own columns only."""
    return posts(spark, sf_dir).where("data_type = 'submission'").select(
        "event_id", "id", "subreddit", "author", "title", "selftext", "score", "created_utc", "num_comments",
        "url", "over_18",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip columns taken from `lineitem`."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
    )


META_SQL = f"""
meta AS (
  SELECT e.*, CAST(make_timestamp(created_utc * 1000000) AS DATE) AS date, make_timestamp(created_utc * 1000000) AS ts
  FROM (
    SELECT event_id,
      CASE WHEN {IS_SUBMISSION} THEN 'submission' ELSE 'comment' END AS data_type,
      'p' || CAST({SAME_ID} AS VARCHAR) AS id,
      {COMMUNITY} AS subreddit,
      CASE WHEN event_id % 29 = 0 THEN '[deleted]' ELSE 'user_' || CAST(user_id AS VARCHAR) || '_' || CAST({ALIAS_SQL} AS VARCHAR) END AS author,
      CAST(floor(epoch(ts)) AS BIGINT) + {MONTH_SECONDS} * (event_id % 14 - 7) AS created_utc,
      CAST(floor(value) AS BIGINT) - 5 AS score,
      CASE WHEN NOT {IS_SUBMISSION} THEN 't3_p' || CAST(event_id - event_id % 10 AS VARCHAR) END AS link_id,
      CASE WHEN NOT {IS_SUBMISSION} THEN 't3_p' || CAST(event_id - event_id % 10 AS VARCHAR) END AS parent_id,
      CASE WHEN NOT {IS_SUBMISSION} THEN CAST(event_id % 11 = 0 AS BIGINT) END AS controversiality,
      CASE WHEN NOT {IS_SUBMISSION} THEN CAST(event_id % 97 = 0 AS BIGINT) END AS gilded,
      CASE WHEN {IS_SUBMISSION} THEN CAST(props->>'$.k' AS BIGINT) END AS num_comments,
      CASE WHEN {IS_SUBMISSION} THEN event_id % 19 = 0 END AS over_18
    FROM events
  ) e
)"""

POSTS_SQL = f"""{META_SQL},
posts AS (
  SELECT m.*,
    CASE WHEN data_type = 'comment' THEN {BODY} END AS body,
    CASE WHEN data_type = 'submission' THEN {TITLE_START}
      || repeat(regexp_extract(p.html, '<title>([^<]*)</title>', 1) || ' ', 1 + event_id % 6) || {TITLE_END} END AS title,
    CASE WHEN data_type = 'submission' AND event_id % 4 <> 0 THEN
      CASE WHEN event_id % 13 = 0 THEN '[removed]' ELSE text || {PHRASE} END END AS selftext,
    CASE WHEN data_type = 'submission' AND event_id % 2 = 0 THEN p.url END AS url
  FROM meta m
  JOIN documents d ON d.doc_id = m.event_id % (SELECT count(*) FROM documents)
  JOIN pages p ON p.page_id = m.event_id % (SELECT count(*) FROM pages)
)"""

THREADS_SQL = f"""{META_SQL},
threads AS (
  SELECT m.event_id, {NAME} AS name, {PARENT} AS parent_name, data_type, subreddit, author, score, created_utc,
    CASE WHEN data_type = 'submission' THEN {TITLE.replace('head', "regexp_extract(p.html, '<title>([^<]*)</title>', 1)")} END AS title
  FROM (SELECT *, {ANSWER} AS answered FROM meta) m
  LEFT JOIN (SELECT event_id AS answered, {IS_SUBMISSION} AS to_submission FROM events) k USING (answered)
  LEFT JOIN pages p ON p.page_id = m.event_id % (SELECT count(*) FROM pages)
)"""
