"""Queries over signs of automated accounts, the life of submissions and stored distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.text import post_text
from forumlens.operators import accounts, lifecycle, sketches, threads
from forumlens.plans.registry import query
from forumlens.plans.tables import POST_TEXT_SQL
from forumlens.plans.threads import FOREST_SQL
from forumlens.session import stage
from forumlens.sources import sample_tables as st

# --- automated accounts --------------------------------------------------------------------------

GAPS_SQL = """g AS (SELECT author, created_utc - lag(created_utc) OVER (PARTITION BY author ORDER BY created_utc) AS gap FROM meta),
    h AS (SELECT author, CASE WHEN gap < 1 THEN 0 ELSE least(floor(log2(gap + 0.5)) + 1, 39) END::INT AS bin, count(*) AS n, sum(gap) AS seconds
      FROM g WHERE gap IS NOT NULL GROUP BY ALL),
    r AS (SELECT author, sum(n) AS n_gaps, sum(n * log2(n)) AS nlogn, arg_max(bin, (n, bin)) AS main_bin, max(n) AS in_main FROM h GROUP BY author),
    m AS (SELECT author, avg(gap) AS mean_gap, stddev_pop(gap) AS sd FROM g WHERE gap IS NOT NULL GROUP BY author),
    rhythm AS (SELECT author, CAST(n_gaps AS BIGINT) AS n_gaps, mean_gap, CASE WHEN mean_gap > 0 THEN sd / mean_gap END AS variation,
      log2(n_gaps) - nlogn / n_gaps AS entropy, main_bin, in_main / n_gaps AS main_share FROM r JOIN m USING (author))"""


@query("gap_histogram", f"WITH {{meta}}, {GAPS_SQL} SELECT author, bin, n, CAST(seconds AS BIGINT) AS seconds FROM h")
def gap_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return accounts.gap_histogram(st.posts_meta(spark, sf)).drop("squares")


@query(
    "bot_signals",
    f"""WITH {{posts}}, {GAPS_SQL},
    x AS (SELECT author, trim(regexp_replace(lower({POST_TEXT_SQL}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS t FROM posts),
    c AS (SELECT author, t, count(*) AS n FROM x WHERE t IS NOT NULL GROUP BY ALL),
    texts AS (SELECT author, CAST(sum(n) AS BIGINT) AS n_texts, count(*) AS n_different, max(n) AS most_repeated FROM c GROUP BY author)
    SELECT author, n_gaps, round(mean_gap, 6) AS mean_gap, round(variation, 6) AS variation, round(entropy, 6) AS entropy, main_bin,
      round(main_share, 6) AS main_share, n_texts, n_different, most_repeated, round((n_texts - n_different) / n_texts, 6) AS repeat_share,
      coalesce(n_gaps >= 20, FALSE) AND coalesce(variation <= 0.1 OR entropy <= 0.5, FALSE) AS periodic,
      coalesce(n_gaps >= 20, FALSE) AND coalesce((n_texts - n_different) / n_texts >= 0.5, FALSE) AS repetitive
    FROM rhythm FULL JOIN texts USING (author)""",
)
def bot_signals(spark: SparkSession, sf: str) -> DataFrame:
    return accounts.bot_signals(st.posts(spark, sf), post_text())


# --- the life of submissions -----------------------------------------------------------------------

REPLIES_SQL = f"""{FOREST_SQL}, replies AS (SELECT f.root, r.created_utc AS posted, c.created_utc
      FROM forest f JOIN threads c USING (name) JOIN threads r ON r.name = f.root WHERE f.status = 'thread' AND f.depth > 0)"""


def _replies(spark: SparkSession, sf: str) -> DataFrame:
    posts = st.thread_posts(spark, sf)
    forest = stage(threads.reply_forest(posts).where("status = 'thread' AND depth > 0").select("name", "root"))
    times = posts.select("name", "created_utc")
    tops = times.select(F.col("name").alias("root"), F.col("created_utc").alias("posted"))
    return stage(forest.join(times, "name").join(tops, "root").select("root", "posted", "created_utc"))


@query(
    "reply_curve",
    f"""WITH {REPLIES_SQL}, s AS (SELECT root, greatest((created_utc - posted) / 60, 0.0) AS minutes FROM replies),
    c AS (SELECT root, CAST(CASE WHEN minutes < 1 THEN 0 ELSE least(floor(2 * log2(minutes) + 1e-9) + 1, 39) END AS INT) AS step, count(*) AS n FROM s GROUP BY ALL)
    SELECT root, step, n, CAST(sum(n) OVER (PARTITION BY root ORDER BY step) AS BIGINT) AS upto FROM c""",
)
def reply_curve(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.reply_curve(_replies(spark, sf))


LIFE_SQL = f"""{REPLIES_SQL}, aged AS (SELECT *, greatest(created_utc - posted, 0) // 3600 AS hour,
        row_number() OVER (PARTITION BY root ORDER BY greatest(created_utc - posted, 0)) AS k, count(*) OVER (PARTITION BY root) AS all_ FROM replies),
    per_hour AS (SELECT root, hour, count(*) AS n FROM aged GROUP BY ALL),
    peaks AS (SELECT root, arg_max(hour, (n, -hour)) AS peak_hour, max(n) AS peak_replies FROM per_hour GROUP BY root),
    lives AS (SELECT root, max(all_) AS n_replies, min(hour + 1) FILTER (2 * k >= all_) AS half_life,
      max(created_utc) > (SELECT max(created_utc) FROM replies) - 172800 AS unfinished FROM aged GROUP BY root)"""


@query("post_lifecycle", f"WITH {LIFE_SQL} SELECT root, n_replies, peak_hour, peak_replies, half_life, unfinished FROM lives JOIN peaks USING (root)")
def post_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.lifecycle(_replies(spark, sf))


@query(
    "half_life_survival",
    f"""WITH {LIFE_SQL}, c AS (SELECT half_life, count(*) FILTER (NOT unfinished) AS ended, count(*) FILTER (unfinished) AS censored FROM lives GROUP BY half_life),
    r AS (SELECT *, CAST(sum(ended + censored) OVER (ORDER BY half_life DESC) AS BIGINT) AS at_risk FROM c)
    SELECT half_life, at_risk, ended, censored, round(product(1 - ended / at_risk) OVER (ORDER BY half_life), 6) AS survival FROM r""",
)
def half_life_survival(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.survival(lifecycle.lifecycle(_replies(spark, sf)))


# --- distinct counts from sketches -----------------------------------------------------------------

# Of each community over all months but the last three: whether the estimate is within 3 % of the exact count, which the sketches never see.

@query(
    "sketched_uniques",
    f"""WITH {{meta}}, m AS (SELECT strftime(min(ts), '%Y-%m') AS a, strftime(max(ts) - INTERVAL 90 DAYS, '%Y-%m') AS b FROM meta)
    SELECT subreddit, count(*) AS num_posts, count(DISTINCT author) AS authors, count(DISTINCT id) AS ids, TRUE AS near
    FROM meta, m WHERE strftime(ts, '%Y-%m') BETWEEN a AND b GROUP BY subreddit""",
)
def sketched_uniques(spark: SparkSession, sf: str) -> DataFrame:
    posts = st.posts_meta(spark, sf)
    stored = stage(sketches.monthly_sketches(posts))
    ts = F.timestamp_seconds("created_utc")
    ends = posts.agg(F.date_format(F.min(ts), "yyyy-MM").alias("a"), F.date_format(F.max(ts) - F.expr("INTERVAL 90 DAYS"), "yyyy-MM").alias("b"))
    first, last = ends.first()
    found = sketches.estimates(sketches.merged(stored, ["subreddit"], first, last))
    exact = posts.where(F.date_format(ts, "yyyy-MM").between(first, last)).groupBy("subreddit").agg(
        F.count_distinct("author").alias("authors"), F.count_distinct("id").alias("ids")
    )

    def near(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= 0.03 * F.col(count)

    return found.join(exact, "subreddit").select(
        "subreddit", "num_posts", "authors", "ids", (near("distinct_author", "authors") & near("distinct_id", "ids")).alias("near")
    )
