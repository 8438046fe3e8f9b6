"""Queries over activity, engagement, authors and community overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.operators import activity, authors, engagement, overlap
from forumlens.plans.registry import query
from forumlens.plans.tables import BIN_SQL, SIX_SQL, TITLE_SQL
from forumlens.sources import sample_tables as st

TECH = vocab.TECH_COMMUNITIES


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- activity --------------------------------------------------------------------------------

MONTHLY_SQL = """WITH {meta}
    SELECT strftime(ts, '%Y-%m') AS year_month, count(*) FILTER (data_type = 'comment') AS num_comments,
           count(*) FILTER (data_type = 'submission') AS num_submissions, count(*) AS total_rows
    FROM meta GROUP BY ALL"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    meta = st.posts_meta(spark, sf)
    return meta.where(F.col("data_type") == "comment"), meta.where(F.col("data_type") == "submission")


@query("monthly_activity", MONTHLY_SQL)
def monthly_activity(spark: SparkSession, sf: str) -> DataFrame:
    return activity.monthly_activity(st.posts_meta(spark, sf))


@query("monthly_activity_joined", MONTHLY_SQL)
def monthly_activity_joined(spark: SparkSession, sf: str) -> DataFrame:
    return activity.monthly_activity_joined(*_sides(spark, sf))


STATS_SQL = """SELECT subreddit, nullif(count(*) FILTER (data_type = 'comment'), 0) AS num_comments,
      nullif(count(*) FILTER (data_type = 'submission'), 0) AS num_submissions, count(*) AS total_rows{avg},
      round((coalesce(avg(score) FILTER (data_type = 'comment'), 0) + coalesce(avg(score) FILTER (data_type = 'submission'), 0)) / 2, 6) AS avg_score_balanced,
      strftime(min(date), '%Y-%m-%d') || ' to ' || strftime(max(date), '%Y-%m-%d') AS date_range
    FROM meta GROUP BY subreddit"""


@query("community_stats", "WITH {meta} " + STATS_SQL.replace("{avg}", ", round(avg(score), 6) AS avg_score"))
def community_stats(spark: SparkSession, sf: str) -> DataFrame:
    return activity.community_stats(st.posts_meta(spark, sf))


@query("community_stats_joined", "WITH {meta} " + STATS_SQL.replace("{avg}", ""))
def community_stats_joined(spark: SparkSession, sf: str) -> DataFrame:
    return activity.community_stats_joined(*_sides(spark, sf))


ROLLUP_SQL = """m AS (SELECT subreddit, year(ts) AS year, month(ts) AS month,
      count(*) FILTER (data_type = 'comment') AS num_comments, count(*) FILTER (data_type = 'submission') AS num_submissions,
      count(*) AS total_rows,
      CAST(round(CAST((coalesce(avg(score) FILTER (data_type = 'comment'), 0) + coalesce(avg(score) FILTER (data_type = 'submission'), 0)) / 2 AS DECIMAL(38, 10)), 2) AS DOUBLE) AS avg_score
    FROM meta GROUP BY ALL)"""


@query("community_monthly", f"WITH {{meta}}, {ROLLUP_SQL} SELECT * FROM m")
def community_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return activity.community_monthly(st.posts_meta(spark, sf))


@query(
    "community_monthly_rollup",
    f"""WITH {{meta}}, {ROLLUP_SQL}
    SELECT subreddit, year, CAST(sum(num_comments) AS BIGINT) AS num_comments,
           CAST(sum(num_submissions) AS BIGINT) AS num_submissions, CAST(sum(total_rows) AS BIGINT) AS total_rows,
           round(avg(avg_score), 6) AS avg_score FROM m GROUP BY subreddit, year""",
)
def community_monthly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return activity.roll_up_years(activity.community_monthly(st.posts_meta(spark, sf)))


@query(
    "time_slots",
    """WITH {meta}, t AS (SELECT *, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour FROM meta)
    SELECT CASE WHEN grouping(subreddit) = 1 THEN 'overall' ELSE 'community' END AS level, subreddit, day_of_week, hour,
           count(id) AS num_posts, round(avg(score), 6) AS avg_score
    FROM t GROUP BY GROUPING SETS ((subreddit, day_of_week, hour), (day_of_week, hour))""",
)
def time_slots(spark: SparkSession, sf: str) -> DataFrame:
    return activity.time_slots(st.posts_meta(spark, sf))


SLOTS_SQL = """s AS (SELECT dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour, count(id) AS num_posts,
      avg(score) AS avg_score FROM meta GROUP BY ALL)"""
ROLLED_SQL = f"""{SLOTS_SQL}, r AS (SELECT part, value, CAST(sum(num_posts) AS BIGINT) AS num_posts, avg(avg_score) AS avg_score
      FROM (SELECT 'hour' AS part, hour AS value, num_posts, avg_score FROM s
            UNION ALL SELECT 'day', day_of_week, num_posts, avg_score FROM s) GROUP BY ALL)"""


@query(
    "hour_day_rollup",
    f"WITH {{meta}}, {ROLLED_SQL} SELECT part, value, num_posts, round(avg_score, 6) AS avg_score FROM r",
)
def hour_day_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return activity.slot_roll_up(activity.overall_slots(st.posts_meta(spark, sf)))


@query(
    "hour_day_peaks",
    f"""WITH {{meta}}, {ROLLED_SQL}
    SELECT part, first(value ORDER BY num_posts DESC, value) AS peak_volume, first(value ORDER BY num_posts, value) AS lowest_volume,
           first(value ORDER BY round(avg_score, 9) DESC, value) AS peak_score, first(value ORDER BY round(avg_score, 9), value) AS lowest_score
    FROM r GROUP BY part""",
)
def hour_day_peaks(spark: SparkSession, sf: str) -> DataFrame:
    rolled = activity.slot_roll_up(activity.overall_slots(st.posts_meta(spark, sf)))
    return activity.peaks(rolled)


@query(
    "community_slot_summary",
    """WITH {meta}, s AS (SELECT subreddit, dayofweek(ts) AS d, hour(ts) AS h, count(id) AS num_posts, avg(score) AS avg_score
      FROM meta GROUP BY ALL)
    SELECT subreddit, CAST(sum(num_posts) AS BIGINT) AS num_posts, round(avg(avg_score), 6) AS avg_score FROM s GROUP BY subreddit""",
)
def community_slot_summary(spark: SparkSession, sf: str) -> DataFrame:
    return activity.community_slot_summary(activity.community_slots(st.posts_meta(spark, sf)))


def _matrix_sql(value: str, by: str = "") -> str:
    columns = ", ".join(f"max(CASE WHEN hour = {h} THEN {value} END) AS h{h}" for h in range(24))
    days = "['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week]"
    return f"SELECT {by}day_of_week, {columns}, {days} AS day_name FROM s GROUP BY ALL"


@query("slot_matrix", f"WITH {{meta}}, {SLOTS_SQL} " + _matrix_sql("num_posts"))
def slot_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return activity.slot_matrix(activity.overall_slots(st.posts_meta(spark, sf)))


@query("slot_matrix_score", f"WITH {{meta}}, {SLOTS_SQL} " + _matrix_sql("round(avg_score, 6)"))
def slot_matrix_score(spark: SparkSession, sf: str) -> DataFrame:
    return activity.slot_matrix(activity.overall_slots(st.posts_meta(spark, sf)), "avg_score")


@query(
    "slot_matrix_community",
    """WITH {meta}, s AS (SELECT subreddit, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour, count(id) AS num_posts
      FROM meta GROUP BY ALL) """ + _matrix_sql("num_posts", "subreddit, "),
)
def slot_matrix_community(spark: SparkSession, sf: str) -> DataFrame:
    return activity.slot_matrix(activity.community_slots(st.posts_meta(spark, sf)), "num_posts", ["subreddit"])


def _top_sql(by: str) -> str:
    return f"""WITH {{meta}}, {SLOTS_SQL}
    SELECT ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week] AS day_name, day_of_week, hour, num_posts,
           round(avg_score, 6) AS avg_score FROM s ORDER BY {by} DESC, day_of_week, hour LIMIT 10"""


@query("top_slots", _top_sql("num_posts"))
def top_slots(spark: SparkSession, sf: str) -> DataFrame:
    return activity.top_slots(activity.overall_slots(st.posts_meta(spark, sf)))


@query("top_slots_by_score", _top_sql("s.avg_score"))
def top_slots_by_score(spark: SparkSession, sf: str) -> DataFrame:
    return activity.top_slots(activity.overall_slots(st.posts_meta(spark, sf)), "avg_score")


@query(
    "basic_counts",
    """WITH {meta} SELECT count(*) AS num_rows, count(DISTINCT id) AS unique_posts, count(DISTINCT author) AS unique_users
    FROM meta WHERE data_type = 'comment'""",
)
def basic_counts(spark: SparkSession, sf: str) -> DataFrame:
    return activity.basic_counts(_sides(spark, sf)[0])


@query(
    "top_communities",
    """WITH {meta} SELECT subreddit, count(*) AS num_posts FROM meta GROUP BY ALL
    ORDER BY num_posts DESC, subreddit LIMIT 10""",
)
def top_communities(spark: SparkSession, sf: str) -> DataFrame:
    return activity.top_communities(st.posts_meta(spark, sf))


@query(
    "hourly_distribution",
    "WITH {meta} SELECT hour(ts) AS hour, count(*) AS num_posts FROM meta WHERE data_type = 'comment' GROUP BY ALL",
)
def hourly_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return activity.hourly_distribution(_sides(spark, sf)[0])


# --- engagement ------------------------------------------------------------------------------

TITLES_SQL = f"""{{posts}}, f AS (SELECT *, {SIX_SQL} AS category, {TITLE_SQL} FROM posts WHERE data_type = 'submission')"""


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.with_title_features(engagement.with_category(st.submissions(spark, sf)))


@query(
    "category_summary",
    f"""WITH {TITLES_SQL}
    SELECT category, count(*) AS total_posts, round(avg(title_length), 6) AS avg_title_length,
      round(stddev(title_length), 6) AS std_title_length, round(avg(title_word_count), 6) AS avg_word_count,
      round(sum(is_question) / count(*) * 100, 6) AS question_pct, round(sum(starts_with_how) / count(*) * 100, 6) AS how_pct,
      round(sum(starts_with_what) / count(*) * 100, 6) AS what_pct, round(sum(starts_with_why) / count(*) * 100, 6) AS why_pct,
      round(avg(num_comments), 6) AS avg_comments, round(stddev(num_comments), 6) AS std_comments,
      quantile_disc(num_comments, 0.5) AS median_comments, round(avg(score), 6) AS avg_score,
      round(stddev(score), 6) AS std_score, quantile_disc(score, 0.5) AS median_score,
      max(num_comments) AS max_comments, max(score) AS max_score
    FROM f GROUP BY category""",
)
def category_summary(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.category_summary(_titles(spark, sf))


@query(
    "question_impact",
    f"""WITH {TITLES_SQL}
    SELECT category, count(*) FILTER (is_question = 0) AS posts_non_question, count(*) FILTER (is_question = 1) AS posts_question,
      round(coalesce(avg(num_comments) FILTER (is_question = 0), 0), 6) AS comments_non_question,
      round(coalesce(avg(num_comments) FILTER (is_question = 1), 0), 6) AS comments_question,
      round(coalesce(avg(score) FILTER (is_question = 0), 0), 6) AS score_non_question,
      round(coalesce(avg(score) FILTER (is_question = 1), 0), 6) AS score_question
    FROM f WHERE category IS NOT NULL GROUP BY category""",
)
def question_impact(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.question_impact(_titles(spark, sf))


BINS_SQL = f"""{TITLES_SQL}, b AS (SELECT category, {BIN_SQL} AS length_bin, count(*) AS post_count,
      avg(num_comments) AS avg_comments, avg(score) AS avg_score FROM f WHERE category IS NOT NULL GROUP BY ALL
      HAVING count(*) >= 10)"""


@query(
    "title_length_bins",
    f"""WITH {BINS_SQL} SELECT category, length_bin, post_count, round(avg_comments, 6) AS avg_comments,
      round(avg_score, 6) AS avg_score FROM b""",
)
def title_length_bins(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.title_length_bins(_titles(spark, sf))


@query(
    "title_length_matrix",
    f"WITH {BINS_SQL} SELECT length_bin, "
    + ", ".join(f"round(max(avg_comments) FILTER (category = '{c}'), 6) AS {c}" for c in vocab.SIX_WAY_CATEGORY)
    + " FROM b GROUP BY length_bin",
)
def title_length_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.bin_matrix(engagement.title_length_bins(_titles(spark, sf)))


@query(
    "length_trend",
    f"""WITH {TITLES_SQL}
    SELECT category, count(*) AS n, round(regr_slope(num_comments, title_length), 6) AS slope,
      round(regr_intercept(num_comments, title_length), 6) AS intercept, round(corr(title_length, num_comments), 6) AS pearson_r
    FROM f WHERE category IS NOT NULL AND num_comments < 500 AND title_length < 300 GROUP BY category""",
)
def length_trend(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.length_trend(engagement.without_outliers(_titles(spark, sf)))


EVENT_ROWS_SQL = ", ".join(f"('{e}', DATE '{d}')" for e, d in vocab.RELEASE_EVENTS)


@query(
    "event_study",
    f"""WITH {{meta}}, daily AS (SELECT subreddit, date AS day, avg(score) AS x FROM meta GROUP BY ALL),
    ev(event, event_date) AS (VALUES {EVENT_ROWS_SQL}),
    tagged AS (SELECT event, event_date, subreddit, x, day - event_date AS o,
        CASE WHEN day - event_date BETWEEN -14 AND -1 THEN 'pre' WHEN day - event_date BETWEEN 0 AND 13 THEN 'post'
             WHEN day - event_date BETWEEN -56 AND -29 THEN 'baseline' END AS phase FROM daily, ev),
    ranked AS (SELECT *, rank() OVER (PARTITION BY event, subreddit, phase <> 'baseline' ORDER BY x)
        + (count(*) OVER (PARTITION BY event, subreddit, phase <> 'baseline', x) - 1) / 2 AS r FROM tagged WHERE phase IS NOT NULL),
    g AS (SELECT event, event_date, subreddit, count(*) FILTER (phase = 'pre') AS n1, count(*) FILTER (phase = 'post') AS n2,
        avg(x) FILTER (phase = 'baseline') AS mb, avg(x) FILTER (phase = 'pre') AS m1, avg(x) FILTER (phase = 'post') AS m2,
        avg(x) FILTER (phase = 'post' AND o >= 7) AS m3, var_samp(x) FILTER (phase = 'pre') AS v1,
        var_samp(x) FILTER (phase = 'post') AS v2, sum(r) FILTER (phase = 'post') - n2 * (n2 + 1) / 2 AS u
      FROM ranked GROUP BY ALL),
    h AS (SELECT *, m2 - m1 AS d, CASE WHEN sqrt(v1 / n1 + v2 / n2) > 0 THEN (m2 - m1) / sqrt(v1 / n1 + v2 / n2) END AS t FROM g)
    SELECT event, event_date, subreddit, n1 AS n_pre, n2 AS n_post, round(mb, 6) AS mean_baseline, round(m1, 6) AS mean_pre,
      round(m2, 6) AS mean_post, round(m3, 6) AS mean_second_week, round(d, 6) AS lift, round(t, 6) AS welch_t,
      round(CASE WHEN n1 + n2 > 2 AND ((n1 - 1) * v1 + (n2 - 1) * v2) > 0 THEN d / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) END, 6) AS cohens_d,
      round(CAST(u AS DOUBLE), 6) AS mann_whitney_u,
      round(CASE WHEN n1 * n2 > 0 THEN (u - n1 * n2 / 2) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0) END, 6) AS u_z,
      CASE WHEN t IS NULL OR abs(t) < 2 THEN 'none' WHEN d <> 0 AND (m3 - m1) / d >= 0.5 THEN 'sustained' ELSE 'spike' END AS pattern
    FROM h""",
)
def event_study(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.event_study(engagement.daily_engagement(st.posts_meta(spark, sf)))


# --- authors ---------------------------------------------------------------------------------

TECH_META = f"{{meta}}, tech AS (SELECT * FROM meta WHERE subreddit IN ({_names(TECH)}))"
TECH_POSTS = f"{{posts}}, tech AS (SELECT * FROM posts WHERE subreddit IN ({_names(TECH)}))"
AUTHOR_SQL = """a AS (SELECT author, count(*) AS total_posts, count(DISTINCT subreddit) AS num_subreddits,
      avg(score) AS avg_score, max(score) AS max_score, min(created_utc) AS first_post, max(created_utc) AS last_post,
      count(*) FILTER (data_type = 'comment') AS num_comments, count(*) FILTER (data_type = 'submission') AS num_submissions,
      array_to_string(list_sort(list(DISTINCT subreddit)), ', ') AS communities FROM tech GROUP BY author)"""
PAIR_SQL = """sa AS (SELECT subreddit, author, count(*) AS total_posts, avg(score) AS avg_score,
      CAST(sum(score) AS BIGINT) AS score_sum, max(score) AS max_score, min(created_utc) AS first_post, max(created_utc) AS last_post,
      count(*) FILTER (data_type = 'comment') AS num_comments, count(*) FILTER (data_type = 'submission') AS num_submissions
    FROM tech GROUP BY ALL)"""


def _tech(df: DataFrame) -> DataFrame:
    return df.where(F.col("subreddit").isin(*TECH))


def _tech_meta(spark: SparkSession, sf: str) -> DataFrame:
    return _tech(st.posts_meta(spark, sf))


@query(
    "author_stats",
    f"""WITH {TECH_META}, {AUTHOR_SQL}
    SELECT author, total_posts, num_subreddits, round(avg_score, 6) AS avg_score, max_score, first_post, last_post,
      num_comments, num_submissions, last_post - first_post AS active_span_seconds FROM a""",
)
def author_stats(spark: SparkSession, sf: str) -> DataFrame:
    return authors.author_stats(_tech_meta(spark, sf)).drop("communities")


@query(
    "author_community_stats",
    f"""WITH {TECH_META}, {PAIR_SQL}
    SELECT subreddit, author, total_posts, round(avg_score, 6) AS avg_score, max_score, first_post, last_post,
      num_comments, num_submissions, last_post - first_post AS active_span_seconds FROM sa""",
)
def author_community_stats(spark: SparkSession, sf: str) -> DataFrame:
    return authors.author_community_stats(_tech_meta(spark, sf)).drop("score_sum", "scored_posts")


@query(
    "author_kind_counts",
    """WITH {meta}
    SELECT author, count(*) FILTER (data_type = 'comment') AS num_comments,
           count(*) FILTER (data_type = 'submission') AS num_submissions FROM meta GROUP BY author""",
)
def author_kind_counts(spark: SparkSession, sf: str) -> DataFrame:
    return authors.author_kind_counts(st.posts_meta(spark, sf))


@query(
    "top_authors",
    f"""WITH {TECH_META}, {AUTHOR_SQL}
    SELECT author, total_posts, num_subreddits, round(avg_score, 6) AS avg_score, max_score, first_post, last_post,
      num_comments, num_submissions, last_post - first_post AS active_span_seconds,
      (SELECT quantile_disc(total_posts, 0.99) FROM a) AS p99_posts,
      num_subreddits AS num_tech_subreddits, communities AS tech_subreddits_str
    FROM a WHERE total_posts >= (SELECT quantile_disc(total_posts, 0.99) FROM a)""",
)
def top_authors(spark: SparkSession, sf: str) -> DataFrame:
    stats = authors.author_stats(_tech_meta(spark, sf))
    return authors.footprint(authors.top_authors(stats)).drop("communities")


BEST = "ORDER BY score DESC, created_utc, id, data_type"


@query(
    "top_author_profile",
    f"""WITH {{posts}}, tech AS (SELECT * FROM posts WHERE subreddit IN ({_names(TECH)})), {AUTHOR_SQL},
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY author {BEST}) AS rn FROM tech) WHERE rn = 1)
    SELECT author, total_posts, communities AS tech_subreddits_str, best.subreddit AS best_subreddit, best.title AS best_title,
      md5(best.body) AS best_body_digest, best.score AS best_score, best.created_utc AS best_created_utc
    FROM a JOIN best USING (author) WHERE total_posts >= (SELECT quantile_disc(total_posts, 0.99) FROM a)""",
)
def top_author_profile(spark: SparkSession, sf: str) -> DataFrame:
    return authors.top_author_profile(_tech(st.posts(spark, sf))).select(
        "author", "total_posts", "tech_subreddits_str", "best_subreddit", "best_title",
        F.md5("best_body").alias("best_body_digest"), "best_score", "best_created_utc",
    )


@query(
    "top_authors_by_community",
    f"""WITH {TECH_POSTS}, {PAIR_SQL}, p AS (SELECT subreddit, quantile_disc(total_posts, 0.99) AS p99_posts FROM sa GROUP BY subreddit),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subreddit, author {BEST}) AS rn FROM tech) WHERE rn = 1)
    SELECT sa.subreddit, sa.author, total_posts, round(avg_score, 6) AS avg_score, max_score, sa.num_comments, num_submissions, p99_posts,
      best.title AS best_title, md5(best.body) AS best_body_digest, best.score AS best_score, best.created_utc AS best_created_utc
    FROM sa JOIN p USING (subreddit) JOIN best ON best.subreddit = sa.subreddit AND best.author = sa.author
    WHERE total_posts >= p99_posts""",
)
def top_authors_by_community(spark: SparkSession, sf: str) -> DataFrame:
    profile = authors.top_author_profile_by_community(_tech(st.posts(spark, sf)), communities=TECH)
    return profile.select(
        "subreddit", "author", "total_posts", "avg_score", "max_score", "num_comments", "num_submissions", "p99_posts",
        "best_title", F.md5("best_body").alias("best_body_digest"), "best_score", "best_created_utc",
    )


@query(
    "posts_of_top_authors",
    f"""WITH {TECH_META}, {PAIR_SQL}, p AS (SELECT subreddit, quantile_disc(total_posts, 0.99) AS p99 FROM sa GROUP BY subreddit)
    SELECT t.subreddit, t.author, t.id, t.score, t.created_utc FROM tech t
    JOIN sa ON sa.subreddit = t.subreddit AND sa.author = t.author JOIN p ON p.subreddit = t.subreddit WHERE total_posts >= p99""",
)
def posts_of_top_authors(spark: SparkSession, sf: str) -> DataFrame:
    tech = _tech_meta(spark, sf)
    top = authors.top_authors_by_community(authors.author_community_stats(tech), communities=TECH)
    return authors.posts_of(tech, top, ["subreddit", "author"]).select(
        "subreddit", "author", "id", "score", "created_utc"
    )


@query(
    "breadth_distribution",
    f"""WITH {TECH_META}, {AUTHOR_SQL}, c AS (SELECT CASE WHEN num_subreddits = 1 THEN 'specialist' WHEN num_subreddits <= 3 THEN 'broad'
      ELSE 'generalist' END AS author_category, count(*) AS n_authors FROM a GROUP BY ALL)
    SELECT author_category, n_authors, round(n_authors / sum(n_authors) OVER () * 100, 2) AS percent FROM c""",
)
def breadth_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return authors.breadth_distribution(authors.author_stats(_tech_meta(spark, sf)))


@query(
    "span_histogram",
    f"""WITH {TECH_META}, {AUTHOR_SQL}, v AS (SELECT (last_post - first_post) / 31536000 AS v FROM a),
    l AS (SELECT min(v) AS lo, max(v) AS hi FROM v)
    SELECT bin, round(lo + (hi - lo) / 40 * bin, 6) AS bin_start, round(lo + (hi - lo) / 40 * (bin + 1), 6) AS bin_end, count(*) AS n
    FROM (SELECT CAST(least(floor((v - lo) * 40 / (hi - lo)), 39) AS BIGINT) AS bin, lo, hi FROM v, l) GROUP BY ALL""",
)
def span_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return authors.span_histogram(authors.author_stats(_tech_meta(spark, sf)))


@query(
    "top_posts",
    f"""WITH {{posts}}
    SELECT subreddit, author, title, md5(body) AS body_digest, score, created_utc, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY subreddit {BEST}) AS rank FROM posts WHERE subreddit IN ({_names(TECH)})) WHERE rank <= 5""",
)
def top_posts(spark: SparkSession, sf: str) -> DataFrame:
    return authors.top_posts(_tech(st.posts(spark, sf))).select(
        "subreddit", "author", "title", F.md5("body").alias("body_digest"), "score", "created_utc", "rank"
    )


TOP_AUTHOR_POSTS_SQL = f"""{TECH_POSTS}, {AUTHOR_SQL}, q AS (
      SELECT *, row_number() OVER (PARTITION BY subreddit {BEST}) AS rank FROM tech
      WHERE author IN (SELECT author FROM a WHERE total_posts >= (SELECT quantile_disc(total_posts, 0.99) FROM a)))"""


def _top_author_posts(spark: SparkSession, sf: str) -> DataFrame:
    tech = _tech(st.posts(spark, sf))
    return authors.top_posts(authors.posts_of(tech, authors.top_authors(authors.author_stats(tech))))


@query(
    "top_author_posts",
    f"WITH {TOP_AUTHOR_POSTS_SQL} SELECT subreddit, author, id, title, md5(body) AS body_digest, score, created_utc, rank FROM q WHERE rank <= 5",
)
def top_author_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _top_author_posts(spark, sf).select(
        "subreddit", "author", "id", "title", F.md5("body").alias("body_digest"), "score", "created_utc", "rank"
    )


@query(
    "top_example_posts",
    f"""WITH {TOP_AUTHOR_POSTS_SQL} SELECT subreddit, author, id, title, md5(body) AS body_digest, score, created_utc FROM q WHERE rank <= 5
    ORDER BY score DESC, created_utc, id LIMIT 30""",
)
def top_example_posts(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["subreddit", "author", "id", "title", F.md5("body").alias("body_digest"), "score", "created_utc"]
    return _top_author_posts(spark, sf).select(*columns).orderBy(F.desc("score"), "created_utc", "id").limit(30)


@query(
    "best_post_per_author",
    f"""WITH {{posts}}
    SELECT author, subreddit, title, md5(body) AS body_digest, score, created_utc FROM (
      SELECT *, row_number() OVER (PARTITION BY author {BEST}) AS rn FROM posts) WHERE rn = 1""",
)
def best_post_per_author(spark: SparkSession, sf: str) -> DataFrame:
    return authors.best_posts(st.posts(spark, sf)).select(
        "author", "subreddit", "title", F.md5("body").alias("body_digest"), "score", "created_utc"
    )


@query(
    "best_post_per_author_community",
    f"""WITH {{posts}}
    SELECT subreddit, author, id, title, md5(body) AS body_digest, score, created_utc FROM (
      SELECT *, row_number() OVER (PARTITION BY subreddit, author {BEST}) AS rn FROM posts) WHERE rn = 1""",
)
def best_post_per_author_community(spark: SparkSession, sf: str) -> DataFrame:
    return authors.best_posts(st.posts(spark, sf), ["subreddit", "author"]).select(
        "subreddit", "author", "id", "title", F.md5("body").alias("body_digest"), "score", "created_utc"
    )


@query(
    "home_community",
    f"""WITH {TECH_META}, {PAIR_SQL}
    SELECT author, first(subreddit ORDER BY total_posts DESC, subreddit) AS most_posts_in,
           first(subreddit ORDER BY score_sum DESC, subreddit) AS most_score_in FROM sa GROUP BY author""",
)
def home_community(spark: SparkSession, sf: str) -> DataFrame:
    return authors.home_community(authors.author_community_stats(_tech_meta(spark, sf)))


# --- overlap ---------------------------------------------------------------------------------

PAIRS_SQL = f"""d AS (SELECT DISTINCT author, subreddit FROM meta WHERE subreddit IN ({_names(TECH)})),
    o AS (SELECT a.subreddit AS sub_1, b.subreddit AS sub_2, count(*) AS shared_authors
      FROM d a JOIN d b ON a.author = b.author AND a.subreddit < b.subreddit GROUP BY ALL)"""


@query("overlap_pairs", f"WITH {{meta}}, {PAIRS_SQL} SELECT * FROM o")
def overlap_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.overlap_pairs(st.posts_meta(spark, sf))


@query(
    "overlap_matrix",
    f"""WITH {{meta}}, {PAIRS_SQL}, both_ways AS (SELECT sub_1 AS a, sub_2 AS b, shared_authors FROM o
      UNION ALL SELECT sub_2, sub_1, shared_authors FROM o)
    SELECT s.subreddit, """
    + ", ".join(f'coalesce(max(shared_authors) FILTER (b = \'{n}\'), 0) AS "{n}"' for n in sorted(TECH))
    + " FROM (SELECT DISTINCT subreddit FROM d) s LEFT JOIN both_ways ON a = s.subreddit GROUP BY s.subreddit",
)
def overlap_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.overlap_matrix(st.posts_meta(spark, sf))


@query(
    "overlap_top",
    f"""WITH {{meta}}, {PAIRS_SQL} SELECT *, sub_1 || ' ↔ ' || sub_2 AS pair FROM o
    ORDER BY shared_authors DESC, sub_1, sub_2 LIMIT 25""",
)
def overlap_top(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.top_pairs(overlap.overlap_pairs(st.posts_meta(spark, sf)))


ALL_PAIRS_SQL = """d AS (SELECT DISTINCT author, {0} AS subreddit FROM meta),
    n AS (SELECT subreddit, count(*) AS n FROM d GROUP BY ALL),
    o AS (SELECT a.subreddit AS sub_1, b.subreddit AS sub_2, count(*) AS shared_authors
      FROM d a JOIN d b ON a.author = b.author AND a.subreddit < b.subreddit GROUP BY ALL),
    j AS (SELECT o.*, shared_authors / (x.n + y.n - shared_authors) AS jaccard FROM o JOIN n x ON x.subreddit = sub_1 JOIN n y ON y.subreddit = sub_2)"""


@query("overlap_everywhere", f"WITH {{meta}}, {ALL_PAIRS_SQL.format('subreddit')} SELECT sub_1, sub_2, shared_authors, round(jaccard, 6) AS jaccard FROM j")
def overlap_everywhere(spark: SparkSession, sf: str) -> DataFrame:
    """Every pair of communities with a common author, without a list."""
    return overlap.similar_communities(st.posts_meta(spark, sf), min_jaccard=0.0)


# Each community's days as communities of their own: thousands of sets.
@query(
    "overlap_similar_days",
    f"""WITH {{meta}}, {ALL_PAIRS_SQL.format("subreddit || ' ' || strftime(date, '%Y-%m-%d')")}
    SELECT sub_1, sub_2, shared_authors, round(jaccard, 6) AS jaccard FROM j WHERE shared_authors >= 2 AND jaccard >= 0.2""",
)
def overlap_similar_days(spark: SparkSession, sf: str) -> DataFrame:
    days = st.posts_meta(spark, sf).withColumn("subreddit", F.concat_ws(" ", "subreddit", F.date_format("date", "yyyy-MM-dd")))
    return overlap.similar_communities(days, min_jaccard=0.2, min_shared=2)
