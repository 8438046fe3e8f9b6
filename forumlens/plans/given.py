"""Model arithmetic over vectors and predictions that a rule gives, so that SQL can say it too.

Topic weights are the first five numbers of an embedding, made positive and summing to one. Predictions and
clusters follow from event ids.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumlens.ml import evaluate, regress, segment
from forumlens.operators import topics as tp
from forumlens.plans.language import REGEX_SQL, TEXT_SQL, _posts
from forumlens.plans.registry import query
from forumlens.plans.tables import TOOL_SQL
from forumlens.functions import text
from forumlens.sources import sample_tables as st

K = 5
VECTOR_SQL = f"""v AS (SELECT vec_id, [abs(x) / total for x in w] AS w FROM (
      SELECT vec_id, w, list_sum([abs(x) for x in w]) AS total
      FROM (SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding[1:{K}]] AS w FROM embeddings)))"""
WEIGHTED_SQL = f"""{{meta}}, {VECTOR_SQL}, t AS (
    SELECT m.*, v.w, list_position(v.w, list_max(v.w)) - 1 AS dominant_topic
    FROM meta m JOIN v ON v.vec_id = m.event_id % (SELECT count(*) FROM embeddings))"""


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    w = F.transform(F.slice("embedding", 1, K), lambda x: F.abs(x.cast("double")))
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    found = st.table(spark, sf, "embeddings").select("vec_id", w.alias("w"))
    return found.select("vec_id", array_to_vector(F.transform("w", lambda x: x / total)).alias("topicDistribution"))


def _weighted(spark: SparkSession, sf: str, posts: DataFrame | None = None) -> DataFrame:
    vectors = _vectors(spark, sf)
    n = st.table(spark, sf, "embeddings").agg(F.count(F.lit(1))).scalar()
    posts = st.posts_meta(spark, sf) if posts is None else posts
    return posts.withColumn("vec_id", F.col("event_id") % n).join(vectors, "vec_id").drop("vec_id")


@query(
    "posts_with_topics",
    f"""WITH {{posts}}, {VECTOR_SQL}
    SELECT event_id, id, subreddit, md5(body) AS body_digest, round(v.w[1], 6) AS first_weight, round(v.w[{K}], 6) AS last_weight
    FROM posts p JOIN v ON v.vec_id = p.event_id % (SELECT count(*) FROM embeddings) WHERE data_type = 'comment'""",
)
def posts_with_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Weights come back to the posts they belong to, one row each, though ids repeat."""
    comments = st.comments(spark, sf)
    weights = tp.with_post_key(_weighted(spark, sf, comments)).select(*tp.POST_KEY, "topicDistribution")
    w = vector_to_array("topicDistribution")
    return tp.attach_topics(comments, weights).select(
        "event_id", "id", "subreddit", F.md5("body").alias("body_digest"), w[0].alias("first_weight"), w[K - 1].alias("last_weight")
    )


@query("given_dominant_topics", f"WITH {WEIGHTED_SQL} SELECT event_id, dominant_topic FROM t")
def given_dominant_topics(spark: SparkSession, sf: str) -> DataFrame:
    return tp.with_dominant_topic(_weighted(spark, sf)).select("event_id", "dominant_topic")


@query("given_topic_counts", f"WITH {WEIGHTED_SQL} SELECT dominant_topic, count(*) AS count FROM t GROUP BY ALL")
def given_topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tp.topic_counts(tp.with_dominant_topic(_weighted(spark, sf)))


@query(
    "given_topic_by_community",
    f"WITH {WEIGHTED_SQL} SELECT subreddit, dominant_topic, count(*) AS count FROM t GROUP BY ALL",
)
def given_topic_by_community(spark: SparkSession, sf: str) -> DataFrame:
    return tp.topic_counts(tp.with_dominant_topic(_weighted(spark, sf)), ["subreddit"])


@query(
    "given_topic_matrix",
    f"WITH {WEIGHTED_SQL} SELECT subreddit, "
    + ", ".join(f'count(*) FILTER (dominant_topic = {i}) AS "T{i}"' for i in range(K))
    + " FROM t GROUP BY subreddit",
)
def given_topic_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return tp.community_matrix(tp.topic_counts(tp.with_dominant_topic(_weighted(spark, sf)), ["subreddit"]), K)


# --- topic terms: the words of all documents, dealt to topics by their length; one topic more than there are weights

TERMS_SQL = f"""words AS (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS term FROM documents),
    counted AS (SELECT length(term) % {K + 1} AS topic, term, count(*) AS c FROM words WHERE term <> '' GROUP BY ALL),
    n AS (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY c DESC, term) - 1 AS rank, c / sum(c) OVER (PARTITION BY topic) AS weight
      FROM counted)"""
#: Terms of a topic that are shown.
SHOWN = 10


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    words = st.table(spark, sf, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where("term <> ''")
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("c")).withColumn("topic", (F.length("term") % (K + 1)).cast("int"))
    totals = counted.groupBy("topic").agg(F.sum("c").alias("all"))
    best = Window.partitionBy("topic").orderBy(F.desc("c"), "term")
    shown = counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= SHOWN).join(F.broadcast(totals), "topic")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term", (F.col("c") / F.col("all")).alias("weight")))).alias("o")
    return shown.groupBy("topic").agg(ordered).select("topic", F.col("o.term").alias("terms_words"), F.col("o.weight").alias("term_weights"))


@query(
    "given_topic_labels",
    f"""WITH {WEIGHTED_SQL}, {TERMS_SQL}, l AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) FILTER (rank < 4) AS label FROM n GROUP BY topic)
    SELECT topic, label, (SELECT count(*) FROM t WHERE dominant_topic = topic) AS count FROM l""",
)
def given_topic_labels(spark: SparkSession, sf: str) -> DataFrame:
    counts = tp.topic_counts(tp.with_dominant_topic(_weighted(spark, sf)))
    return tp.labelled_counts(_terms(spark, sf), counts)


@query(
    "given_topic_term_matrix",
    f"WITH {TERMS_SQL} SELECT topic, "
    + ", ".join(f'round(coalesce(max(weight) FILTER (rank = {i}), 0), 6) AS "Rank{i + 1}"' for i in range(6))
    + " FROM n GROUP BY topic",
)
def given_topic_term_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return tp.term_matrix(_terms(spark, sf), 6)


# --- users -------------------------------------------------------------------------------------

USERS_SQL = f"""{WEIGHTED_SQL}, tools AS (SELECT author, {TOOL_SQL} AS tool, count(*) AS n FROM t GROUP BY ALL),
    best AS (SELECT author, arg_min(tool, (-n, tool)) AS primary_tool FROM tools WHERE tool IS NOT NULL GROUP BY author),
    u AS (SELECT author, count(*) AS comment_count, """ + ", ".join(
    f"avg(w[{i + 1}]) AS topic_{i}" for i in range(K)
) + """ FROM t GROUP BY author), users AS (SELECT u.*, primary_tool FROM u LEFT JOIN best USING (author))"""


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return segment.user_topics(_weighted(spark, sf))


@query(
    "given_user_topics",
    f"WITH {USERS_SQL} SELECT author, comment_count, primary_tool, "
    + ", ".join(f"round(topic_{i}, 6) AS topic_{i}" for i in range(K))
    + " FROM users",
)
def given_user_topics(spark: SparkSession, sf: str) -> DataFrame:
    return segment.wide_topics(_users(spark, sf), K)


@query(
    "given_cluster_profile",
    f"""WITH {USERS_SQL}, c AS (SELECT *, comment_count % 3 AS cluster FROM users),
    tool AS (SELECT cluster, arg_min(primary_tool, (-n, primary_tool)) AS top_primary_tool FROM (
      SELECT cluster, primary_tool, count(*) AS n FROM c WHERE primary_tool IS NOT NULL GROUP BY ALL) GROUP BY cluster)
    SELECT c.cluster, 'Cluster ' || c.cluster AS cluster_label, count(*) AS n_users, round(avg(comment_count), 6) AS mean_comment_count,
      round(median(comment_count), 6) AS median_comment_count, any_value(top_primary_tool) AS top_primary_tool
    FROM c LEFT JOIN tool ON tool.cluster = c.cluster GROUP BY c.cluster""",
)
def given_cluster_profile(spark: SparkSession, sf: str) -> DataFrame:
    from forumlens.functions.categories import persona

    users = _users(spark, sf).withColumn("cluster", (F.col("comment_count") % 3).cast("int"))
    return segment.cluster_profile(users.withColumn("cluster_label", persona(F.col("cluster"))))


# --- vocabulary --------------------------------------------------------------------------------

LIMIT, MIN_DF = 400, 12
VOCABULARY_SQL = f"""{TEXT_SQL}, w AS (SELECT event_id, unnest({REGEX_SQL}) AS term FROM t WHERE data_type = 'submission'),
    p AS (SELECT event_id, term, count(*) AS n FROM w GROUP BY ALL),
    s AS (SELECT term, CAST(sum(n) AS BIGINT) AS total_count, count(*) AS doc_count FROM p GROUP BY term),
    k AS (SELECT term FROM s WHERE doc_count >= {MIN_DF} ORDER BY total_count DESC, term LIMIT {LIMIT})"""


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    df = _posts(spark, sf).where("data_type = 'submission'").select(text.tokens_regex(F.col("text")).alias("tokens"))
    return tp.vocabulary(df, "tokens", LIMIT, MIN_DF)


@query(
    "vocabulary_terms",
    f"""WITH {VOCABULARY_SQL} SELECT term, total_count, doc_count, term IN (SELECT term FROM k) AS kept,
      round(ln(((SELECT count(*) FROM t WHERE data_type = 'submission') + 1) / (doc_count + 1)), 6) AS idf FROM s""",
)
def vocabulary_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(spark, sf)


@query(
    "vocabulary_coverage",
    f"""WITH {VOCABULARY_SQL}, f AS (SELECT *, term IN (SELECT term FROM k) AS kept FROM s)
    SELECT count(*) AS terms_seen, count(*) FILTER (kept) AS terms_kept, CAST(sum(total_count) AS BIGINT) AS tokens_seen,
      CAST(sum(total_count) FILTER (kept) AS BIGINT) AS tokens_kept, round(sum(total_count) FILTER (kept) / sum(total_count), 6) AS share_kept FROM f""",
)
def vocabulary_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return tp.coverage(_vocabulary(spark, sf))


# --- metrics over predictions by rule ------------------------------------------------------------

RULES_SQL = """p AS (SELECT *, CAST(score >= 8 AS DOUBLE) AS label_binary, CAST(event_id % 3 = 0 OR score >= 30 AS DOUBLE) AS guess,
      CAST(event_id % 4 AS DOUBLE) AS label, CAST((event_id % 4 + CAST(event_id % 7 = 0 AS BIGINT)) % 4 AS DOUBLE) AS near,
      CAST(event_id % 2 AS DOUBLE) AS coarse, CAST(event_id % 50 AS DOUBLE) AS value FROM meta)"""


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return st.posts_meta(spark, sf).select(
        "event_id", "subreddit", "score",
        (F.col("score") >= 8).cast("double").alias("label_binary"),
        ((e % 3 == 0) | (F.col("score") >= 30)).cast("double").alias("guess"),
        (e % 4).cast("double").alias("label"),
        ((e % 4 + (e % 7 == 0).cast("long")) % 4).cast("double").alias("near"),
        (e % 2).cast("double").alias("coarse"),
        (e % 50).cast("double").alias("value"),
    )


@query("given_confusion", f"WITH {{meta}}, {RULES_SQL} SELECT label_binary, guess AS prediction, count(*) AS count FROM p GROUP BY ALL")
def given_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion(_predictions(spark, sf).withColumnRenamed("guess", "prediction"), "label_binary")


@query("given_label_distribution", f"WITH {{meta}}, {RULES_SQL} SELECT label, count(*) AS count FROM p GROUP BY ALL")
def given_label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.label_distribution(_predictions(spark, sf), "label")


def _class_metrics_sql(parts: str) -> str:
    return f"""{RULES_SQL}, cells AS ({parts}),
    sides AS (SELECT model, label AS c, count(*) AS actual, 0 AS predicted, count(*) FILTER (label = prediction) AS hits FROM cells GROUP BY ALL
      UNION ALL SELECT model, prediction, 0, count(*), 0 FROM cells GROUP BY ALL),
    classes AS (SELECT model, c, sum(actual) AS actual, sum(predicted) AS predicted, sum(hits) AS hits FROM sides GROUP BY ALL),
    rates AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS pr, coalesce(hits / nullif(actual, 0), 0) AS re FROM classes)
    SELECT model, round(sum(hits) / sum(actual), 6) AS accuracy, round(sum(actual * coalesce(2 * pr * re / nullif(pr + re, 0), 0)) / sum(actual), 6) AS f1,
      round(sum(actual * pr) / sum(actual), 6) AS weighted_precision, round(sum(actual * re) / sum(actual), 6) AS weighted_recall
    FROM rates GROUP BY model"""


@query(
    "given_class_metrics",
    "WITH {meta}, " + _class_metrics_sql("SELECT 'near' AS model, label, near AS prediction FROM p UNION ALL SELECT 'coarse', label, coarse FROM p"),
)
def given_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = _predictions(spark, sf)
    models = {m: p.select("label", F.col(m).alias("prediction")) for m in ("near", "coarse")}
    return evaluate.class_metrics(evaluate.confusions(models))


@query("given_binary_shares", "WITH {meta}, " + _class_metrics_sql("SELECT 'rule' AS model, label_binary AS label, guess AS prediction FROM p"))
def given_binary_shares(spark: SparkSession, sf: str) -> DataFrame:
    p = _predictions(spark, sf).withColumnRenamed("guess", "prediction")
    return evaluate.class_metrics(evaluate.confusions({"rule": p}, "label_binary"), "label_binary")


@query(
    "given_regression_metrics",
    f"""WITH {{meta}}, {RULES_SQL} SELECT count(*) AS n, round(sqrt(avg((score - value) * (score - value))), 6) AS rmse,
      round(avg(abs(score - value)), 6) AS mae, round(1 - sum((score - value) * (score - value)) / (var_pop(score) * count(*)), 6) AS r2 FROM p""",
)
def given_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.regression_table(_predictions(spark, sf).withColumnRenamed("value", "prediction"))


LADDER_SQL = """steps AS (SELECT value + CAST(score AS DOUBLE) / 4 AS score, count(*) FILTER (label_binary = 1) AS p, count(*) FILTER (label_binary = 0) AS n
      FROM p WHERE label_binary IS NOT NULL AND value + score IS NOT NULL GROUP BY ALL),
    ladder AS (SELECT *, CAST(sum(p) OVER w AS BIGINT) AS p_upto, CAST(sum(n) OVER w AS BIGINT) AS n_upto FROM steps WINDOW w AS (ORDER BY score DESC))"""


def _ladder(spark: SparkSession, sf: str) -> DataFrame:
    p = _predictions(spark, sf).withColumn("guess", F.col("value") + F.col("score").cast("double") / 4)
    return evaluate.score_ladder(p, "guess")


@query("given_score_ladder", f"WITH {{meta}}, {RULES_SQL}, {LADDER_SQL} SELECT * FROM ladder")
def given_score_ladder(spark: SparkSession, sf: str) -> DataFrame:
    return _ladder(spark, sf)


# The ROC area as the mean rank of the positives, the other one from the curve's points.
@query(
    "given_binary_areas",
    f"""WITH {{meta}}, {RULES_SQL}, {LADDER_SQL}, ranked AS (
      SELECT label_binary, avg(row) OVER (PARTITION BY score) AS mean_rank FROM (
        SELECT label_binary, value + score / 4 AS score, row_number() OVER (ORDER BY value + score / 4) AS row FROM p)),
    points AS (SELECT score, p, p_upto / (p_upto + n_upto) AS pr, lag(p_upto / (p_upto + n_upto)) OVER (ORDER BY score DESC) AS pr_before FROM ladder),
    t AS (SELECT sum(p) AS ps, sum(n) AS ns FROM steps)
    SELECT CAST(ps AS BIGINT) AS n_positive, CAST(ns AS BIGINT) AS n_negative,
      round(((SELECT sum(mean_rank) FROM ranked WHERE label_binary = 1) - ps * (ps + 1) / 2) / (ps * ns), 6) AS roc_auc,
      round((SELECT sum(p * (pr + coalesce(pr_before, pr)) / 2) FROM points) / ps, 6) AS pr_auc
    FROM t""",
)
def given_binary_areas(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.ladder_areas(_ladder(spark, sf))


@query(
    "given_extremes",
    """WITH {meta}, c AS (SELECT subreddit AS feature, avg(score) AS coefficient FROM meta GROUP BY subreddit)
    SELECT feature, round(coefficient, 6) AS coefficient, side FROM (
      (SELECT *, 'smallest' AS side FROM c ORDER BY coefficient, feature LIMIT 4) UNION ALL
      (SELECT *, 'largest' AS side FROM c ORDER BY coefficient DESC, feature LIMIT 4))""",
)
def given_extremes(spark: SparkSession, sf: str) -> DataFrame:
    table = st.posts_meta(spark, sf).groupBy(F.col("subreddit").alias("feature")).agg(F.avg("score").alias("coefficient"))
    return regress.smallest_and_largest(table, 4)
