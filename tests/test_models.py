"""Topics, classifiers, regressions and segments on planted data."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from forumlens.ml import balance, classify, evaluate, features, regress, segment
from forumlens.operators import topics as tp
from forumlens.plans import models
from forumlens.session import stage

THEMES = {0: "gpu model train loss batch".split(), 1: "bread oven flour yeast dough".split()}


def themed(spark, n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        theme = i % 2
        words = [rng.choice(THEMES[theme]) for _ in range(30)]
        rows.append((f"p{i}", ["OpenAI", "datascience"][theme], f"u{i % 20}", words, " ".join(words), 20 if theme else 2))
    return spark.createDataFrame(
        rows, "id string, subreddit string, author string, tokens array<string>, text string, score bigint"
    )


@pytest.fixture(scope="module")
def topic_model(spark):
    df = themed(spark).cache()
    model = tp.fit_topics(df, "tokens", k=2, min_df=2, max_iter=40)
    return model, model.transform(df).cache()


def test_topics_find_planted_themes(topic_model):
    model, documents = topic_model
    terms = {r["topic"]: set(r["terms_words"]) for r in tp.topic_terms(model, 5).collect()}
    assert sorted(map(sorted, terms.values())) == sorted(sorted(t) for t in THEMES.values())
    counted = {r["topic"]: r["count"] for r in tp.labelled_counts(tp.topic_terms(model, 5), tp.topic_counts(tp.with_dominant_topic(documents))).collect()}
    assert sum(counted.values()) == 300 and set(counted.values()) == {150}
    matrix = tp.community_matrix(tp.topic_counts(tp.with_dominant_topic(documents), ["subreddit"]), 2).collect()
    assert all({r["T0"], r["T1"]} == {0, 150} for r in matrix)
    ranks = tp.term_matrix(tp.topic_terms(model, 5), 7).first()
    assert ranks["Rank6"] == ranks["Rank7"] == 0.0 and ranks["Rank1"] >= ranks["Rank2"]


def test_dominant_topic_takes_the_first_of_ties(spark):
    df = spark.createDataFrame([(Vectors.dense([0.2, 0.4, 0.4]),)], ["topicDistribution"])
    assert tp.with_dominant_topic(df).first()["dominant_topic"] == 1


def test_engagement_classifier_beats_chance(topic_model):
    _, documents = topic_model
    posts = documents.select("id", "subreddit", "score", "text", "topicDistribution").withColumns(
        {"day_of_week": F.lit(1), "hour": F.lit(3), "text_length": F.length("text"),
         "label_binary": (F.col("score") >= 8).cast("double")}
    )
    fitted = classify.fit_engagement(posts, min_df=2)
    metrics = {r["metric"]: r["value"] for r in evaluate.binary_metrics(classify.predict(fitted)["LogisticRegression"]).collect()}
    assert set(metrics) == {"roc_auc", "pr_auc", "accuracy", "f1"} and min(metrics.values()) > 0.95
    words = classify.word_coefficients(fitted).collect()
    assert {r["term"] for r in words if r["coef"] > 0} == set(THEMES[1])
    assert words == sorted(words, key=lambda r: (-r["abs_coef"], r["term"]))
    fits = regress.fit_lasso_sweep(posts, min_df=2)
    table = {r["reg_param"]: r for r in regress.sweep_metrics(fits).collect()}
    assert set(table) == {0.1, 0.05, 0.2} and all(r["rmse"] < 3 and r["r2"] > 0.8 for r in table.values())
    blocks = regress.coefficient_blocks(fits[0.1]).groupBy("block").count().collect()
    assert {r["block"]: r["count"] for r in blocks} == {"word": 10, "topic": 2, "meta": 3}


def test_split_keeps_copies_together(spark):
    df = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("id"))
    train, test = features.split(df)
    assert train.join(test, "id").count() == 0
    assert train.count() + test.count() == 5000
    assert 0.75 < train.count() / 5000 < 0.85


def test_balance_hits_targets_and_repeats(spark):
    df = spark.range(20000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 20 == 0, "Creative AI").when(F.col("id") % 20 == 1, "Text AI").otherwise("Other").alias("ai_category"),
    )
    out = balance.balance(df, caps={"Other": 2000}, floors={"Creative AI": 2500})
    counts = {r["ai_category"]: r["n"] for r in balance.class_counts(out).collect()}
    assert counts["Text AI"] == 1000
    assert abs(counts["Other"] - 2000) < 200 and abs(counts["Creative AI"] - 2500) < 100
    again = balance.balance(df.repartition(9), caps={"Other": 2000}, floors={"Creative AI": 2500})
    assert out.select("id", "copy").exceptAll(again.select("id", "copy")).count() == 0


def test_class_metrics_match_hand_computed(spark):
    rows = [(0.0, 0.0)] * 6 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 1 + [(1.0, 0.0)] * 3 + [(2.0, 0.0)] * 2
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = evaluate.class_metrics(evaluate.confusions({"m": df})).first()
    p0, r0, p1, r1 = 6 / 11, 6 / 8, 1 / 3, 1 / 4
    f = lambda p, r: 2 * p * r / (p + r)
    assert got["accuracy"] == pytest.approx(7 / 14)
    assert got["weighted_precision"] == pytest.approx((8 * p0 + 4 * p1) / 14)
    assert got["weighted_recall"] == pytest.approx(7 / 14)
    assert got["f1"] == pytest.approx((8 * f(p0, r0) + 4 * f(p1, r1)) / 14)


def test_regression_table(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 5.0)], "score double, prediction double")
    row = evaluate.regression_table(df).first()
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3)) and row["mae"] == pytest.approx(1.0)
    assert row["r2"] == pytest.approx(1 - 5 / 2)
    same = evaluate.regression_metrics(df)
    assert same["rmse"] == pytest.approx(row["rmse"]) and same["r2"] == pytest.approx(row["r2"])


def numeric(df):
    return df.withColumns({c: F.lit(1.0) for c in features.SCORE_NUMERIC})


def test_linear_and_ridge(spark):
    df = numeric(themed(spark))
    linear = regress.fit_linear(df, min_df=2)
    assert evaluate.regression_table(linear.predictions()).first()["rmse"] < 2
    ridge = regress.fit_ridge(df, min_df=2, max_df=1.0)
    longer = regress.fit_ridge(df, min_df=2, max_df=1.0, max_iter=20_000)
    one, two = (regress.extreme_coefficients(fit, 10).collect() for fit in (ridge, longer))
    assert [(r["feature"], r["side"]) for r in one] == [(r["feature"], r["side"]) for r in two]
    assert [r["coefficient"] for r in one] == pytest.approx([r["coefficient"] for r in two], rel=1e-4)
    assert not ridge.train.schema["features"].metadata
    with pytest.raises(RuntimeError, match="converge"):
        regress.fit_ridge(df, min_df=2, max_df=1.0, max_iter=2)
    ends = regress.extreme_coefficients(ridge, 3).collect()
    assert len(ends) == 6
    low = {r["feature"] for r in ends if r["side"] == "smallest"}
    assert "subreddit_OpenAI" in low


def test_ridge_solver_splits_rows_over_tasks(spark):
    words = F.array(F.concat(F.lit("w"), F.col("id") % 3), F.concat(F.lit("v"), F.col("id") % 2))
    df = numeric(spark.range(0, 30_000, 1, 4).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 5).alias("score"), words.alias("tokens"),
        F.when(F.col("id") % 2 == 0, "OpenAI").otherwise("GPT4").alias("subreddit"),
    ))
    assert regress.fit_ridge(df, min_df=2, max_df=1.0).train.rdd.getNumPartitions() == 2


def test_classifiers_and_importance(spark):
    df = themed(spark).select(
        "id", F.when(F.col("subreddit") == "OpenAI", "Text AI").otherwise("Other").alias("ai_category"),
        F.col("tokens").alias("words"), *[F.lit(1.0).alias(c) for c in features.NUMERIC if c != "score"], F.lit(1.0).alias("score"),
    )
    prepared = classify.fit_featurizer(df, vocabulary=True, min_df=2)
    fitted = classify.fit_classifiers(prepared, hidden=(4,), mlp_iter=20, trees=5, depth=3)
    metrics = evaluate.class_metrics(evaluate.confusions(classify.predict(fitted))).collect()
    assert {r["model"] for r in metrics} == {"LogisticRegression", "RandomForest", "SVM_OneVsRest", "NeuralNetwork"}
    assert all(r["accuracy"] > 0.9 for r in metrics)
    top = classify.feature_importance(fitted, 4)
    assert {r["feature"] for r in top.collect()} <= set(THEMES[0] + THEMES[1])
    labels = classify.decoded(fitted, "RandomForest").select("predicted_label").distinct().collect()
    assert {r[0] for r in labels} == {"Text AI", "Other"}


def test_dampened_counts(spark):
    df = spark.createDataFrame([(Vectors.sparse(5, [1, 4], [1.0, 8.0]),), (Vectors.sparse(5, [], []),)], ["v"])
    got = [r["v"] for r in stage(df.select(regress.dampened(F.col("v")).alias("v")), ["v"]).collect()]
    assert got == [Vectors.sparse(5, [1, 4], [1.0, 1.0 + math.log(8.0)]), Vectors.sparse(5, [], [])]


def test_attached_topics_keep_rows_of_repeated_ids(spark):
    rows = [("p1", "s", "a", "text one", 1), ("p1", "s", "a", "text two", 1), ("p2", "s", "b", "x", 2), ("p2", "s", "b", "x", 2), ("p3", None, None, None, None)]
    posts = spark.createDataFrame(rows, "id string, subreddit string, author string, body string, created_utc bigint")
    weights = tp.with_post_key(posts).withColumn("topicDistribution", F.length("body")).select(*tp.POST_KEY, "topicDistribution")
    got = sorted((r["id"], r["body"] or "", r["topicDistribution"] or 0) for r in tp.attach_topics(posts, weights).collect())
    assert got == [("p1", "text one", 8), ("p1", "text two", 8), ("p2", "x", 1), ("p2", "x", 1), ("p3", "", 0)]


def test_embedding_rows_are_dealt_alike_whatever_the_input_layout(spark):
    df = themed(spark).withColumn("words_clean", F.col("tokens")).select("id", "words_clean")
    layouts = (df.repartition(3), df.coalesce(1), df.repartition(11, "words_clean"))
    found = [[[r["id"] for r in part] for part in features.dealt(x).rdd.glom().collect()] for x in layouts]
    assert found[0] == found[1] == found[2] and len(found[0]) == 8


def test_user_segments(topic_model):
    topics, documents = topic_model
    users = segment.user_topics(documents)
    rows = {r["author"]: r for r in users.collect()}
    assert len(rows) == 20 and rows["u0"]["comment_count"] == 15
    assert rows["u0"]["primary_tool"] == "OpenAI" and rows["u1"]["primary_tool"] is None
    model = segment.fit_clusters(users, k=2)
    names = segment.cluster_names(model, tp.topic_terms(topics, 5))
    assert sorted(names) == [0, 1] and all(n.startswith(f"Cluster {c}: ") for c, n in names.items())
    assert {frozenset(n.split(": ")[1].split(", ")) <= set(THEMES[0]) for n in names.values()} == {True, False}
    clustered = segment.with_clusters(users, model, names)
    profile = {r["cluster"]: r for r in segment.cluster_profile(clustered).collect()}
    assert sorted(r["n_users"] for r in profile.values()) == [10, 10]
    assert {r["top_primary_tool"] for r in profile.values()} == {"OpenAI", None}
    points = segment.projected(clustered)
    assert points.count() == 20 and segment.cluster_centres(points).count() == 2
    assert set(segment.wide_topics(users, 2).columns) == {"author", "topic_0", "topic_1", "comment_count", "primary_tool"}


def test_topic_vectors_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def words(i):
        made.add(1)
        return [f"w{(i * k) % 11}" for k in range(1, 9)]

    df = spark.range(0, 60, 1, 2).select(words("id").alias("tokens"))
    tp.fit_topics(df, "tokens", k=2, min_df=1, max_iter=12)
    assert made.value <= 4 * 60


def test_thresholds_share_features(spark, sf_dir, topic_model, monkeypatch):
    _, documents = topic_model
    posts = documents.withColumns(
        {"score": F.when(F.col("score") == 2, 8).otherwise(F.col("score")), "day_of_week": F.lit(1), "hour": F.lit(3),
         "text_length": F.length("text")}
    ).where("score > 2").withColumn("label_binary", F.lit(1.0))
    asked = []
    monkeypatch.setattr(models, "_FITS", {})
    monkeypatch.setattr(models, "_engagement_posts", lambda s, sf, exclude=(), threshold=8: asked.append(exclude) or posts)
    rows = models.engagement_metrics(spark, sf_dir).collect()
    assert asked == [(), ("neoliberal",)]
    assert len(rows) == 16 and {r["threshold"] for r in rows} == {8, 9}
    labels = {t: models._engagement(spark, sf_dir, (), t).train.agg(F.avg("label_binary")).first()[0] for t in (8, 9)}
    assert labels[8] == 1.0 and 0.3 < labels[9] < 0.7
    direct = classify.fit_engagement(posts.withColumn("label_binary", (F.col("score") >= 9).cast("double")))
    apart = direct.models["LogisticRegression"].coefficients.toArray()
    shared = models._engagement(spark, sf_dir, (), 9).models["LogisticRegression"].coefficients.toArray()
    assert abs(apart - shared).max() < 1e-6


def test_dropped_submissions_are_not_cleaned(spark):
    rows = [(f"s{i}", ["AskReddit", "OpenAI", "StableDiffusion"][i % 3], f"a [b] title {i}", None, 1, 2, 1704067200, None) for i in range(60)]
    df = spark.createDataFrame(
        rows, "id string, subreddit string, title string, selftext string, score long, num_comments long, created_utc long, url string"
    )
    out = features.balanced_submissions(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and "regexp_replace" not in plan[plan.index("Join ") :]
    late = balance.balance(features.submission_features(df))
    assert sorted(map(str, out.select(sorted(late.columns)).collect())) == sorted(map(str, late.select(sorted(late.columns)).collect()))


def made_words(spark, made, rows=60):
    @F.udf("array<string>")
    def words(i):
        made.add(1)
        return [f"w{(i * k) % 11}" for k in range(1, 9)]

    return spark.range(0, rows, 1, 2).select(F.col("id").cast("string").alias("id"), words("id").alias("tokens"))


def test_topic_weights_need_no_tokens(spark):
    made = spark.sparkContext.accumulator(0)
    df = made_words(spark, made)
    model, counted = tp.fit_counted(df, "tokens", k=2, min_df=1, max_iter=12)
    before = made.value
    weights = {r["id"]: r["topicDistribution"].toArray() for r in model.weighed(counted).collect()}
    assert made.value == before and counted.columns == ["id", "topic_counts"]
    direct = {r["id"]: r["topicDistribution"].toArray() for r in model.transform(df).collect()}
    assert len(direct) == 60 and all(abs(weights[i] - w).max() < 1e-9 for i, w in direct.items())


def test_terms_are_looked_up_once_for_all_later_steps(spark):
    made = spark.sparkContext.accumulator(0)
    df = made_words(spark, made).withColumnRenamed("tokens", "words").withColumns(
        {"ai_category": F.when(F.col("id") % 2 == 0, "a").otherwise("b"), **{c: F.col("id").cast("double") for c in features.NUMERIC}}
    )
    stages = features.classifier_stages(16)
    model, train, test = features.fit_counted(stages, df)
    got = {r["id"]: (r["features"], r["label"]) for r in train.union(test).collect()}
    assert made.value <= 60
    plain = features.fit(stages, features.split(df)[0])
    want = {r["id"]: (r["features"], r["label"]) for r in plain.transform(df).collect()}
    assert len(got) == 60 and [type(s) for s in model.stages] == [type(s) for s in plain.stages]
    assert all(abs(got[i][0].toArray() - v.toArray()).max() < 1e-9 and got[i][1] == label for i, (v, label) in want.items())


def test_topic_terms_ask_for_no_weights_or_coverage(spark, sf_dir, monkeypatch):
    staged = []
    monkeypatch.setattr(models, "_FITS", {})
    monkeypatch.setattr(models, "stage", lambda df: staged.append(df.columns) or stage(df))
    assert models.topics_lda(spark, sf_dir).count() == 15
    assert [set(c) for c in staged] == [{*tp.POST_KEY, "subreddit", "author", "tokens_final"}]
    assert models.topic_counts(spark, sf_dir).count() == 15 and "topicDistribution" in staged[-1]
    assert models.topics_vocabulary(spark, sf_dir).first()["terms_kept"] > 0 and len(staged) == 2
