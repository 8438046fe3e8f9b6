"""Engagement, score, community and user models of a filtered archive.

    spark-submit forumlens/jobs/models.py SOURCE TOPICS TARGET

TOPICS is the folder of the language job: its `document_topics` and `topic_terms` tables are read.
"""

from __future__ import annotations

import argparse

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.ml import classify, evaluate, features, regress, segment
from forumlens.operators import text as tx
from forumlens.operators import topics as tp
from forumlens.session import build_session, drop_staged
from forumlens.sources import readers, writers


def engagement(posts: DataFrame, min_df: float = 50) -> tuple[classify.Fitted, dict[str, DataFrame]]:
    """The high-engagement classifier and its tables."""
    fitted = classify.fit_engagement(posts, min_df=min_df)
    predictions = classify.predict(fitted)["LogisticRegression"]
    return fitted, {
        "metrics": evaluate.binary_metrics(predictions),
        "confusion": evaluate.confusion(predictions, "label_binary"),
        "words": classify.word_coefficients(fitted),
        "predictions": predictions.select(
            "id", "subreddit", "score", "label_binary", "prediction", vector_to_array("probability").alias("probability")
        ),
    }


def scores(posts: DataFrame, min_df: float = 50, min_count: int = 20) -> dict[str, DataFrame]:
    """Lasso and boosted-tree regressions of the score."""
    lasso = regress.fit_lasso_sweep(posts, min_df=min_df)
    trees = regress.fit_gbt(features.log_score_features(posts), min_count=min_count)
    return {
        "lasso_metrics": regress.sweep_metrics(lasso),
        "lasso_coefficients": regress.coefficient_blocks(lasso[0.1]),
        "gbt_metrics": evaluate.regression_table(regress.gbt_predictions(trees), "score_clipped", "prediction_score"),
    }


def text_scores(comments: DataFrame, min_df: float = 5, max_iter: int = 5000) -> dict[str, DataFrame]:
    """Linear and ridge regressions of the score on the words."""
    cleaned = tx.cleaned(tx.with_text(comments))
    posts = features.score_features(tx.with_tokens(cleaned, "cleaned", tx.default_stop_words()))
    linear = regress.fit_linear(posts, min_df=min_df)
    ridge = regress.fit_ridge(posts, min_df=min_df, max_iter=max_iter)
    return {
        "linear_metrics": evaluate.regression_table(linear.predictions()),
        "ridge_metrics": evaluate.regression_table(ridge.predictions()),
        "ridge_importance": regress.extreme_coefficients(ridge),
    }


def communities(submissions: DataFrame) -> dict[str, DataFrame]:
    """Community classifiers: compared with fixed parameters, then tuned, with importances and predictions."""
    labelled = features.balanced_submissions(submissions)
    counts = evaluate.confusions(classify.predict(classify.fit_classifiers(classify.fit_featurizer(labelled))))
    tuned, chosen = classify.tune_classifiers(classify.fit_featurizer(labelled, vocabulary=True))
    tuned_counts = evaluate.confusions(classify.predict(tuned))
    params = [(model, str(values)) for model, values in chosen.items()]
    return {
        "confusion": counts,
        "metrics": evaluate.class_metrics(counts),
        "tuned_confusion": tuned_counts,
        "tuned_metrics": evaluate.class_metrics(tuned_counts),
        "tuned_parameters": labelled.sparkSession.createDataFrame(params, "model string, best_params string"),
        "importance": classify.feature_importance(tuned),
        "predictions": readers.stack(*[classify.decoded(tuned, name) for name in sorted(tuned.models)]),
    }


def users(topics: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    """User segments, named by the topics that set them apart."""
    known = segment.user_topics(topics.where(F.col("author").isNotNull()))
    model = segment.fit_clusters(known)
    clustered = segment.with_clusters(known, model, segment.cluster_names(model, terms))
    return {"profile": segment.cluster_profile(clustered), "projected": segment.projected(clustered)}


def _write(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        writers.write_parquet(df, f"{folder}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("topics")
    parser.add_argument("target")
    parser.add_argument("--threshold", type=int, default=8)
    args = parser.parse_args()
    spark: SparkSession = build_session("forumlens-models")
    comments = readers.read_parquet(spark, f"{args.source}/comments")
    submissions = readers.read_parquet(spark, f"{args.source}/submissions")
    topics = readers.read_parquet(spark, f"{args.topics}/document_topics")
    terms = readers.read_parquet(spark, f"{args.topics}/topic_terms")
    out = args.target

    for variant, exclude in (("with", ()), ("without", (vocab.POLITICAL_COMMUNITY,))):
        posts = tp.attach_topics(
            features.comment_features(comments, exclude=exclude, threshold=args.threshold), topics
        )
        fitted, tables = engagement(posts)
        _write(tables, f"{out}/engagement_{variant}")
        writers.save_model(fitted.featurizer, f"{out}/engagement_{variant}/featurizer")
        _write(scores(posts), f"{out}/score_{variant}")
    _write(text_scores(comments), f"{out}/score_text")
    _write(communities(submissions), f"{out}/communities")
    _write(users(topics, terms), f"{out}/users")
    drop_staged(spark)


if __name__ == "__main__":
    main()
