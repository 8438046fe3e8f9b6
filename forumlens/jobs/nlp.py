"""Sentiment, emotion, profanity, benefit and topic tables of a filtered archive.

    spark-submit forumlens/jobs/nlp.py SOURCE TARGET --positive P.txt --negative N.txt --profane F.txt\n        [--survey S.csv]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import text
from forumlens.operators import lexicon as lx
from forumlens.operators import text as tx
from forumlens.operators import topics as tp
from forumlens.session import build_session, drop_staged, stage
from forumlens.sources import readers, writers


def tables(
    spark: SparkSession, source: str, positive: Sequence[str], negative: Sequence[str], profane: Sequence[str],
    survey: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Lexicon tables by name, each lazy."""
    posts = tx.with_text(
        readers.unify(
            readers.read_parquet(spark, f"{source}/comments"), readers.read_parquet(spark, f"{source}/submissions")
        )
    )
    light = tx.with_kept(posts, "processed_text", text.clean_light(F.col("text")), lambda c: F.length(c) > 0)
    by_period = lx.sentiment_by_period(lx.with_ai_category(lx.with_sentiment_weighted(light, positive, negative)))
    # One cleaning and tokenising pass serves the five tables below.
    kept = ["id", "subreddit", "author", "score", "created_utc", "tokens", "token_count"]
    tokens = stage(tx.with_tokens(tx.cleaned(posts), "cleaned", tx.default_stop_words()).select(*kept))
    out = {
        "sentiment_by_period": by_period,
        "sentiment_category_periods": lx.category_periods(by_period),
        "sentiment_overview": lx.sentiment_overview(by_period),
        "emotion_by_tool": lx.emotion_by_tool(lx.with_emotion(lx.with_tool(tokens))),
        "emotion_profile": lx.emotion_profile(lx.with_emotion_vector(posts)),
        "profanity_rate": lx.profanity_rate(tokens, profane),
        "profanity_top": lx.profanity_top(tokens, profane),
        "monthly_tokens": lx.monthly_tokens(tokens),
        "token_profile": tx.token_profile(tokens),
    }
    if survey is not None:
        measured = lx.benefit_percentages(lx.with_benefit_flags(tokens))
        out["benefit_vs_survey"] = lx.benefit_vs_survey(measured, survey)
    return out


def topic_tables(spark: SparkSession, source: str, exclude: Sequence[str] = (), min_df: float = 50) -> dict[str, DataFrame]:
    """Topic tables over the core communities; `document_topics` is the input of the model job."""
    wanted = [c for c in vocab.AI_CORE_COMMUNITIES if c not in set(exclude)]
    comments = readers.allow_communities(readers.read_parquet(spark, f"{source}/comments"), wanted)
    stops = tx.default_stop_words(vocab.TOPIC_STOP_WORDS)
    kept = [*tp.POST_KEY, "subreddit", "author"]
    documents = stage(tp.with_post_key(tx.topic_documents(comments, stops)).select(*kept, "tokens_final"))
    model = tp.fit_topics(documents, min_df=min_df)
    topics = stage(model.transform(documents).select(*kept, "topicDistribution"))
    dominant = tp.with_dominant_topic(topics)
    terms, counts = tp.topic_terms(model), tp.topic_counts(dominant)
    by_community = tp.topic_counts(dominant, ["subreddit"])
    return {
        "document_topics": topics,
        "topic_terms": terms,
        "topic_counts": tp.labelled_counts(terms, counts),
        "topic_by_community": by_community,
        "topic_community_matrix": tp.community_matrix(by_community, model.k),
        "topic_term_matrix": tp.term_matrix(terms),
        "topic_vocabulary": tp.vocabulary_coverage(documents, "tokens_final", model.vectorizer.vocabulary),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--positive", required=True)
    parser.add_argument("--negative", required=True)
    parser.add_argument("--profane", required=True)
    parser.add_argument("--survey")
    args = parser.parse_args()
    spark = build_session("forumlens-nlp")
    words = [readers.word_list_values(readers.read_word_list(spark, p)) for p in (args.positive, args.negative, args.profane)]
    survey = readers.read_survey(spark, args.survey) if args.survey else None
    results = {**tables(spark, args.source, *words, survey), **topic_tables(spark, args.source)}
    for name, df in results.items():
        writers.write_parquet(df, f"{args.target}/{name}")
    drop_staged(spark)


if __name__ == "__main__":
    main()
