"""Feature columns and featurising pipelines of the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    NGram,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import categories, scores, text, time
from forumlens.ml import balance
from forumlens.operators.text import default_stop_words
from forumlens.session import stage

NUMERIC = ["hour_of_day", "text_length", "word_count", "has_url", "score", "num_comments"]
SCORE_NUMERIC = [
    "token_count", "controversiality", "gilded", "hour_of_day", "day_of_week", "is_weekend", "body_length",
]
TIME_AND_LENGTH = ["day_of_week", "hour", "text_length"]


def split(df: DataFrame, train: float = 0.8, seed: int = 42, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key. A recomputed partition falls on the same side again,
    and all copies of a key stay together."""
    u = scores.unit_hash(F.col(key), seed)
    return df.where(u < train), df.where(u >= train)


def with_label(df: DataFrame) -> DataFrame:
    """Category label of submissions; no text is read for it."""
    return df.withColumn("ai_category", categories.by_folded_name())


def submission_features(df: DataFrame) -> DataFrame:
    """Category label, cleaned text and numeric columns of submissions."""
    return (
        with_label(df)
        .withColumn("processed_text", text.clean_brackets(text.submission_text()))
        .withColumn("words", text.tokens_space(F.col("processed_text")))
        .withColumn("text_length", F.length("processed_text"))
        .withColumn("word_count", F.size(F.split("processed_text", text.SPACES)))
        .withColumn("hour_of_day", time.hour_of_day())
        .withColumn("has_url", F.col("url").isNotNull().cast("int"))
        .withColumn("score", F.coalesce("score", F.lit(0).cast("long")))
        .withColumn("num_comments", F.coalesce("num_comments", F.lit(0).cast("long")))
    )


def balanced_submissions(submissions: DataFrame) -> DataFrame:
    """Submission features with balanced classes.

    Rows that the caps drop go before any text is cleaned, and a row is cleaned once for all its copies.
    """
    return balance.repeated(submission_features(balance.with_copies(with_label(submissions))))


def comment_features(
    df: DataFrame,
    communities: Sequence[str] = tuple(vocab.AI_CORE_COMMUNITIES),
    exclude: Sequence[str] = (),
    more_than: int = 30,
    threshold: int = 8,
) -> DataFrame:
    """Comments of the chosen communities with text, time, length and engagement columns."""
    wanted = [c for c in communities if c not in set(exclude)]
    body = F.col("body")
    return (
        df.where(F.col("subreddit").isin(*wanted) & (F.length(body) > more_than) & F.col("score").isNotNull())
        .withColumn("text", body)
        .withColumn("day_of_week", time.day_of_week())
        .withColumn("hour", time.hour_of_day())
        .withColumn("text_length", F.length(body))
        .withColumn("label_binary", scores.engaged(F.col("score"), threshold))
    )


def score_features(df: DataFrame) -> DataFrame:
    """Hour, weekday, weekend flag and length of the cleaned comments."""
    return (
        df.withColumn("created_ts", time.created_ts())
        .withColumn("hour_of_day", time.hour_of_day())
        .withColumn("day_of_week", time.day_of_week())
        .withColumn("is_weekend", time.is_weekend())
        .withColumn("body_length", F.length("cleaned"))
    )


def log_score_features(df: DataFrame) -> DataFrame:
    """Clipped and logged score, logged length and surface features of comment text."""
    return df.withColumns(
        {
            "score_clipped": scores.clipped(F.col("score")).cast("double"),
            "score_log": scores.log_score(F.col("score")),
            "text_length_log": F.log1p("text_length"),
            **text.surface_features(F.col("text")),
        }
    )


def with_words(
    df: DataFrame, extra_stop_words: Sequence[str] = tuple(vocab.MODEL_STOP_WORDS), column: str = "text"
) -> DataFrame:
    """Tokens on non-word characters without stop words, as `words_clean`."""
    stops = default_stop_words(extra_stop_words, False)
    return df.withColumn("words_clean", text.without_stop_words(text.tokens_regex(F.col(column)), stops))


def tfidf_stages(column: str = "words_clean", vocab_size: int = 8000, min_df: float = 50) -> list:
    """Vocabulary counts and IDF weights, as `tfidf_features`."""
    return [
        CountVectorizer(inputCol=column, outputCol="tf_features", vocabSize=vocab_size, minDF=min_df),
        IDF(inputCol="tf_features", outputCol="tfidf_features"),
    ]


def engagement_stages(vocab_size: int = 8000, min_df: float = 50) -> list:
    """TF-IDF, topic weights, time and length in one vector."""
    return [
        *tfidf_stages("words_clean", vocab_size, min_df),
        VectorAssembler(
            inputCols=["tfidf_features", "topicDistribution", *TIME_AND_LENGTH], outputCol="features"
        ),
    ]


def dealt(df: DataFrame, rows_each: int = 20_000, least: int = 8) -> DataFrame:
    """Rows dealt by a hash of the id to partitions of about `rows_each`, in a fixed order: the same ones on any cluster."""
    partitions = max(least, -(-df.count() // rows_each))
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "long", "integer", "double")]
    return df.repartition(partitions, "id").sortWithinPartitions("id", F.xxhash64(*plain))


def embedding_stages(embedding: str = "mean_vector") -> list:
    """Mean word vector, topics, one-hot time and surface features in one vector."""
    return [
        StringIndexer(
            inputCols=["day_of_week", "hour"], outputCols=["day_of_week_idx", "hour_idx"], handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=["day_of_week_idx", "hour_idx"], outputCols=["day_of_week_oh", "hour_oh"], dropLast=False
        ),
        VectorAssembler(
            inputCols=[
                embedding, "topicDistribution", "day_of_week_oh", "hour_oh", "text_length_log",
                "has_question", "has_url", "exclamation_count", "uppercase_ratio",
            ],
            outputCol="features",
        ),
    ]


def classifier_stages(
    features: int = 1000, vocabulary: bool = False, min_df: float = 5, numeric: Sequence[str] = tuple(NUMERIC)
) -> list:
    """Numeric columns and TF-IDF, scaled by standard deviation, with an indexed label.

    Hashed terms by default; `vocabulary=True` keeps the words, for feature names.
    """
    terms = (
        CountVectorizer(inputCol="words", outputCol="tf_features", vocabSize=features, minDF=min_df)
        if vocabulary
        else HashingTF(inputCol="words", outputCol="tf_features", numFeatures=features)
    )
    return [
        terms,
        IDF(inputCol="tf_features", outputCol="text_features"),
        VectorAssembler(inputCols=[*numeric, "text_features"], outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
        StringIndexer(
            inputCol="ai_category", outputCol="label", handleInvalid="skip", stringOrderType="frequencyDesc"
        ),
    ]


def score_stages(vocab_size: int = 1 << 18, min_df: float = 5) -> list:
    """Word counts, one-hot community and the seven numeric columns."""
    return [
        CountVectorizer(inputCol="tokens", outputCol="text_features", vocabSize=vocab_size, minDF=min_df),
        StringIndexer(inputCol="subreddit", outputCol="subreddit_index", handleInvalid="keep"),
        OneHotEncoder(inputCols=["subreddit_index"], outputCols=["subreddit_ohe"]),
        VectorAssembler(inputCols=["text_features", "subreddit_ohe", *SCORE_NUMERIC], outputCol="features"),
    ]


def with_bigrams(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """`terms`: the tokens followed by their bigrams."""
    pairs = NGram(n=2, inputCol=tokens, outputCol="_pairs").transform(df)
    return pairs.withColumn("terms", F.concat(F.col(tokens), F.col("_pairs"))).drop("_pairs")


def fit(stages: Sequence, df: DataFrame) -> PipelineModel:
    return Pipeline(stages=list(stages)).fit(df)


def fit_counted(stages: Sequence, tokens: DataFrame) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The steps fitted on the training rows of `tokens`, and the features of both sides, still to be staged.

    The first step counts terms. The counts are staged in place of the tokens and the later steps are fitted on them, so
    words are looked up once per row and not once per step; a first step that needs no fit reads the tokens only once.
    """
    first, *rest = stages
    counter = fit([first], split(tokens)[0]) if isinstance(first, Estimator) else PipelineModel([first])
    train, test = split(stage(counter.transform(tokens).drop(first.getInputCol())))
    fitted = fit(rest, train)
    return PipelineModel([*counter.stages, *fitted.stages]), fitted.transform(train), fitted.transform(test)
