"""Topic models and their tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.operators.text import term_statistics
from forumlens.session import stage


@dataclass(frozen=True)
class TopicModel:
    vectorizer: CountVectorizerModel
    lda: LDAModel
    k: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `topicDistribution`."""
        return self.lda.transform(self.vectorizer.transform(df))

    def weighed(self, counted: DataFrame) -> DataFrame:
        """The same for rows that hold their `topic_counts`, which go."""
        return self.lda.transform(counted).drop("topic_counts")


def fit_topics(
    df: DataFrame,
    tokens: str = "tokens_final",
    k: int = 15,
    max_iter: int = 20,
    vocab_size: int = 10_000,
    min_df: float = 50,
    max_df: float = 1.0,
    seed: int = 42,
) -> TopicModel:
    """Vocabulary and online LDA over token lists.

    The vocabulary is one distributed word count. Each LDA pass draws a mini-batch, and only the
    `k` by vocabulary weights travel; both are bounded by the arguments, not by the corpus.
    """
    return fit_counted(df.select(tokens), tokens, k, max_iter, vocab_size, min_df, max_df, seed)[0]


def fit_counted(
    df: DataFrame,
    tokens: str = "tokens_final",
    k: int = 15,
    max_iter: int = 20,
    vocab_size: int = 10_000,
    min_df: float = 50,
    max_df: float = 1.0,
    seed: int = 42,
) -> tuple[TopicModel, DataFrame]:
    """The model of `fit_topics`, and the staged rows with their counts as `topic_counts` in place of the tokens.

    The counts are made once: every pass reads them, and `weighed` needs no tokens.
    """
    counter = CountVectorizer(inputCol=tokens, outputCol="topic_counts", vocabSize=vocab_size, minDF=min_df)
    if max_df < 1.0:
        counter = counter.setMaxDF(max_df)
    vectorizer = counter.fit(df)
    counted = stage(vectorizer.transform(df).drop(tokens))
    # Every pass reads all vectors, so they are kept: in the order they have, on which the mini-batches depend.
    vectors = counted.select("topic_counts").persist(StorageLevel.MEMORY_AND_DISK)
    lda = LDA(
        k=k, maxIter=max_iter, featuresCol="topic_counts", topicDistributionCol="topicDistribution",
        optimizer="online", seed=seed,
    ).fit(vectors)
    vectors.unpersist()
    return TopicModel(vectorizer, lda, k), counted


def topic_terms(model: TopicModel, n: int = 15) -> DataFrame:
    """Top terms and weights per topic; the words come from a join on the vocabulary."""
    topics = model.lda.describeTopics(n)
    words = topics.sparkSession.createDataFrame(
        list(enumerate(model.vectorizer.vocabulary)), "term_index int, term string"
    )
    flat = topics.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t")).select(
        "topic", "rank", F.col("t.termIndices").alias("term_index"), F.col("t.termWeights").alias("weight")
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term", "weight")))
    return (
        flat.join(words, "term_index")
        .groupBy("topic")
        .agg(ordered.alias("o"))
        .select("topic", F.col("o.term").alias("terms_words"), F.col("o.weight").alias("term_weights"))
    )


def topic_label(terms: Column, n: int = 4) -> Column:
    """The first terms as a label."""
    return F.array_join(F.slice(terms, 1, n), ", ")


def term_matrix(terms: DataFrame, ranks: int = 10) -> DataFrame:
    """Topics as rows, term weights by rank as columns `Rank1`.., 0 where a topic has fewer terms."""
    return terms.select(
        "topic",
        *[F.coalesce(F.get("term_weights", F.lit(i)), F.lit(0.0)).alias(f"Rank{i + 1}") for i in range(ranks)],
    )


def dominant_topic(distribution: str = "topicDistribution") -> Column:
    """Index of the largest weight, the first on ties."""
    weights = vector_to_array(F.col(distribution))
    return F.element_at(
        F.transform(F.array(weights), lambda w: F.array_position(w, F.array_max(w)) - 1), 1
    ).cast("int")


def with_dominant_topic(df: DataFrame) -> DataFrame:
    return df.withColumn("dominant_topic", dominant_topic())


def topic_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Documents per dominant topic, optionally per community."""
    return df.groupBy(*by, "dominant_topic").agg(F.count(F.lit(1)).alias("count"))


def labelled_counts(terms: DataFrame, counts: DataFrame) -> DataFrame:
    """Every topic with its label and document count, 0 when no document has it."""
    labels = terms.select("topic", topic_label(F.col("terms_words")).alias("label"))
    return labels.join(counts.withColumnRenamed("dominant_topic", "topic"), "topic", "left").fillna(0, ["count"])


def community_matrix(counts: DataFrame, k: int) -> DataFrame:
    """Communities as rows, topics `T0`.. as columns, 0 where absent."""
    wide = counts.groupBy("subreddit").pivot("dominant_topic", list(range(k))).agg(F.sum("count")).fillna(0)
    return wide.select("subreddit", *[F.col(f"`{i}`").alias(f"T{i}") for i in range(k)])


POST_KEY = ["id", "post_key"]


def with_post_key(posts: DataFrame) -> DataFrame:
    """`post_key`, a hash of all that tells posts apart. Ids repeat in the archive, with other texts too."""
    return posts.withColumn("post_key", F.xxhash64("id", "subreddit", "author", "created_utc", "body"))


def attach_topics(posts: DataFrame, document_topics: DataFrame) -> DataFrame:
    """Posts with the topic weights of their own text, one row each.

    Posts that share id and key are copies with equal weights, so one of them is enough on the right side.
    """
    weights = document_topics.select(*POST_KEY, "topicDistribution").dropDuplicates(POST_KEY)
    return with_post_key(posts).join(weights, POST_KEY).drop("post_key")


def vocabulary(df: DataFrame, tokens: str, vocab_size: int, min_df: float) -> DataFrame:
    """Every term with its counts, and whether a vocabulary of these limits keeps it.

    The rule of the vectoriser: terms in `min_df` documents or more, the most frequent first. Equal counts at
    the limit go by name here; the vectoriser leaves their order open.
    """
    terms = term_statistics(df, tokens)
    fits = terms.where(F.col("doc_count") >= min_df).orderBy(F.desc("total_count"), "term").limit(vocab_size)
    return terms.join(fits.select("term", F.lit(True).alias("kept")), "term", "left").fillna(False, ["kept"])


def vocabulary_coverage(df: DataFrame, tokens: str, vocabulary_terms: Sequence[str]) -> DataFrame:
    """Terms and tokens in the documents, and how many of them a fitted vocabulary keeps."""
    kept = df.sparkSession.createDataFrame([(t, True) for t in vocabulary_terms], "term string, kept boolean")
    return coverage(term_statistics(df, tokens).join(kept, "term", "left"))


def coverage(terms: DataFrame) -> DataFrame:
    """Terms and tokens seen and kept, and the share of tokens kept."""
    kept = F.coalesce("kept", F.lit(False))
    return terms.agg(
        F.count(F.lit(1)).alias("terms_seen"),
        F.count_if(kept).alias("terms_kept"),
        F.coalesce(F.sum("total_count"), F.lit(0)).alias("tokens_seen"),
        F.coalesce(F.sum(F.when(kept, F.col("total_count"))), F.lit(0)).alias("tokens_kept"),
    ).withColumn("share_kept", F.try_divide("tokens_kept", "tokens_seen"))
