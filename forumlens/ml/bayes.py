"""Sentiment by counts: negation-scoped words and word pairs, chosen by mutual information, weighed by naive Bayes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that turn round what follows, up to SCOPE words or the next mark.
NEGATORS = ("no", "not", "never", "none", "nothing", "without", "cannot", "can't", "don't", "doesn't", "isn't", "won't", "didn't")
SCOPE = 3
MARKS = (".", "!", "?", ",", ";", ":")
#: Features a model has at most; it is broadcast.
MAX_FEATURES = 2000


def with_features(df: DataFrame, text: str = "text", negators: Sequence[str] = NEGATORS) -> DataFrame:
    """`features`: the different words of a text, those in the scope of a negator as `not_word`, and pairs of neighbours
    with no mark between them as `word word`. Words are ASCII letters and apostrophes, lower-cased; null texts have none."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit("[a-z']+|[.!?,;:]"), F.lit(0))

    def marked(token: Column, at: Column) -> Column:
        before = [F.get("_tokens", at - k) for k in range(1, SCOPE + 1)]
        turned, clear = F.lit(False), F.lit(True)
        for word in before:
            turned = turned | (clear & F.coalesce(word.isin(*negators), F.lit(False)))
            clear = clear & F.coalesce(~word.isin(*MARKS), F.lit(False))
        return F.when(token.isin(*MARKS), "").when(turned, F.concat(F.lit("not_"), token)).otherwise(token)

    def pair(word: Column, at: Column) -> Column:
        other = F.get("_words", at + 1)
        return F.when((word != "") & (other != ""), F.concat_ws(" ", word, other)).otherwise("")

    words = df.withColumn("_tokens", tokens).withColumn("_words", F.transform("_tokens", marked))
    both = F.filter(F.concat("_words", F.transform("_words", pair)), lambda w: w != "")
    found = F.coalesce(F.array_distinct(both), F.array().cast("array<string>"))
    return words.withColumn("features", found).drop("_tokens", "_words")


def _exploded(df: DataFrame, *columns: str | Column) -> DataFrame:
    """One row a feature. The outer form, as the inner one's filter on the list would be pushed below it and work the
    whole list out again for each of its tokens."""
    return df.select(*columns, F.explode_outer("features").alias("feature")).where("feature IS NOT NULL")


def fit(df: DataFrame, label: str = "label", max_features: int = MAX_FEATURES, min_count: int = 3) -> DataFrame:
    """The model as a table: feature, n1 and n0 (texts of each class that have it), mi, weight and without.

    Counts are one grouped sum over the features of all texts. The features with the highest mutual information with the
    class are kept, ties by name, from those in `min_count` texts or more. `weight` is the log ratio of the smoothed
    chances that a text of class 1 and one of class 0 has the feature, `without` that it has not. Rows without a label
    are left out; a null text counts as one without features. With one class only there are no features.
    """
    known = df.where(F.col(label).isNotNull())
    positive = F.col(label) == 1
    n1, n0 = (known.agg(F.count_if(c)).scalar() for c in (positive, ~positive))
    counts = _exploded(known, positive.alias("positive")).groupBy("feature").agg(
        F.count_if("positive").alias("n1"), F.count_if(~F.col("positive")).alias("n0")
    )
    counts = counts.where(F.col("n1") + F.col("n0") >= min_count).select("*", n1.alias("all1"), n0.alias("all0"))
    total = (F.col("all1") + F.col("all0")).cast("double")

    def part(both: Column, left: Column, right: Column) -> Column:
        chance = F.try_divide(both * total, left * right)
        return F.when(both > 0, both / total * F.log(chance)).otherwise(0.0)

    has, hasnt = F.col("n1") + F.col("n0"), F.col("all1") + F.col("all0") - F.col("n1") - F.col("n0")
    mi = (
        part(F.col("n1"), has, F.col("all1")) + part(F.col("n0"), has, F.col("all0"))
        + part(F.col("all1") - F.col("n1"), hasnt, F.col("all1")) + part(F.col("all0") - F.col("n0"), hasnt, F.col("all0"))
    )
    p1, p0 = (F.col("n1") + 1) / (F.col("all1") + 2), (F.col("n0") + 1) / (F.col("all0") + 2)
    rated = counts.where((F.col("all1") > 0) & (F.col("all0") > 0)).withColumn("mi", mi)
    # Rounded, so that equal features are tied whatever the order of their sums.
    best = rated.orderBy(F.round("mi", 12).desc(), "feature").limit(max_features)
    return best.select(
        "feature", "n1", "n0", "mi", F.log(p1 / p0).alias("weight"), F.log((1 - p1) / (1 - p0)).alias("without"),
        F.log((F.col("all1") + 1) / (F.col("all0") + 1)).alias("prior"),
    )


def score(df: DataFrame, model: DataFrame, key: str, label: str = "sentiment_model") -> DataFrame:
    """`df` with `log_odds` of class 1 and `label`: positive above 0, negative below, neutral at 0 or without a model.

    `key` names rows. Only features of the model leave a row, and are summed by key; the model has at most
    MAX_FEATURES rows, so it is broadcast.
    """
    base = model.agg((F.max("prior") + F.sum("without")).alias("b"))
    held = _exploded(df, key).join(
        F.broadcast(model.select("feature", (F.col("weight") - F.col("without")).alias("gain"))), "feature"
    )
    sums = held.groupBy(key).agg(F.sum("gain").alias("gain"))
    odds = F.coalesce(base.scalar(), F.lit(0.0)) + F.coalesce("gain", F.lit(0.0))
    scored = df.join(sums, key, "left").withColumn("log_odds", odds).drop("gain")
    sign = F.when(F.col("log_odds") > 0, "positive").when(F.col("log_odds") < 0, "negative").otherwise("neutral")
    return scored.withColumn(label, sign)
