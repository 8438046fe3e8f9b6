"""Word-list scores over token arrays, evaluated in the JVM.

The operators stage token arrays and hit counts as columns, so each array is walked once per list.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens import vocab


def keep(tokens: Column, words: Sequence[str]) -> Column:
    """The tokens, repeats included, that are in the list."""
    listed = sorted(set(words))
    return F.filter(tokens, lambda t: t.isin(listed))


def hits(tokens: Column, words: Sequence[str]) -> Column:
    """How many tokens are in the list; 0 for NULL or empty tokens."""
    return F.coalesce(F.size(keep(tokens, words)), F.lit(0))


def distinct_hits(tokens: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.size(F.array_distinct(keep(tokens, words))), F.lit(0))


def balance(positive: Column, negative: Column) -> Column:
    """(p - n) / (p + n), 0 when there is no hit."""
    return F.coalesce(F.try_divide(positive - negative, positive + negative), F.lit(0.0))


def stretched_balance(positive: Column, negative: Column, factor: float = 1.2) -> Column:
    """Balance stretched by a factor and limited to [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), balance(positive, negative) * factor))


def alphanumeric(words: Sequence[str]) -> list[str]:
    """Words that can equal an alphanumeric token; the others never count in the weighted score."""
    return [w for w in words if w.isalnum()]


def sentiment_label(score: Column) -> Column:
    """positive / negative / neutral by sign; NULL is neutral."""
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise(vocab.NEUTRAL)


def all_words(keywords: Mapping[str, Sequence[str]]) -> list[str]:
    return sorted({w for words in keywords.values() for w in words})


def top_label(tokens: Column, keywords: Mapping[str, Sequence[str]], default: str = vocab.NEUTRAL) -> Column:
    """Label with most keyword hits, the first listed on ties, `default` without a hit."""
    candidates = [
        F.struct(hits(tokens, words).alias("n"), F.lit(-place).alias("place"), F.lit(label).alias("label"))
        for place, (label, words) in enumerate(keywords.items())
    ]
    best = F.array_max(F.array(*candidates))
    return F.when(best["n"] > 0, best["label"]).otherwise(default)


def label_counts(tokens: Column, lexicon: Mapping[str, Sequence[str]], labels: Sequence[str]) -> Column:
    """Array of hit counts, one per label; a word may count for several labels."""
    words = {label: [w for w, tags in lexicon.items() if label in tags] for label in labels}
    return F.array(*[hits(tokens, words[label]) if words[label] else F.lit(0) for label in labels])


def benefit_slug(name: str) -> str:
    return "cat_" + re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def benefit_flags(tokens: Column, keywords: Mapping[str, Sequence[str]] | None = None) -> dict[str, Column]:
    """One boolean column per benefit: does the post hold any of its keywords?"""
    keywords = keywords or vocab.BENEFIT_KEYWORDS
    return {
        benefit_slug(name): F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))
        for name, words in keywords.items()
    }
