"""Naive Bayes sentiment against counts in Python, and better than the sign of a lexicon score where words decide."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from forumlens.ml import bayes


def brute_features(text):
    tokens = re.findall(r"[a-z']+|[.!?,;:]", (text or "").lower())
    words, left = [], 0
    for t in tokens:
        words.append(None if t in bayes.MARKS else "not_" + t if left else t)
        left = 0 if t in bayes.MARKS else bayes.SCOPE if t in bayes.NEGATORS else max(0, left - 1)
    return {w for w in words if w} | {f"{a} {b}" for a, b in zip(words, words[1:]) if a and b}


def reviews(rng, n):
    rows = []
    for k in range(n):
        label = int(rng.random() < 0.6)
        words = [rng.choice(["film", "it", "was", "the", "plot"]) for _ in range(12)]
        # The same word says the opposite behind a negator.
        words.insert(rng.randrange(12), "good" if label else "not very good")
        words.insert(rng.randrange(13), rng.choice([".", ",", "!", "Great!" if label else "awful;", "bad"]))
        rows.append((k, " ".join(words), label))
    return rows


def test_features_match_python(spark):
    rng = random.Random(1)
    words = [*bayes.NEGATORS[:4], *bayes.MARKS, "good", "Bad", "it's", "12", "é", "\n"]
    texts = [None, "", "...", "not", "not good", "never, ever"] + [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = bayes.with_features(df).collect()
    assert all(len(r.features) == len(set(r.features)) and set(r.features) == brute_features(r.text) for r in got)


def test_model_matches_counts(spark):
    rows = reviews(random.Random(2), 300)
    model = bayes.fit(bayes.with_features(spark.createDataFrame([*rows, (999, "x", None)], "id long, text string, label int")), max_features=50)
    found = {r.feature: r for r in model.collect()}
    n1, n0 = (sum(r[2] == v for r in rows) for v in (1, 0))
    has1, has0 = (Counter(f for r in rows if r[2] == v for f in brute_features(r[1])) for v in (1, 0))

    def mi(f):
        cells = [(has1[f], n1, has1[f] + has0[f]), (has0[f], n0, has1[f] + has0[f])]
        cells += [(n1 - has1[f], n1, n1 + n0 - has1[f] - has0[f]), (n0 - has0[f], n0, n1 + n0 - has1[f] - has0[f])]
        return sum(c / (n1 + n0) * math.log(c * (n1 + n0) / (a * b)) for c, a, b in cells if c)

    rated = sorted((f for f in {*has1, *has0} if has1[f] + has0[f] >= 3), key=lambda f: (-round(mi(f), 12), f))
    assert set(found) == set(rated[:50])
    for f, r in found.items():
        p1, p0 = (has1[f] + 1) / (n1 + 2), (has0[f] + 1) / (n0 + 2)
        assert (r.n1, r.n0) == (has1[f], has0[f])
        assert math.isclose(r.weight, math.log(p1 / p0)) and math.isclose(r.without, math.log((1 - p1) / (1 - p0)), abs_tol=1e-12)
        assert math.isclose(r.mi, mi(f), abs_tol=1e-12)


def test_negation_decides_on_held_out_texts(spark):
    df = bayes.with_features(spark.createDataFrame(reviews(random.Random(3), 600), "id long, text string, label int"))
    model = bayes.fit(df.where("id % 5 <> 0"))
    held = bayes.score(df.where("id % 5 = 0"), model, "id").collect()
    right = sum((r.log_odds > 0) == (r.label == 1) for r in held)
    assert len(held) == 120 and right >= 115
    assert {r.sentiment_model for r in held} <= {"positive", "negative", "neutral"}
    assert bayes.score(df, bayes.fit(df.where("label = 1")), "id").where("sentiment_model <> 'neutral'").count() == 0
    assert bayes.fit(df.limit(0)).count() == 0


def test_long_texts_take_one_pass(spark):
    df = bayes.with_features(spark.range(1).select("id", F.repeat(F.lit("not good, it is "), 20_000).alias("text"), F.lit(1).alias("label")))
    assert bayes.score(df, bayes.fit(df), "id").select(F.size("features")).first()[0] == len(brute_features("not good, it is " * 3))
