"""Histories, keyword velocity and areas under curves against Python and MLlib."""

import datetime as dt
import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from forumlens.ml import evaluate
from forumlens.operators import history, velocity

SCHEMA = "event_id long, author string, created_utc long, score long"


def digits(value):
    return float(f"{value:.11g}")


def brute_history(rows, event):
    _, author, at, _ = event
    earlier = [] if author is None or at is None else [r for r in rows if r[1] == author and r[2] is not None and r[2] < at]
    values = [r[3] for r in earlier if r[3] is not None]
    return (
        len(earlier),
        digits(statistics.fmean(values)) if values else None,
        digits(statistics.stdev(values)) if len(values) > 1 else None,
        at - max(r[2] for r in earlier) if earlier else None,
    )


def rounded(row):
    return tuple(digits(v) if isinstance(v, float) else v for v in row)


def test_author_history_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(900):
        author = rng.choice(["hot", "hot", "a", "b", "c", None])
        at = rng.choice([rng.randint(-200_000, 400_000), 86400 * rng.randint(0, 3), None if rng.random() < 0.1 else 7])
        rows.append((k, author, at, rng.choice([None, rng.randint(-50, 10**9)])))
    rows += [rows[0]] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    got = history.author_history(df)
    assert got.columns == ["event_id", "author", "created_utc", "score", "n_before", "avg_before", "sd_before", "seconds_since_last"]
    want = Counter((*r, *brute_history(rows, r)) for r in rows)
    assert Counter(rounded(r) for r in got.collect()) == want


def test_history_of_other_times(spark):
    rows = [(1, "a", 100, 4), (2, "a", 100, 8), (3, "a", 90_000, 1)]
    probes = spark.createDataFrame([("a", 100), ("a", 101), ("a", 200_000), ("b", 5), (None, 5), ("a", 200_000)], "author string, created_utc long")
    got = history.history_before(spark.createDataFrame(rows, SCHEMA), probes).select("author", "created_utc", "n_before", "avg_before").collect()
    assert Counter(map(tuple, got)) == Counter(
        [("a", 100, 0, None), ("a", 101, 2, 6.0), ("a", 200_000, 3, 13 / 3), ("a", 200_000, 3, 13 / 3), ("b", 5, 0, None), (None, 5, 0, None)]
    )
    assert history.author_history(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_window_holds_an_authors_rows(spark):
    plan = history.author_history(spark.createDataFrame([(1, "a", 1, 1)], SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    specs = [line for line in plan.split("\n") if "Window [" in line]
    # One window by author over days that are summed before, one by author and day over seconds.
    assert len(specs) == 2
    assert sorted("day" in line[line.index("windowspecdefinition(") :].split(" ASC")[0] for line in specs) == [True, True]
    assert "Aggregate [author#" in plan


def test_velocity_counts_empty_days_and_finds_surges(spark):
    first = dt.date(2024, 1, 1)
    posts = [(first + dt.timedelta(days=k), "calm words") for k in range(0, 80, 3)]
    posts += [(first + dt.timedelta(days=60 + k % 2), "Surge, surge! surge_") for k in range(40)] + [(first, None), (first, "")]
    posts += [(first + dt.timedelta(days=k), "surge") for k in (1, 20, 30)]
    df = spark.createDataFrame(posts, "date date, text string")
    groups = {"surge": ["surge"], "calm": ["calm"], "none": ["nothing"]}
    counts = velocity.keyword_counts(df, F.split(F.lower("text"), "[^a-z]+"), groups)
    assert {(r.n_posts, r.n_uses) for r in counts.where("keyword = 'surge' AND day >= '2024-03-01'").collect()} == {(20, 60)}
    filled = velocity.fill_days(counts, list(groups), df.select(F.col("date").alias("day")))
    days = (max(d for d, _ in posts) - first).days + 1
    assert filled.count() == 3 * days
    speeds = velocity.velocity(filled)
    by_day = {(r.keyword, r.day): r for r in speeds.collect()}
    daily = Counter(d for d, t in posts if t and "urge" in t)
    sums = [sum(daily[first + dt.timedelta(days=k - j)] for j in range(7)) for k in range(days)]
    for k in range(days):
        row = by_day["surge", first + dt.timedelta(days=k)]
        change = sums[k] - sums[k - 7] if k >= 13 else None
        past = [sums[j] - sums[j - 7] for j in range(13, k)]
        spread = statistics.stdev(past) if len(past) >= 14 else 0
        assert (row.in_window, row.velocity) == (sums[k], change)
        assert row.z_score is None if not spread else math.isclose(row.z_score, (change - statistics.fmean(past)) / spread)
    assert all(r.in_window == 0 and r.z_score is None for (k, _), r in by_day.items() if k == "none")
    found = velocity.alerts(speeds, 3.0).collect()
    assert [(r.keyword, r.first_day) for r in found] == [("surge", first + dt.timedelta(days=60))]
    assert velocity.velocity(velocity.fill_days(counts, ["x"], df.where("date IS NULL").select(F.col("date").alias("day")))).count() == 0


@pytest.mark.parametrize("steps", [3, 40, 100_000])
def test_areas_equal_mllib(spark, steps):
    rng = random.Random(steps)
    rows = [(float(rng.random() < 0.3), rng.randrange(steps) / 7 - 2) for _ in range(3000)]
    rows = [(y, s + y * steps / 30) for y, s in rows]
    df = spark.createDataFrame(rows, "label_binary double, score double").repartition(5)
    got = evaluate.ladder_areas(evaluate.score_ladder(df.union(spark.createDataFrame([(None, 1.0), (1.0, None)], df.schema)), "score")).first()
    raw = df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), "score")))
    for name, value in (("areaUnderROC", got.roc_auc), ("areaUnderPR", got.pr_auc)):
        assert math.isclose(value, BinaryClassificationEvaluator(labelCol="label_binary", metricName=name, numBins=0).evaluate(raw), rel_tol=1e-9)
    assert got.n_positive + got.n_negative == 3000


def test_areas_without_both_classes(spark):
    one = spark.createDataFrame([(1.0, 0.5), (1.0, 0.2)], "label_binary double, score double")
    assert tuple(evaluate.ladder_areas(evaluate.score_ladder(one, "score")).first()) == (2, 0, None, 1.0)
    assert tuple(evaluate.ladder_areas(evaluate.score_ladder(one.where("score > 9"), "score")).first()) == (0, 0, None, None)
