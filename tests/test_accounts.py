"""Signs of automated accounts, lives of submissions and sketches, against Python and planted cases."""

import math
import random
import statistics
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from forumlens.operators import accounts, lifecycle, sketches

SCHEMA = "author string, created_utc long, text string"


def posts_of(rng):
    rows = [("clock", 1_000_000 + 3600 * k + rng.randrange(5), f"report {k}") for k in range(200)]
    rows += [("parrot", 1_000_000 + rng.randrange(10**7), rng.choice(["Buy  now!", "buy NOW", "something else"])) for _ in range(80)]
    rows += [("person", 1_000_000 + rng.randrange(10**7), f"thought {k}") for k in range(150)]
    rows += [("person", 1_000_000, "twice"), ("person", 1_000_000, "twice"), ("once", 5, "x"), ("quick", 9, None), ("quick", 9, None)]
    return rows + [(None, 7, "x"), ("nobody", None, "x")]


def test_planted_accounts_are_found(spark):
    df = spark.createDataFrame(posts_of(random.Random(1)), SCHEMA)
    found = {r.author: r for r in accounts.bot_signals(df, F.col("text")).collect()}
    assert [a for a, r in found.items() if r.periodic] == ["clock"]
    assert [a for a, r in found.items() if r.repetitive] == ["parrot"]
    assert found["parrot"].n_different == 2 and found["clock"].entropy <= 1 and found["person"].entropy > 2


def test_rhythm_matches_python(spark):
    rows = posts_of(random.Random(2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    times = defaultdict(list)
    for author, at, _ in rows:
        if author is not None and at is not None:
            times[author].append(at)
    got = {r.author: r for r in accounts.rhythm(accounts.gap_histogram(df)).collect()}
    want = {a: [y - x for x, y in zip(sorted(t), sorted(t)[1:])] for a, t in times.items() if len(t) > 1}
    assert set(got) == set(want)
    for author, gaps in want.items():
        r = got[author]
        bins = Counter(0 if g < 1 else min(39, g.bit_length()) for g in gaps)
        entropy = -sum(n / len(gaps) * math.log2(n / len(gaps)) for n in bins.values())
        assert r.n_gaps == len(gaps) and math.isclose(r.mean_gap, statistics.fmean(gaps))
        assert math.isclose(r.entropy, entropy, abs_tol=1e-9) and bins[r.main_bin] == max(bins.values())
        assert r.variation is None if not any(gaps) else math.isclose(r.variation, statistics.pstdev(gaps) / statistics.fmean(gaps), abs_tol=1e-9)


def test_histograms_add_up_and_hot_authors_are_split(spark):
    df = spark.range(0, 50_000).select(F.lit("hot").alias("author"), (F.col("id") * 977).alias("created_utc"))
    rows = accounts.gap_histogram(df).collect()
    assert [(r.n, r.seconds) for r in rows] == [(49_999, 977 * 49_999)]
    assert accounts.gap_histogram(df.limit(0)).count() == 0


def test_lives_match_python(spark):
    rng = random.Random(3)
    replies = []
    for k in range(40):
        posted = rng.randrange(10**6)
        replies += [(f"s{k}", posted, posted + int(rng.expovariate(1 / 20_000)) - 5) for _ in range(rng.randint(1, 60))]
    df = spark.createDataFrame(replies, "root string, posted long, created_utc long")
    end = max(r[2] for r in replies)
    ages = defaultdict(list)
    for root, posted, at in replies:
        ages[root].append((max(0, at - posted), at))
    curves = defaultdict(dict)
    for r in lifecycle.reply_curve(df).collect():
        curves[r.root][r.step] = (r.n, r.upto)
    lives = {r.root: r for r in lifecycle.lifecycle(df).collect()}
    for root, values in ages.items():
        hours = Counter(a // 3600 for a, _ in values)
        ordered = sorted(a for a, _ in values)
        r = lives[root]
        assert (r.n_replies, r.peak_replies) == (len(values), max(hours.values()))
        assert r.peak_hour == min(h for h, n in hours.items() if n == r.peak_replies)
        assert r.half_life == ordered[math.ceil(len(values) / 2) - 1] // 3600 + 1
        assert r.unfinished == (max(at for _, at in values) > end - 2 * 86400)
        steps = Counter(0 if a < 60 else min(39, math.floor(2 * math.log2(a / 60) + 1e-9) + 1) for a, _ in values)
        total = 0
        for step in sorted(steps):
            total += steps[step]
            assert curves[root][step] == (steps[step], total)
    assert lifecycle.lifecycle(df.limit(0)).count() == 0


def test_survival_with_censored_lives(spark):
    rows = [(1, False), (1, True), (2, False), (3, True), (5, False)]
    got = lifecycle.survival(spark.createDataFrame(rows, "half_life long, unfinished boolean")).orderBy("half_life").collect()
    assert [(r.half_life, r.at_risk, r.ended, r.censored) for r in got] == [(1, 5, 1, 1), (2, 3, 1, 0), (3, 2, 0, 1), (5, 1, 1, 0)]
    assert all(math.isclose(r.survival, s) for r, s in zip(got, [0.8, 0.8 * 2 / 3, 0.8 * 2 / 3, 0.0]))


def test_sketches_answer_any_period_within_two_percent(spark, tmp_path):
    posts = spark.range(0, 400_000).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("subreddit"), F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(60_000))).alias("author"),
        F.col("id").cast("string").alias("id"), (1_700_000_000 + F.col("id") * 86400 * 365 / 400_000).cast("long").alias("created_utc"),
    )
    path = str(tmp_path / "sketches")
    sketches.monthly_sketches(posts).write.parquet(path)
    stored = spark.read.parquet(path)
    for first, last in (("2024-01", "2024-03"), ("2023-11", "2024-11"), ("2024-05", "2024-05")):
        got = {r.subreddit: r for r in sketches.estimates(sketches.merged(stored, ["subreddit"], first, last)).collect()}
        exact = posts.where(F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM").between(first, last)).groupBy("subreddit").agg(
            F.count("*").alias("n"), F.count_distinct("author").alias("authors"), F.count_distinct("id").alias("ids")
        )
        for r in exact.collect():
            mine = got[r.subreddit]
            assert mine.num_posts == r.n and abs(mine.distinct_author / r.authors - 1) < 0.02 and abs(mine.distinct_id / r.ids - 1) < 0.02
    assert sketches.merged(stored, ["subreddit"], "1999-01", "1999-02").count() == 0
