"""Quality, activity, engagement, author and overlap operators."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.functions import categories, scores, time
from forumlens.operators import activity, authors, engagement, overlap, quality
from forumlens.operators.histogram import histogram
from forumlens.plans import CATALOG
from forumlens.sources import sample_tables as st

POSTS = "data_type string, id string, subreddit string, author string, score bigint, created_utc bigint"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_categories(spark):
    df = spark.createDataFrame([("ChatGPT",), ("nowhere",), (" stableDiffusion ",), (None,), ("claudeai",)], "subreddit string")
    rows = df.select(
        categories.by_name().alias("six"), categories.by_folded_name().alias("four"),
        categories.by_substring().alias("five"), categories.tool_name().alias("tool"),
    ).collect()
    assert [r["six"] for r in rows] == ["chatbot_focused", None, None, None, None]
    assert [r["four"] for r in rows] == ["Text AI", "Other", "Creative AI", "Other", "Text AI"]
    assert [r["five"] for r in rows] == ["Text AI", "Other", "Creative AI", "Other", "Text AI"]
    assert [r["tool"] for r in rows] == ["ChatGPT", None, None, None, "ClaudeAI"]


def test_baseline_mentions(spark):
    df = spark.createDataFrame([("AskReddit", "I use Claude daily"), ("AskReddit", "nothing"), ("OpenAI", "claude"), ("AskReddit", None)], "subreddit string, t string")
    got = [r[0] for r in df.select(categories.with_baseline_mentions(categories.by_substring(), F.col("t"))).collect()]
    assert got == [vocab.BASELINE_MENTION_LABEL, "Baseline (AskReddit)", "Text AI", "Baseline (AskReddit)"]


def test_persona(spark):
    df = spark.createDataFrame([(0,), (99,)], "c int")
    named = categories.persona(F.col("c"), vocab.CLUSTER_PERSONAS)
    assert [r[0] for r in df.select(named).collect()] == [vocab.CLUSTER_PERSONAS[0], "Cluster 99"]
    assert df.select(categories.persona(F.col("c"))).first()[0] == "Cluster 0"


def test_winners_keep_equal_rows_and_rank_without_texts(spark):
    rows = [("s", "a", "1", "comment", "t", "text " + str(k % 3), 5, 10) for k in range(6)] + [(None, "b", "2", "comment", None, "x", 1, 1)] * 2
    posts = spark.createDataFrame(rows, "subreddit string, author string, id string, data_type string, title string, body string, score bigint, created_utc bigint")
    top = authors.top_posts(posts, 4).collect()
    assert sorted((r["subreddit"] or "", r["rank"]) for r in top) == [("", 1), ("", 2), ("s", 1), ("s", 2), ("s", 3), ("s", 4)]
    assert len({r["body"] for r in top if r["subreddit"] == "s"}) == 2
    best = authors.best_posts(posts)
    assert sorted(r["author"] for r in best.collect()) == ["a", "b"] and best.columns == posts.columns
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.split("\n") if "WindowGroupLimit" in line or "+- Window [" in line]
    assert ranked and not [line for line in ranked if "body" in line or "title" in line]
    inputs = plan.split("WindowGroupLimit")[1].split("\n")[1]
    assert "_row" in inputs and not [c for c in inputs.split(" AS _row")[-1].split(",") if "body#" in c]



def test_periods(spark):
    df = spark.createDataFrame([(1704067199,), (1704067200,)], "created_utc bigint")
    rows = df.select(*[time.period(g).alias(g) for g in ("daily", "monthly", "quarterly")], time.day_of_week().alias("dow")).collect()
    assert tuple(rows[0]) == ("2023-12-31", "2023-12", "2023-Q4", 1)
    assert tuple(rows[1]) == ("2024-01-01", "2024-01", "2024-Q1", 2)
    with pytest.raises(ValueError):
        time.period("weekly")


def test_one_sided_community(spark):
    df = spark.createDataFrame([("comment", "1", "a", "u", 10, 0), ("comment", "2", "a", "u", 10, 0)], POSTS)
    row = activity.community_stats(df).first()
    assert (row["avg_score_balanced"], row["avg_score"], row["num_submissions"]) == (5.0, 10.0, None)


def test_p99_keeps_ties(spark):
    df = spark.range(1, 201).select(F.col("id").cast("string").alias("author"), F.col("id").alias("total_posts"))
    top = authors.top_authors(df)
    assert sorted(r["total_posts"] for r in top.collect()) == [198, 199, 200]


def random_posts(spark, n=3000, seed=3):
    rng = random.Random(seed)
    names = vocab.TECH_COMMUNITIES[:6] + ["elsewhere"]
    rows = []
    for i in range(n):
        author = "[deleted]" if rng.random() < 0.35 else f"u{rng.randrange(60)}"
        rows.append((rng.choice(["comment", "submission"]), f"p{i}", rng.choice(names), author, rng.randrange(50), i))
    return rows, spark.createDataFrame(rows, POSTS).repartition(7)


def test_overlap_against_brute_force(spark):
    rows, df = random_posts(spark)
    members = {}
    for _, _, sub, author, _, _ in rows:
        if sub in vocab.TECH_COMMUNITIES:
            members.setdefault(sub, set()).add(author)
    expected = {
        (a, b): len(members[a] & members[b]) for a, b in combinations(sorted(members), 2) if members[a] & members[b]
    }
    got = {(r["sub_1"], r["sub_2"]): r["shared_authors"] for r in overlap.overlap_pairs(df).collect()}
    assert got == expected
    many = [f"x{i}" for i in range(130)] + vocab.TECH_COMMUNITIES
    assert {(r["sub_1"], r["sub_2"]): r["shared_authors"] for r in overlap.overlap_pairs(df, many).collect()} == expected


def test_best_and_top_posts_against_brute_force(spark):
    rows, df = random_posts(spark)
    order = lambda r: (-r[4], r[5], r[1], r[0])
    by_author, by_sub = {}, {}
    for r in rows:
        by_author.setdefault(r[3], []).append(r)
        by_sub.setdefault(r[2], []).append(r)
    assert {r["author"]: r["id"] for r in authors.best_posts(df).collect()} == {
        a: min(rs, key=order)[1] for a, rs in by_author.items()
    }
    top = authors.top_posts(df)
    assert plan_of(top).count("WindowGroupLimit") == 2  # before and after the shuffle
    assert {(r["subreddit"], r["rank"]): r["id"] for r in top.collect()} == {
        (s, i + 1): r[1] for s, rs in by_sub.items() for i, r in enumerate(sorted(rs, key=order)[:5])
    }


def test_author_stats_against_brute_force(spark):
    rows, df = random_posts(spark)
    got = {r["author"]: r for r in authors.author_stats(df).collect()}
    for author in {r[3] for r in rows}:
        mine = [r for r in rows if r[3] == author]
        row = got[author]
        assert row["total_posts"] == len(mine) == row["num_comments"] + row["num_submissions"]
        assert row["communities"] == sorted({r[2] for r in mine})
        assert row["avg_score"] == pytest.approx(sum(r[4] for r in mine) / len(mine))


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.9,), (10.0,), (None,)], "v double")
    assert {r["bin"]: r["n"] for r in histogram(df, F.col("v"), 10).collect()} == {0: 1, 1: 1, 9: 2}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in histogram(flat, F.col("v"), 10).collect()] == [(0, 2)]


def test_score_transform(spark):
    df = spark.createDataFrame([(500,), (-100,), (7,), (None,)], "score bigint")
    rows = df.select(scores.clipped(F.col("score")).alias("c"), scores.unlog_score(scores.log_score(F.col("score"))).alias("b")).collect()
    assert [r["c"] for r in rows] == [200, -20, 7, None]
    assert rows[2]["b"] == pytest.approx(7)


def test_length_bin_minimum(spark):
    df = spark.createDataFrame([("ChatGPT", "x" * 10, 1, 1)] * 9 + [("ChatGPT", "x" * 60, 2, 2)] * 10, "subreddit string, title string, num_comments bigint, score bigint")
    bins = engagement.title_length_bins(engagement.with_title_features(engagement.with_category(df)))
    assert [(r["length_bin"], r["post_count"]) for r in bins.collect()] == [("Short (50-100)", 10)]


def test_event_study_patterns(spark):
    events = [("release", "2024-01-15")]
    rows = []
    for offset in range(-56, 14):
        noise = (offset % 3) * 0.1
        rows.append(("flat", offset, 10 + noise))
        rows.append(("spike", offset, 10 + noise + (20 if 0 <= offset < 7 else 0)))
        rows.append(("sustained", offset, 10 + noise + (20 if offset >= 0 else 0)))
    daily = spark.createDataFrame(rows, "subreddit string, o int, avg_score double").withColumn(
        "day", F.date_add(F.lit("2024-01-15").cast("date"), F.col("o"))
    )
    got = {r["subreddit"]: r for r in engagement.event_study(daily, events=events).collect()}
    assert {k: r["pattern"] for k, r in got.items()} == {"flat": "none", "spike": "spike", "sustained": "sustained"}
    assert got["sustained"]["mann_whitney_u"] == 14 * 14 and got["sustained"]["n_pre"] == 14


def test_identities(spark, sf_dir):
    monthly = CATALOG["monthly_activity"].run(spark, sf_dir).collect()
    assert all(r["total_rows"] == r["num_comments"] + r["num_submissions"] for r in monthly)
    slots = CATALOG["time_slots"].run(spark, sf_dir).collect()
    assert len([r for r in slots if r["level"] == "overall"]) <= 168
    assert sum(r["num_posts"] for r in slots if r["level"] == "overall") == sum(r["total_rows"] for r in monthly)
    shares = CATALOG["emotion_by_tool"].run(spark, sf_dir).groupBy("Tool").agg(F.sum("activity_percent").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0, abs=1e-5) for r in shares)
    missing = CATALOG["missingness"].run(spark, sf_dir).collect()
    counts = {(r["subreddit"]): r for r in CATALOG["community_stats"].run(spark, sf_dir).collect()}
    for r in missing:
        assert r["body_nulls"] == (counts[r["subreddit"]]["num_submissions"] or 0)
        assert r["title_nulls"] == (counts[r["subreddit"]]["num_comments"] or 0)


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def test_plans_stay_in_the_jvm_and_join_by_keys(spark, sf_dir):
    for name, q in CATALOG.items():
        if q.sql is None:
            continue
        plan = plan_of(q.run(spark, sf_dir))
        assert not any(node in plan for node in PYTHON_NODES), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_pruning_and_pushdown(spark, sf_dir):
    plan = plan_of(CATALOG["monthly_activity"].run(spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan
    trips = plan_of(CATALOG["trip_daily"].run(spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate" in trips and "LessThan(l_shipdate" in trips
    path = st.table(spark, sf_dir, "documents")
    from forumlens.sources.readers import allow_communities

    kept = allow_communities(path.withColumnRenamed("source", "subreddit"), ["src1", "src2"])
    assert "In(source" in plan_of(kept)


def test_monthly_missing_side(spark):
    comments = spark.createDataFrame([("1", 1704067200)], "id string, created_utc bigint")
    submissions = spark.createDataFrame([("2", 1706745600)], "id string, created_utc bigint")
    rows = [tuple(r) for r in activity.monthly_activity_joined(comments, submissions).collect()]
    assert rows == [("2024-01", 1, 0, 1), ("2024-02", 0, 1, 1)]


def test_duplicates(spark):
    df = spark.createDataFrame([("comment", "1", "a", "u", 1, 1), ("comment", "1", "a", "u", 1, 2), ("comment", "2", "a", "v", 1, 1)], POSTS)
    row = quality.duplicate_ids(df).first()
    assert (row["num_duplicate_ids"], row["total_duplicate_rows"]) == (1, 2)
    row = quality.duplicate_authors(df).first()
    assert (row["num_duplicate_authors"], row["total_authors"], row["duplicate_author_pct"]) == (1, 2, 50.0)
