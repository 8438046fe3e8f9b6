"""Reply forests and look-ups with hot keys, against walks in Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from forumlens.operators import threads
from forumlens.operators.skew import look_up
from forumlens.sources import sample_tables as st

SCHEMA = "name string, parent_name string"


def walked(links):
    """Root, depth, size below and status of each node, by walking up."""
    parent = {}
    for name, up in links:
        if name is not None:
            known = parent.get(name)
            parent[name] = up if known is None else known if up is None else min(known, up)
    out, below = {}, Counter()
    for name in parent:
        path, at = [name], name
        while parent[at] in parent:
            at = parent[at]
            if at in path:
                path = None
                break
            path.append(at)
        if path is None:
            out[name] = (None, None, "loop")
        else:
            below.update(path[1:])
            out[name] = (at, len(path) - 1, "thread" if parent[at] is None else "orphan")
    return {(n, r, d, None if r is None else below[n], s) for n, (r, d, s) in out.items()}


def forest_of(spark, links):
    return {tuple(r) for r in threads.reply_forest(spark.createDataFrame(links, SCHEMA)).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_forest_matches_walks(spark, seed):
    rng = random.Random(seed)
    n = 150
    links = []
    for k in range(n):
        kind = rng.random()
        up = None if kind < 0.1 else "gone" if kind < 0.15 else f"p{rng.randrange(n)}" if kind < 0.3 else f"p{rng.randrange(max(1, k))}"
        links.append((f"p{k}", up))
    links += [(f"p{k}", f"p{k + 1}") for k in range(5)] + [(None, "p1"), (None, None), ("self", "self"), ("", None)]
    assert forest_of(spark, links) == walked(links)


def test_deep_chain_and_hot_parent(spark):
    chain = [("c0", None)] + [(f"c{k}", f"c{k - 1}") for k in range(1, 1001)]
    hot = [(f"h{k}", "c500") for k in range(3000)] + [(f"g{k}", f"h{k}") for k in range(50)]
    circle = [("x0", "x2"), ("x1", "x0"), ("x2", "x1")] + [("t0", "x0")] + [(f"t{k}", f"t{k - 1}") for k in range(1, 40)]
    assert forest_of(spark, chain + hot + circle) == walked(chain + hot + circle)
    assert forest_of(spark, []) == set()
    assert forest_of(spark, circle) == walked(circle)


def test_thread_table_counts_each_comment_once(spark):
    rows = [
        ("t3_a", None, "u", 5, 100, "s", "Title"), ("t1_b", "t3_a", "v", 2, 160, "s", None), ("t1_c", "t1_b", "v", None, 150, "s", None),
        ("t1_d", "t1_c", None, 4, 400, "s", None), ("t3_e", None, None, None, 7, "s", None), ("t1_f", "t1_gone", "w", 9, 9, "s", None),
    ]
    posts = spark.createDataFrame(
        rows, "name string, parent_name string, author string, score long, created_utc long, subreddit string, title string"
    )
    got = {r.root: r for r in threads.thread_table(posts, threads.reply_forest(posts)).collect()}
    a, e = got["t3_a"], got["t3_e"]
    assert set(got) == {"t3_a", "t3_e"}
    assert (a.n_comments, a.n_direct, a.n_authors, a.max_depth, a.mean_depth, a.mean_comment_score) == (3, 1, 1, 3, 2.0, 3.0)
    assert (a.seconds_to_first, a.seconds_active, a.title_length, a.hour) == (50, 250, 5, 0)
    assert (e.n_comments, e.max_depth, e.mean_depth, e.seconds_to_first, e.title_length) == (0, 0, None, None, None)
    flat = threads.thread_correlations(threads.thread_table(posts, threads.reply_forest(posts)), ["score"], ["n_comments"]).collect()
    assert [tuple(r) for r in flat] == [("score", "n_comments", 1, None)]


def test_sample_threads_hold_all_kinds(spark, sf_dir):
    posts = st.thread_posts(spark, sf_dir.replace("sf0.001", "sf0.01"))
    links = [tuple(r) for r in posts.select("name", "parent_name").collect()]
    want = walked(links)
    assert {s for *_, s in want} == {"thread", "orphan", "loop"} and max(d or 0 for _, _, d, _, _ in want) >= 8
    assert {tuple(r) for r in threads.reply_forest(posts).collect()} == want


def test_look_up_splits_hot_keys(spark):
    rows = spark.createDataFrame([(k, 7 if k % 3 else k) for k in range(3000)] + [(-1, None)], "id long, key long")
    table = spark.range(0, 2000).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
    got = look_up(rows, table, "key")
    assert {(r.id, r.value) for r in got.collect()} == {(k, 70 if k % 3 else k * 10) for k in range(3000) if k % 3 or k < 2000}
    assert look_up(rows.where("id > 5000"), table, "key").count() == 0
    small = table.where("key > 100")
    kept = look_up(rows.where("key IS NOT NULL"), small, "key", "left")
    want = {(k, None if k % 3 or k <= 100 or k >= 2000 else k * 10) for k in range(3000)}
    assert {(r.id, r.value) for r in kept.collect()} == want and kept.columns == ["key", "id", "value"]
