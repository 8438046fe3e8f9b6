"""Community overlap without a list against sets in Python."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from forumlens.operators import overlap


def communities(seed, n_sets, n_authors):
    """Sets of authors with copies that differ little, one author in all sets and one set that holds most authors."""
    rng = random.Random(seed)
    sets = {}
    for k in range(n_sets):
        size = rng.choice([1, 2, 5, 20, 60])
        base = sets[f"c{rng.randrange(k)}"] if k and rng.random() < 0.4 else set(rng.sample(range(n_authors), size))
        sets[f"c{k}"] = {a for a in base if rng.random() < 0.95} | set(rng.sample(range(n_authors), 1)) | {"everywhere"}
    return sets | {"huge": set(range(n_authors)), "lonely": {"nobody else"}}


def rows_of(spark, sets):
    rows = [(f"u{a}", name) for name, authors in sets.items() for a in authors] * 2
    return spark.createDataFrame(rows + [(None, "c0"), ("u1", None)], "author string, subreddit string")


@pytest.mark.parametrize(("jaccard", "shared", "block"), [(0.0, 1, 200), (0.1, 1, 3), (0.5, 2, 7), (0.8, 1, 200), (1.0, 1, 200), (0.0, 15, 200)])
def test_pairs_match_sets(spark, monkeypatch, jaccard, shared, block):
    monkeypatch.setattr(overlap, "BLOCK", block)
    sets = communities(3, 60, 80)
    want = {}
    for a, b in combinations(sorted(sets), 2):
        common, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if common >= shared and common / union >= jaccard:
            want[a, b] = (common, common / union)
    got = overlap.similar_communities(rows_of(spark, sets), jaccard, shared).collect()
    assert {(r.sub_1, r.sub_2): (r.shared_authors, r.jaccard) for r in got} == want and len(got) == len(want)


def test_blocks_split_an_author_of_many_communities(spark):
    one = spark.range(0, 1000).select(F.concat(F.lit("c"), "id").alias("subreddit"), F.lit("bot").alias("author"), F.lit(1000).alias("spread"))
    met = overlap._meeting(one, 100)
    assert met.count() == 1000 * 999 // 2
    assert met.where("sub_1 >= sub_2").count() == 0


def test_ten_thousand_communities(spark):
    posts = spark.range(0, 40_000).select(
        F.concat(F.lit("s"), F.col("id") % 10_000).alias("subreddit"), F.concat(F.lit("u"), F.floor(F.col("id") % 10_000 / 2), F.lit("_"), F.floor(F.col("id") / 10_000)).alias("author")
    )
    got = overlap.similar_communities(posts.union(posts.select("subreddit", F.lit("bot"))), 0.9)
    assert got.agg(F.count("*"), F.min("shared_authors"), F.min("jaccard")).first()[:] == (5000, 5, 1.0)
    listed = [f"s{k}" for k in range(40)]
    pairs = overlap.overlap_pairs(posts, listed).collect()
    assert {tuple(r) for r in pairs} == {(r.sub_1, r.sub_2, r.shared_authors) for r in overlap.similar_communities(posts, 0.0).where(F.col("sub_1").isin(listed) & F.col("sub_2").isin(listed)).collect()}
    assert overlap.similar_communities(posts.limit(0)).count() == 0


def test_pairs_with_few_common_authors_are_not_looked_up(spark, monkeypatch):
    stored = []
    store = overlap.stage
    monkeypatch.setattr(overlap, "stage", lambda df: stored.append(store(df)) or stored[-1])
    sets = {f"c{k:02}": {"-".join(map(str, sorted((k, j)))) for j in range(30) if j != k} for k in range(30)}
    sets |= {"twin": sets["c07"], "small": {"one", "two"}}
    got = overlap.similar_communities(rows_of(spark, sets), 0.2, 2).collect()
    assert [tuple(r) for r in got] == [("c07", "twin", 29, 1.0)]
    assert stored[-1].count() == 1
