"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import stage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b long); a component is named by its smallest node.

    Alternates the large-star and small-star steps: every node points its larger neighbours, then its
    smaller ones, at the smallest node around it. Each step is one grouped minimum, taken in map tasks
    first, and one join; the number of rounds grows with the logarithm of the longest path. Links are
    written to the shared folder after each round. Loops and repeated links are allowed; an empty table
    gives an empty result. Raises if the links don't settle within `MAX_ROUNDS`.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(down, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        edges = stage(small)
        now = _state(edges)
        if now == before:
            pointed = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return pointed.unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
