"""Authors shared between communities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens import vocab
from forumlens.session import stage

WORD_BITS = 62


def author_communities(posts: DataFrame) -> DataFrame:
    """Distinct (author, community)."""
    return posts.select("author", "subreddit").where(F.col("author").isNotNull()).distinct()


def overlap_matrix(posts: DataFrame, communities: Sequence[str] = tuple(vocab.TECH_COMMUNITIES)) -> DataFrame:
    """Shared distinct authors of every two listed communities, one row per community, one column each.

    An author's communities are packed into fixed-width bit masks, so the only wide shuffle is one
    hash aggregate per author with map-side combine: an author with a third of all rows arrives as one
    mask per map task. Equal masks are then counted, and every mask adds its count to the columns of
    its members, one row per member; author pairs are never listed.
    """
    names = sorted(set(communities))
    place = {name: divmod(i, WORD_BITS) for i, name in enumerate(names)}
    words = range(place[names[-1]][0] + 1)

    def mask(word: int):
        bits = F.lit(0).cast("long")
        for name, (w, bit) in place.items():
            if w == word:
                bits = F.when(F.col("subreddit") == name, F.lit(1 << bit).cast("long")).otherwise(bits)
        return F.bit_or(bits).alias(f"m{word}")

    def member(name: str):
        word, bit = place[name]
        return F.getbit(f"m{word}", F.lit(bit)) == 1

    footprints = (
        posts.where(F.col("subreddit").isin(*names) & F.col("author").isNotNull())
        .groupBy("author")
        .agg(*[mask(w) for w in words])
        .groupBy(*[f"m{w}" for w in words])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    own = F.explode(F.array_compact(F.array(*[F.when(member(n), F.lit(n)) for n in names])))
    return (
        footprints.withColumn("subreddit", own)
        .groupBy("subreddit")
        .agg(
            *[
                F.sum(F.when(member(n) & (F.col("subreddit") != n), F.col("n")).otherwise(0)).alias(n)
                for n in names
            ]
        )
    )


def overlap_pairs(posts: DataFrame, communities: Sequence[str] = tuple(vocab.TECH_COMMUNITIES)) -> DataFrame:
    """Community pairs `sub_1 < sub_2` with at least one shared author, most shared first."""
    names = sorted(set(communities))
    return (
        overlap_matrix(posts, names)
        .unpivot("subreddit", names, "sub_2", "shared_authors")
        .where((F.col("subreddit") < F.col("sub_2")) & (F.col("shared_authors") > 0))
        .select(F.col("subreddit").alias("sub_1"), "sub_2", "shared_authors")
        .orderBy(F.desc("shared_authors"), "sub_1", "sub_2")
    )


def top_pairs(pairs: DataFrame, n: int = 25) -> DataFrame:
    """The most shared pairs with a display label."""
    return (
        pairs.withColumn("pair", F.concat_ws(" ↔ ", "sub_1", "sub_2"))
        .orderBy(F.desc("shared_authors"), "sub_1", "sub_2")
        .limit(n)
    )


#: Communities of one author that meet all others of the author in one group.
BLOCK = 200


def _meeting(members: DataFrame, block: int | None = None, close: Column | None = None) -> DataFrame:
    """Pairs `sub_1 < sub_2` of communities with a common author among `members` (subreddit, author, spread), and in `met`
    how many they have. Other columns of `members` are there as `.._1` and `.._2` for the condition `close`.

    `spread` is the number of the author's communities. The communities of an author in very many are dealt to blocks, and
    each block meets all of them, so an author's pairs are made by as many groups as there are blocks. An author makes a
    pair once, and map tasks add up the pairs before the shuffle.
    """
    parts = F.ceil(F.col("spread") / (block or BLOCK)).cast("int")
    own = [c for c in members.columns if c not in ("author", "subreddit", "spread")]

    def side(number: int, dealt: Column) -> DataFrame:
        kept = [F.col(c).alias(f"{c}_{number}") for c in own]
        return members.select("author", F.col("subreddit").alias(f"sub_{number}"), *kept, dealt.alias("block"))

    every = F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))
    pairs = side(1, every).join(side(2, F.pmod(F.xxhash64("subreddit"), parts)), ["author", "block"]).where("sub_1 < sub_2")
    if close is not None:
        pairs = pairs.where(close)
    return pairs.groupBy("sub_1", "sub_2").agg(F.count(F.lit(1)).alias("met"))


def similar_communities(posts: DataFrame, min_jaccard: float = 0.1, min_shared: int = 1) -> DataFrame:
    """All pairs of communities with at least `min_shared` authors in common and a Jaccard similarity of at least `min_jaccard`.

    Returns sub_1 < sub_2, shared_authors and jaccard; communities are not listed anywhere. A similarity join with a prefix
    filter: authors are put in one order, those of few communities first. Two similar sets must share an author among the
    first of each, as many as could be missed and one more, so only these are matched; authors of very many communities
    stand at the end and rarely count. A set's first authors are cut by a histogram of their spreads, a few rows a set,
    which takes some more but sorts no set. Pairs whose common first authors, with all others of one set, are still too few
    go; what is left is counted exactly, through the smaller set of a pair. Communities travel by number.
    """
    members = stage(author_communities(posts).where(F.col("subreddit").isNotNull()))
    spread = members.groupBy("author").agg(F.count(F.lit(1)).alias("spread"))
    members = stage(members.join(spread, "author"))
    by_spread = members.groupBy("subreddit", "spread").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("subreddit").orderBy("spread")
    placed = by_spread.select(
        "subreddit", "spread", "n",
        (F.sum("n").over(order) - F.col("n")).alias("before"),
        F.sum("n").over(Window.partitionBy("subreddit")).alias("size"),
    )
    # A similar set shares at least this many authors; the first authors are all but as many, and one more.
    needed = F.greatest(F.ceil(F.col("size") * F.lit(min_jaccard) - 1e-9), F.lit(min_shared), F.lit(1))
    cuts = stage(placed.where(F.col("before") < F.col("size") - needed + 1))
    # `rest` is the number of authors after the first ones. Numbers are those of the stored table.
    sizes = cuts.groupBy("subreddit").agg(F.first("size").alias("size"), (F.first("size") - F.sum("n")).alias("rest"))
    sizes = stage(sizes.withColumn("no", F.monotonically_increasing_id()))
    numbered = cuts.select("subreddit", "spread").join(sizes.select("subreddit", "no", "size"), "subreddit")
    first = members.where(F.col("spread") > 1).join(numbered, ["subreddit", "spread"])

    small, large = F.least("size_1", "size_2"), F.greatest("size_1", "size_2")
    close = (small >= large * F.lit(min_jaccard) - 1e-9) & (small >= min_shared)
    met = _meeting(first.select("author", F.col("no").alias("subreddit"), "spread", "size"), close=close)
    for side in ("1", "2"):
        of = [F.col("no").alias(f"sub_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ("size", "rest")], F.col("subreddit").alias(f"name_{side}")]
        met = met.join(sizes.select(*of), f"sub_{side}")
    # Common authors that are not first in both sets come after the earlier cut, so they are among the rest of one set.
    least = F.greatest((F.col("size_1") + F.col("size_2")) * F.lit(min_jaccard / (1 + min_jaccard)) - 1e-6, F.lit(float(min_shared)))
    named = F.struct(F.col("name_1").alias("name"), F.col("size_1").alias("size")), F.struct(F.col("name_2").alias("name"), F.col("size_2").alias("size"))
    near = met.where(F.col("met") + F.greatest("rest_1", "rest_2") >= least).select(F.array_sort(F.array(*named)).alias("s"))
    near = stage(
        near.select(
            F.col("s")[0]["name"].alias("sub_1"), F.col("s")[1]["name"].alias("sub_2"),
            F.col("s")[0]["size"].alias("size_1"), F.col("s")[1]["size"].alias("size_2"),
        )
    )

    # The smaller set's authors are looked for in the larger set: the key is (community, author), of which there is one row.
    from_first = F.col("size_1") <= F.col("size_2")
    sides = near.select("*", F.when(from_first, F.col("sub_1")).otherwise(F.col("sub_2")).alias("subreddit"),
                        F.when(from_first, F.col("sub_2")).otherwise(F.col("sub_1")).alias("_in"))
    own = members.select("subreddit", "author")
    looked = sides.join(own, "subreddit").join(own.withColumnRenamed("subreddit", "_in"), ["_in", "author"])
    counted = looked.groupBy("sub_1", "sub_2", "size_1", "size_2").agg(F.count(F.lit(1)).alias("shared_authors"))
    jaccard = F.col("shared_authors") / (F.col("size_1") + F.col("size_2") - F.col("shared_authors"))
    return counted.select("sub_1", "sub_2", "shared_authors", jaccard.alias("jaccard")).where(
        (F.col("shared_authors") >= min_shared) & (F.col("jaccard") >= min_jaccard)
    )
