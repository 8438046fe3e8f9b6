"""Reply forests: root, depth and size below every post, and what a submission's discussion looks like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.operators.skew import look_up
from forumlens.session import stage


def reply_forest(posts: DataFrame) -> DataFrame:
    """Where each post stands in its thread, from `name` (unique) and `parent_name` (null for a submission).

    Returns name, root, depth (0 at the root), n_below (posts below it at any depth) and status:

    * `thread`: the root has no parent;
    * `orphan`: the topmost post names a parent that is not among the posts; that post counts as the root;
    * `loop`: the parents lead into a circle; root, depth and n_below are null.

    Of rows that share a name the one with the least parent counts (one without a parent last); rows without a
    name are left out. Pointers are doubled: after k rounds a post knows its ancestor 2^k steps up, or its root, and how many posts
    are below it within fewer steps. So a thread of any depth takes as many rounds as the logarithm of its depth, each
    round two joins and an aggregate of narrow rows, stored in between. If a round brings no further post to its root, all that
    are left lead into circles: a post of depth 2^(k+1) or more has an ancestor that would have come home.
    """
    links = posts.where(F.col("name").isNotNull()).groupBy("name").agg(F.min("parent_name").alias("parent_name"))
    links = stage(links)
    names = links.select(F.col("name").alias("parent_name"))
    known = look_up(links.where(F.col("parent_name").isNotNull()), names, "parent_name")
    first = links.select("name", F.lit(None).cast("string").alias("top"), F.lit(0).alias("dist"))
    linked = known.select("name", F.col("parent_name").alias("top"), F.lit(1).alias("dist"))
    nodes = stage(_one_row_each(first.withColumn("size", F.lit(1)), linked.withColumn("size", F.lit(0))))

    step, open_before = 1, None
    while True:
        # Whoever has an ancestor exactly `step` up goes on from it; all others have reached their root.
        going = nodes.where((F.col("dist") == step) & F.col("top").isNotNull())
        n_open = going.count()
        if n_open in (0, open_before):
            break
        above = nodes.select(F.col("name").alias("top"), F.col("top").alias("next"), F.col("dist").alias("more"))
        moved = look_up(going.select("name", "top"), above, "top").select(
            "name", F.coalesce("next", "top").alias("top"), (F.lit(step) + F.col("more")).alias("dist"), F.lit(0).alias("size")
        )
        gained = going.groupBy(F.col("top").alias("name")).agg(F.sum("size").alias("size"))
        gained = gained.select("name", F.lit(None).cast("string").alias("top"), F.lit(0).alias("dist"), "size")
        still = going.select("name", F.lit(None).cast("string").alias("top"), F.lit(0).alias("dist"), "size")
        home = nodes.where((F.col("dist") != step) | F.col("top").isNull())
        nodes = stage(_one_row_each(home, still, moved, gained))
        step, open_before = 2 * step, n_open

    ended = ~((F.col("dist") == step) & F.col("top").isNotNull()) if n_open else F.lit(True)
    placed = nodes.select(
        "name",
        F.when(ended, F.coalesce("top", "name")).alias("root"),
        F.when(ended, F.col("dist")).cast("long").alias("depth"),
        F.when(ended, F.col("size") - 1).cast("long").alias("n_below"),
    )
    broken = links.where(F.col("parent_name").isNotNull()).join(
        placed.where("depth = 0").select("name"), "name", "left_semi"
    )
    orphans = broken.select(F.col("name").alias("root"), F.lit("orphan").alias("status"))
    # Roots are unique; a hot thread's posts are not sent to one task.
    inside = placed.where(F.col("root").isNotNull())
    tops = placed.where("depth = 0").select("root").join(orphans, "root", "left")
    found = look_up(inside, tops.withColumn("status", F.coalesce("status", F.lit("thread"))), "root")
    loops = placed.where(F.col("root").isNull()).withColumn("status", F.lit("loop"))
    return found.select("name", "root", "depth", "n_below", "status").unionByName(loops)


def _one_row_each(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The parts of each node's state put together: one part has its pointer, several may have a size."""
    for other in others:
        first = first.unionByName(other)
    return first.groupBy("name").agg(
        F.max("top").alias("top"), F.max("dist").cast("int").alias("dist"), F.sum("size").cast("long").alias("size")
    )


def thread_table(posts: DataFrame, forest: DataFrame) -> DataFrame:
    """One row per submission: its own features and those of all comments below it, at any depth.

    `posts` needs name, author, score, created_utc and title; a submission without comments has zero counts and null means.
    Comments are summed by (submission, author) first, so a hot thread is spread over its authors, then by submission.
    """
    placed = forest.where("status = 'thread'").select("name", "root", "depth")
    rows = posts.select("name", "author", "score", "created_utc").join(placed, "name")
    replies = rows.where("depth > 0")
    by_author = replies.groupBy("root", "author").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("depth") == 1).alias("direct"),
        F.max("depth").alias("deepest"),
        F.sum("depth").alias("depths"),
        F.sum("score").alias("scores"),
        F.count("score").alias("scored"),
        F.min("created_utc").alias("first"),
        F.max("created_utc").alias("last"),
    )
    below = by_author.groupBy("root").agg(
        F.sum("n").alias("n_comments"),
        F.sum("direct").alias("n_direct"),
        F.count("author").alias("n_authors"),
        F.max("deepest").alias("max_depth"),
        F.try_divide(F.sum("depths"), F.sum("n")).alias("mean_depth"),
        F.try_divide(F.sum("scores"), F.sum("scored")).alias("mean_comment_score"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    tops = posts.join(placed.where("depth = 0").select("name"), "name").select(
        F.col("name").alias("root"), "subreddit", "score", "created_utc",
        F.length("title").alias("title_length"), F.hour(F.timestamp_seconds("created_utc")).alias("hour"),
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_comments", "n_direct", "n_authors", "max_depth")]
    return tops.join(below, "root", "left").select(
        "root", "subreddit", "score", "title_length", "hour", *counts, "mean_depth", "mean_comment_score",
        (F.col("first") - F.col("created_utc")).alias("seconds_to_first"),
        (F.col("last") - F.col("first")).alias("seconds_active"),
    )


FEATURES = ("title_length", "score", "hour")
MEASURES = ("n_comments", "n_direct", "n_authors", "max_depth", "mean_comment_score", "seconds_to_first")


def thread_correlations(
    table: DataFrame, features: Sequence[str] = FEATURES, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Pearson correlation of each feature of a submission with each measure of its discussion.

    One aggregate over the table; each pair counts the threads that have both, and is null where one does not vary.
    """

    def pair(x: str, y: str) -> Column:
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
        varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
        return F.struct(
            F.lit(x).alias("feature"), F.lit(y).alias("measure"), F.count(a).alias("n_threads"),
            F.when(varies, F.corr(a, b)).alias("correlation"),
        )

    pairs = F.array(*[pair(x, y) for x in features for y in measures])
    return table.agg(pairs.alias("pairs")).select(F.inline("pairs"))


def depth_profile(forest: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts, mean score and mean number of posts below, by depth in the thread."""
    return (
        forest.where("status = 'thread'")
        .join(posts.select("name", "score"), "name")
        .groupBy("depth")
        .agg(F.count(F.lit(1)).alias("n_posts"), F.avg("score").alias("avg_score"), F.avg("n_below").alias("avg_below"))
    )
