"""How fast keywords spread: sliding sums over a calendar without gaps, and alerts by z-scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keyword_counts(posts: DataFrame, tokens: Column, keywords: Mapping[str, Sequence[str]], day: str = "date") -> DataFrame:
    """Posts that use a word of each keyword group, and times they do, per day: (day, keyword, n_posts, n_uses).

    Each post's uses are counted inside the row, so only groups that a post names leave it; sums are partial in map tasks.
    """
    words = sorted({w for group in keywords.values() for w in group})
    groups = [F.struct(F.lit(name).alias("keyword"), _uses(F.col("_hits"), group).alias("uses")) for name, group in keywords.items()]
    return (
        posts.select(F.col(day).alias("day"), F.filter(tokens, lambda t: t.isin(words)).alias("_hits"))
        .where(F.size("_hits") > 0)
        .select("day", F.inline(F.filter(F.array(*groups), lambda g: g["uses"] > 0)))
        .groupBy("day", "keyword")
        .agg(F.count(F.lit(1)).alias("n_posts"), F.sum("uses").alias("n_uses"))
    )


def _uses(hits: Column, words: Sequence[str]) -> Column:
    return F.size(F.filter(hits, lambda t: t.isin(sorted(set(words)))))


def fill_days(counts: DataFrame, keywords: Sequence[str], days: DataFrame) -> DataFrame:
    """Counts for each keyword and each day from the first to the last of `days`; days without posts count 0.

    The calendar is one row exploded into its days and keywords, so it has as many rows as days times keywords.
    """
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).where(F.col("first").isNotNull())
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("day")).select(
        "day", F.explode(F.array(*[F.lit(k) for k in keywords])).alias("keyword")
    )
    return calendar.join(counts, ["day", "keyword"], "left").fillna(0, ["n_posts", "n_uses"])


def velocity(filled: DataFrame, value: str = "n_posts", width: int = 7, history: int = 14) -> DataFrame:
    """For each keyword and day, the sum over the `width` days up to it, its change against the `width` days before, and how
    far the change is from the mean of the changes of all earlier days, in their standard deviations.

    `filled` has every day, so windows of rows are windows of days. The change is null until two widths have gone by; the z-score
    until `history` changes have been seen or while they have all been equal. A window holds one keyword's days.
    """
    by_day = Window.partitionBy("keyword").orderBy("day")
    sums = filled.select(
        "keyword", "day", F.sum(value).over(by_day.rowsBetween(1 - width, 0)).alias("in_window"), F.row_number().over(by_day).alias("_k")
    )
    change = F.when(F.col("_k") >= 2 * width, F.col("in_window") - F.lag("in_window", width).over(by_day))
    changes = sums.withColumn("velocity", change)
    # Changes are whole numbers, so their sums are exact and a spread of zero is found as such.
    past = by_day.rowsBetween(Window.unboundedPreceding, -1)
    n, s = F.count("velocity").over(past), F.sum("velocity").over(past)
    ss = F.sum(F.col("velocity") * F.col("velocity")).over(past)
    moments = changes.withColumns({"_n": n, "_s": s, "_ss": ss})
    spread = F.col("_n") * F.col("_ss") - F.col("_s") * F.col("_s")
    sd = F.when(
        (F.col("_n") >= max(history, 2)) & (spread > 0), F.sqrt(spread.cast("double") / (F.col("_n") * (F.col("_n") - 1)).cast("double"))
    )
    return moments.select(
        "keyword", "day", "in_window", "velocity", ((F.col("velocity") - F.try_divide("_s", "_n")) / sd).alias("z_score")
    )


def alerts(velocities: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Surges: stretches of days in a row on which a keyword's z-score is at or above `threshold`.

    One row a surge: its first and last day, its highest z-score and the sum of the window on that day (the first one, if several).
    """
    above = velocities.where(F.col("z_score") >= threshold)
    number = F.row_number().over(Window.partitionBy("keyword").orderBy("day"))
    runs = above.withColumn("_run", F.date_sub("day", number))
    return (
        runs.groupBy("keyword", "_run")
        .agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days"),
            F.max("z_score").alias("peak_z"), F.min_by("in_window", F.struct(-F.col("z_score"), F.col("day"))).alias("peak_window"),
        )
        .drop("_run")
    )
