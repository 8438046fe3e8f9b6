"""Signs of automated accounts: the rhythm of an author's posts and how much of their text is repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400
#: Gaps between posts fall into bins whose borders are powers of two of seconds, so a histogram has at most 40 bins.
BINS = 40


def gap_histogram(posts: DataFrame) -> DataFrame:
    """For each author and bin, the number of gaps between one post and the next, their sum and the sum of their squares.

    Returns author, bin (0: below 1 s, k: from 2^(k-1) s on), n, seconds, squares. Histograms of an author add up. Gaps
    within a day are found in windows of one author and day; a day's first post looks back through a window over the
    author's days, one row each. No window holds all posts of a hot author. Posts at one second have gaps of 0.
    """
    known = posts.where(F.col("author").isNotNull() & F.col("created_utc").isNotNull())
    seconds = known.groupBy("author", "created_utc").agg(F.count(F.lit(1)).alias("n")).withColumn("day", F.floor(F.col("created_utc") / DAY))
    days = seconds.groupBy("author", "day").agg(F.max("created_utc").alias("last"))
    by_day = Window.partitionBy("author").orderBy("day")
    before = days.select("author", "day", F.lag("last").over(by_day).alias("before"))
    within = Window.partitionBy("author", "day").orderBy("created_utc")
    lagged = seconds.withColumn("earlier", F.lag("created_utc").over(within)).join(before, ["author", "day"])
    gap = F.col("created_utc") - F.coalesce("earlier", "before")
    # A second of several posts has as many gaps of 0, less one, besides the gap to the second before.
    same = F.struct(F.lit(0).cast("long").alias("gap"), (F.col("n") - 1).alias("n"))
    gaps = lagged.select("author", F.inline(F.array(F.struct(gap.alias("gap"), F.lit(1).cast("long").alias("n")), same))).where("gap IS NOT NULL AND n > 0")
    place = F.when(F.col("gap") < 1, 0).otherwise(F.least(F.floor(F.log2(F.col("gap") + F.lit(0.5))) + 1, F.lit(BINS - 1)))
    wide = F.col("gap").cast("decimal(38,0)")
    return gaps.groupBy("author", place.cast("int").alias("bin")).agg(
        F.sum("n").alias("n"), F.sum(F.col("gap") * F.col("n")).alias("seconds"), F.sum(wide * wide * F.col("n")).alias("squares")
    )


def rhythm(histogram: DataFrame) -> DataFrame:
    """For each author, gaps, their mean, their variation (deviation over mean) and the entropy of their bins in bits.

    A program that posts every hour has gaps of one kind: entropy and variation near 0. People have both bursts and breaks.
    """
    totals = histogram.groupBy("author").agg(
        F.sum("n").alias("n_gaps"), F.sum("seconds").alias("s"), F.sum("squares").alias("ss"),
        F.sum(F.col("n") * F.log2("n")).alias("nlogn"), F.max_by("bin", F.struct("n", "bin")).alias("main_bin"), F.max("n").alias("in_main"),
    )
    n, s = F.col("n_gaps"), F.col("s")
    spread = (n * F.col("ss") - s * s).cast("double")
    return totals.select(
        "author",
        "n_gaps",
        F.try_divide(s.cast("double"), n).alias("mean_gap"),
        F.try_divide(F.sqrt(spread), s.cast("double")).alias("variation"),
        (F.log2("n_gaps") - F.col("nlogn") / n).alias("entropy"),
        "main_bin",
        (F.col("in_main") / n).alias("main_share"),
    )


def repeated_texts(posts: DataFrame, text: Column) -> DataFrame:
    """For each author, posts with text, different ones and the share of posts that repeat an earlier text of the author.

    Texts are compared by 128-bit fingerprints of their letters and digits in lower case; only fingerprints are shuffled, and
    they are counted by (author, text) first.
    """
    plain = F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))
    marked = posts.where(F.col("author").isNotNull() & text.isNotNull()).select(
        "author", F.xxhash64(plain).alias("a"), F.xxhash64(F.lit("again"), plain).alias("b")
    )
    texts = marked.groupBy("author", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    sums = texts.groupBy("author").agg(F.sum("n").alias("n_texts"), F.count(F.lit(1)).alias("n_different"), F.max("n").alias("most_repeated"))
    return sums.withColumn("repeat_share", (F.col("n_texts") - F.col("n_different")) / F.col("n_texts"))


def bot_signals(
    posts: DataFrame, text: Column, min_gaps: int = 20, max_variation: float = 0.1, max_entropy: float = 0.5, min_repeats: float = 0.5
) -> DataFrame:
    """Rhythm and repetition of each author, and two signals: `periodic` and `repetitive`, from `min_gaps` gaps on.

    An author is periodic whose gaps vary by at most `max_variation` of their mean, or fall into bins of at most `max_entropy` bits.
    """
    both = rhythm(gap_histogram(posts)).join(repeated_texts(posts, text), "author", "full")
    often = F.coalesce(F.col("n_gaps") >= min_gaps, F.lit(False))
    steady = F.coalesce(F.col("variation") <= max_variation, F.lit(False)) | (F.col("entropy") <= max_entropy)
    return both.withColumns({"periodic": often & F.coalesce(steady, F.lit(False)), "repetitive": often & F.coalesce(F.col("repeat_share") >= min_repeats, F.lit(False))})
