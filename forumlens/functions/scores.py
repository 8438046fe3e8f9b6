"""Score transforms, engagement labels and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_SCORE = -20
MAX_SCORE = 200


def clipped(score: Column, low: int = MIN_SCORE, high: int = MAX_SCORE) -> Column:
    """Score limited to [low, high]; NULL stays NULL."""
    return F.when(score > high, F.lit(high)).when(score < low, F.lit(low)).otherwise(score)


def log_score(score: Column, low: int = MIN_SCORE, high: int = MAX_SCORE) -> Column:
    return F.log1p(clipped(score, low, high) - F.lit(low))


def unlog_score(value: Column, low: int = MIN_SCORE) -> Column:
    """Inverse of `log_score` on the clipped scale."""
    return F.expm1(value) + F.lit(low)


def engaged(score: Column, threshold: int = 8) -> Column:
    """1.0 when the score reaches the threshold."""
    return F.when(score >= threshold, 1.0).otherwise(0.0)


def pct(condition: Column) -> Column:
    """Percent of rows where the condition holds; NULL counts as not holding."""
    return F.sum(F.when(condition, 1).otherwise(0)) / F.count(F.lit(1)) * 100


def unit_hash(key: Column, seed: int = 42) -> Column:
    """Reproducible uniform value in [0, 1) for a key and a seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
