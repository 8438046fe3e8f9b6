"""Importance resampling towards a target's distribution of hashed n-grams."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import slices, stage
from forumlens.operators.ranking import number_rows

BUCKETS = 10_000
#: Words of the longest run that is a feature.
MAX_WORDS = 2
MIN_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

#: Lower-cases A-Z and blanks what separates words: ASCII other than digits and letters. The bytes of longer UTF-8
#: characters stay as they are.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists; a long text is cut at separators, so that no list holds all its words."""
    text = text.translate(TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        words = text[at:end].split()
        if words:
            yield words
        at = end


def count_features(text: bytes, longest: int = MAX_WORDS, buckets: int = BUCKETS) -> tuple[int, Counter]:
    """Words of a text, and how many of its runs of 1 to `longest` words fall in each bucket.

    A run's CRC-32 goes on from that of the run without its last word, so no run is ever put together.
    """
    found: Counter = Counter()
    n_words = 0
    #: Hash of the run of 1, 2, ... words that ends the lists so far; shorter than `longest` in a text's first words.
    tails: list[int] = []
    for words in words_of(text):
        n_words += len(words)
        spaced = [b" " + w for w in words]
        hashes, ends = list(map(crc32, words)), []
        for size in range(longest):
            found.update([h % buckets for h in hashes])
            if hashes:
                ends.append(hashes[-1])
            # Each run goes on with the word after it; the first word goes on from the list before.
            seeds = tails[size : size + 1] + hashes[:-1]
            hashes = list(map(crc32, spaced[len(words) - len(seeds) :], seeds))
        tails = ends
    return n_words, found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in slices(batches, "text"):
        yield batch, [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _count(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for _, texts in _texts(batches):
            for text in texts:
                total.update(count_features(text, longest, buckets)[1])
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(total.keys(), pa.int64()), "n": pa.array(total.values(), pa.int64())}
        )

    return run


def feature_counts(texts: DataFrame, longest: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """How many features of all texts fall in each bucket: a counter per partition, then their sum."""
    part = texts.select(F.col("text").cast("string")).mapInArrow(_count(longest, buckets), "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = MAX_WORDS, buckets: int = BUCKETS) -> list[int]:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and in the documents.

    Only the buckets' counts, `buckets` numbers for each side, come to the driver.
    """
    s, t = ({r["bucket"]: r["n"] for r in feature_counts(d, longest, buckets).collect()} for d in (docs, target))
    n_s, n_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    ratios = ((float(t.get(b, 0) + 1) * n_s) / (float(s.get(b, 0) + 1) * n_t) for b in range(buckets))
    return [math.floor(1000 * math.log(r)) for r in ratios]


def gumbel(doc: int | None, seed: int) -> int:
    """Thousandths of a draw from the Gumbel distribution that depends on the document's id alone."""
    key = f"{seed}:{'' if doc is None else doc}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCHEMA = "doc_id long, n_words long, n_features long, weight long, score long"


def _score(gain: list[int], longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc, text in zip(ids, texts):
                n_words, found = count_features(text, longest, len(gain))
                n = found.total()
                weight = sum(gain[b] * c for b, c in found.items()) // n if n else 0
                rows.append((doc, n_words, n, weight, weight + gumbel(doc, seed)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    return run


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    min_words: int = MIN_WORDS,
    longest: int = MAX_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Draw `percent` of the documents of at least `min_words` words, in proportion to their likeness to the target.

    Returns doc_id, n_features, weight, score, rank, one row per input row. Words are runs of ASCII digits and letters and
    of all characters beyond ASCII, with A-Z lower-cased; features are runs of 1 to `longest` words, hashed into buckets.
    A document's weight is the floored mean of its features' gains (none: 0); its score adds a Gumbel draw, so that the
    highest scores are a sample without replacement. `rank` counts the drawn from the highest score, ties by the smaller
    doc_id, and is null for all others.

    Null and empty texts have no features and are never drawn. Null doc_ids share one draw and come last among equals.
    Rows that repeat are scored and drawn each for itself. Without documents the result is empty; without a target all
    features count as unseen there. Other columns are ignored. Only narrow rows are sorted, by range over all tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = stage(rows.mapInArrow(_score(gains(docs, target, longest, buckets), longest, seed), SCHEMA))
    drawable = F.col("n_words") >= min_words
    drawn = percent * scored.where(drawable).count() // 100
    ranked = number_rows(scored.where(drawable), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~drawable).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("n_words")
