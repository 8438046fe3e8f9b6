"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import WHITE, hash_words, mix64, runs, slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "upper_share",
    "digit_share",
    "stops_per_word",
    "bangs_per_word",
    "commas_per_word",
    "words_per_line",
)
#: More of these never raises the score.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "bangs_per_word": -1}
#: Labelled rows the trees are fitted on at most; the rows with the least hashes of doc_id are taken.
MAX_TRAINING_ROWS = 20_000


def _repeats(keys: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a key occurs again in its text, and the number of different keys of each text."""
    own = mix64(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own)
    new = np.concatenate([[True], own[order][1:] != own[order][:-1]]) if len(own) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    again = np.zeros(len(own), dtype=bool)
    again[order] = np.repeat(np.diff(np.append(first, len(own))) > 1, np.diff(np.append(first, len(own))))
    return again, np.bincount(owner[order[first]], minlength=owners)


def statistics(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The five base counts of each text, and the features as a matrix (text, feature)."""
    n = len(texts)
    words, at = hash_words(texts, lower=False)
    n_words = np.diff(at)
    owner = np.repeat(np.arange(n), n_words)
    windows = runs(words, 3)
    inside = owner[:-2] == owner[2:] if len(words) >= 3 else np.zeros(0, dtype=bool)
    again, _ = _repeats(windows[inside], owner[:-2][inside], n) if len(words) >= 3 else (np.zeros(0, bool), None)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[np.flatnonzero(inside)[again] + k] = True
    n_repeat = np.bincount(owner[covered], minlength=n)
    _, distinct = _repeats(words, owner, n)
    bytes_of = np.zeros((n, 256), dtype=np.int64)
    n_lines, n_dup = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i, raw in enumerate(texts):
        bytes_of[i] = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        lines = [line for line in raw.split(b"\n") if line.strip()]
        n_lines[i], n_dup[i] = len(lines), len(lines) - len(set(lines))
    total = lambda which: bytes_of[:, list(which)].sum(axis=1)
    word_chars = bytes_of.sum(axis=1) - bytes_of[:, 128:192].sum(axis=1) - total(WHITE)
    upper, lower = bytes_of[:, 65:91].sum(axis=1), bytes_of[:, 97:123].sum(axis=1)
    counts = dict(zip(COUNTS, (n_words, word_chars, total(SYMBOLS), n_dup, n_repeat)))
    some = np.maximum(n_words, 1)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / some,
            counts["n_symbols"] / np.maximum(word_chars, 1),
            n_dup / np.maximum(n_lines, 1),
            n_repeat / some,
            distinct / some,
            upper / np.maximum(upper + lower, 1),
            bytes_of[:, 48:58].sum(axis=1) / np.maximum(word_chars, 1),
            total(b".?") / some,
            total(b"!") / some,
            total(b",;:") / some,
            n_words / np.maximum(n_lines, 1),
        ],
        axis=1,
    )
    return counts, features


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth as flat arrays: (tree, inner node) and (tree, leaf)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each row; all rows and trees step down one level at a time."""
        depth = int(np.log2(self.value.shape[1]))
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), dtype=np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(depth):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        margin = self.start + self.value[trees, node - (2**depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 48,
    l2: float = 1.0,
) -> Trees:
    """Boosted trees for the log-odds of y; `signs` holds 1, -1 or 0 (free) for each feature.

    A split that breaks its feature's sign is not taken, and the leaves under a constrained split stay on
    their side of the middle between its two values, so the sum of trees is monotonic as a whole.
    """
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(k)], axis=1)
    limits = np.full((k, bins), np.inf)
    for j in range(k):
        limits[j, : len(edges[j])] = edges[j]
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * k + np.arange(k)) * bins + binned
            sums = [
                np.bincount(cell.ravel(), np.repeat(w, k), width * k * bins).reshape(width, k, bins) for w in (g, h)
            ]
            left = [np.cumsum(s, axis=2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            right = [a - b for a, b in zip(whole, left)]
            lo, hi = (b[first : first + width, None, None] for b in (low, high))
            best = [np.clip(-a / (b + l2), lo, hi) for a, b in (left, right, whole)]
            loss = [a * w + 0.5 * (b + l2) * w * w for (a, b), w in zip((left, right, whole), best)]
            gain = loss[2] - loss[0] - loss[1]
            sign = signs[None, :, None]
            gain[(sign * (best[1] - best[0]) < 0) | (left[1] < 1) | (right[1] < 1) | ~np.isfinite(limits)[None]] = -np.inf
            flat = gain.reshape(width, -1)
            chosen = flat.argmax(axis=1)
            for m in range(width):
                here, at = first + m, chosen[m]
                low[[2 * here + 1, 2 * here + 2]], high[[2 * here + 1, 2 * here + 2]] = low[here], high[here]
                if not flat[m, at] > 1e-6:
                    continue
                j, b = divmod(int(at), bins)
                feature[t, here], threshold[t, here] = j, limits[j, b]
                if signs[j]:
                    middle = (best[0][m, j, b] + best[1][m, j, b]) / 2
                    upper, lower = (2 * here + 2, 2 * here + 1) if signs[j] > 0 else (2 * here + 1, 2 * here + 2)
                    low[upper], high[lower] = middle, middle
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        value[t] = rate * np.clip(-gs / (hs + l2), low[inner:], high[inner:])
        margin += value[t, leaf]
    return Trees(feature, threshold, value, start)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b"" if v is None else v for v in batch.column("text").cast(pa.binary()).to_pylist()]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        _, x = statistics(_texts(batch))
        columns = [batch.column("doc_id"), batch.column("quality"), *(pa.array(x[:, j]) for j in range(x.shape[1]))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", *FEATURES])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Trees | None:
    """Trees fitted on at most `max_rows` labelled documents, or None if the labels don't hold both classes.

    `labels` has doc_id and quality (1 good, 0 bad); a doc_id labelled both ways counts as bad, rows with
    nulls are left out. The bounded sample is chosen by hash, so it is the same in every run.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("long")).alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(marked), "doc_id")
    schema = "doc_id long, quality long, " + ", ".join(f"{f} double" for f in FEATURES)
    sample = rows.mapInArrow(_measure, schema).groupBy("doc_id").agg(F.min(F.struct("quality", *FEATURES)).alias("r"))
    data = sample.select("doc_id", "r.*").toPandas().sort_values("doc_id")
    y = data["quality"].to_numpy(dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return None
    signs = np.array([MONOTONE.get(f, 0) for f in FEATURES])
    return fit_trees(data[list(FEATURES)].to_numpy(dtype=np.float64), y, signs)


def _verdicts(texts: list[bytes], model: Trees | None, threshold: float) -> dict[str, np.ndarray]:
    counts, x = statistics(texts)
    failed = (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )
    score = model.probability(x) if model is not None else np.ones(len(texts))
    return counts | {"base_failed": failed, "kept": ~failed & (score >= threshold), "quality_score": score}


def judge(docs: DataFrame, model: Trees | None, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, quality_score.

    Words are runs without ASCII white space; null and empty texts have none and fail the base rule.
    Without a model the base rule decides alone. Only doc_id and text are read, so other columns don't
    matter; rows that repeat are judged each for itself, and an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = _verdicts(_texts(batch), model, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v) for v in found.values())], names=["doc_id", *found]
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", base_failed boolean, kept boolean, quality_score double"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Trees | None, threshold: float = 0.5) -> DataFrame:
    """The rows that `judge` keeps, with all their columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(_verdicts(_texts(batch), model, threshold)["kept"]))

    return docs.mapInArrow(run, docs.schema)
