"""Periodic runs: stretches of words that repeat three times or more, found by internal pattern matching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import mix64, slices

MIN_WORDS = 24
MIN_REPEATS = 3
#: Words of the least block: a run of MIN_WORDS words whose period is shorter holds an aligned block and its next
#: occurrence, as MIN_WORDS is three times as long.
BLOCK = MIN_WORDS // 3


class WaveletMatrix:
    """Order statistics of any stretch of an array of numbers; a bit a number and level, and counts of them."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        n = len(values)
        for bit in range(bits - 1, -1, -1):
            ones = ((values >> bit) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(n // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            upto = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((bit, words, upto, n - int(upto[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(level: tuple[int, np.ndarray, np.ndarray, int], at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        _, words, upto, _ = level
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return upto[word] + np.bitwise_count(words[word] & below)

    def count_less(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers at places lo to hi (exclusive) are less than `value`."""
        out = np.zeros(len(lo), dtype=np.int64)
        for level in self.levels:
            bit, _, _, zeros = level
            a, b = self._ones(level, lo), self._ones(level, hi)
            up = ((value >> bit) & 1).astype(bool)
            out += np.where(up, (hi - b) - (lo - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with `k` smaller ones before it among those at places lo to hi (exclusive)."""
        out = np.zeros(len(lo), dtype=np.int64)
        for level in self.levels:
            bit, _, _, zeros = level
            a, b = self._ones(level, lo), self._ones(level, hi)
            under = (hi - b) - (lo - a)
            up = k >= under
            out |= up.astype(np.int64) << bit
            k = np.where(up, k - under, k)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return out


def block_classes(codes: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """A suffix array by prefix doubling up to `longest` words, and the stretches of equal blocks in it.

    The classes hold, for each block length from BLOCK, the first place of each suffix's class and the class's end by
    first place, for suffixes at multiples of the length only. Only suffixes that are not yet alone are sorted again.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    new = np.concatenate([[True], codes[order][1:] != codes[order][:-1]])
    first = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    classes = []
    length = 1
    while True:
        if length >= BLOCK:
            blocks = np.arange(0, n - length + 1, length)
            size = np.bincount(rank, minlength=n)
            lo = rank[blocks]
            many = size[lo] > 1
            classes.append((length, blocks[many], np.stack([lo[many], lo[many] + size[lo[many]]])))
        if 2 * length > longest:
            return order, classes
        # Places whose suffix shares its class with another one, and the class of what follows the block.
        open_ = np.flatnonzero(np.bincount(rank, minlength=n)[rank[order]] > 1)
        suffixes = order[open_]
        after = np.full(len(suffixes), -1, dtype=np.int64)
        inside = suffixes + length < n
        after[inside] = rank[suffixes[inside] + length]
        within = np.lexsort((after, rank[suffixes]))
        suffixes, after = suffixes[within], after[within]
        order[open_] = suffixes
        old = rank[suffixes]
        new = np.ones(len(suffixes), dtype=bool)
        new[1:] = (old[1:] != old[:-1]) | (after[1:] != after[:-1])
        rank[suffixes] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))] if len(new) else old
        length *= 2


class Matches:
    """Longest common extensions of two places by binary search over prefix hashes modulo two primes."""

    PRIMES = (2147483647, 2147483629)

    def __init__(self, codes: np.ndarray, seed: int = 0):
        n = len(codes)
        self.n = n
        self.tables = []
        for prime in self.PRIMES:
            p = np.uint64(prime)
            values = mix64(codes.astype(np.uint64) + np.uint64(1 + seed)) % p
            base = int(mix64(np.array([prime + seed], dtype=np.uint64))[0]) % (prime - 2) + 2
            powers = np.ones(1, dtype=np.uint64)
            while len(powers) <= n:
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % p])
            powers = powers[: n + 1]
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers[:n] % p, dtype=np.uint64) % p])
            self.tables.append((p, powers.astype(np.uint32), sums.astype(np.uint32)))

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the `length` words from i and from j, which is not before i, are the same."""
        out = np.ones(len(i), dtype=bool)
        for p, powers, sums in self.tables:
            left = (sums[i + length].astype(np.uint64) + p - sums[i]) % p * powers[j - i] % p
            out &= left == (sums[j + length].astype(np.uint64) + p - sums[j]) % p
        return out

    def _search(self, most: np.ndarray, holds) -> np.ndarray:
        """The largest length up to `most` for which `holds`."""
        low, high = np.zeros(len(most), dtype=np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self._search(self.n - j, lambda x: self.equal(i, j, x))

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are the same."""
        return self._search(i, lambda x: self.equal(i - x, j - x, x))

    def stretch(self, i: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch around i in which words `step` apart are the same."""
        return i - self.backward(i, i + step), i + step + self.forward(i, i + step)


def candidates(codes: np.ndarray, longest: int, matches: Matches) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and periods that hold all runs of `codes`: places and distances, with some that are none.

    A run of period q holds, for the largest block length b up to q (or BLOCK), an aligned block that occurs again q words
    on. The occurrences in a window of less than two blocks are an arithmetic progression. Up to two are taken as they are. In
    a longer progression, of step d, the block and its occurrence lie in two stretches of period d, or in one, which then
    is found as a run itself; both ends of the two stretches are a period apart.
    """
    order, classes = block_classes(codes, longest)
    parts = []
    for length, blocks, (lo, hi) in classes:
        parts.append((blocks, lo, hi, blocks + length, blocks + 2 * length))
        if length == BLOCK:
            parts.append((blocks, lo, hi, blocks + 1, blocks + length))
    at, lo, hi, begin, end = (np.concatenate(c) for c in zip(*parts))
    empty = np.zeros(0, dtype=np.int64)
    if not len(at):
        return empty, empty
    # Only suffixes whose block is not alone are asked for; their stretches move together.
    shared = np.zeros(len(order) + 1, dtype=np.int64)
    least = classes[0]
    np.add.at(shared, least[2][0], 1)
    np.add.at(shared, least[2][1], -1)
    kept = np.cumsum(shared[:-1]) > 0
    moved = np.concatenate([[0], np.cumsum(kept)])
    tree = WaveletMatrix(order[kept], int(len(codes)).bit_length() + 1)
    lo, hi = moved[lo], moved[hi]

    before = tree.count_less(lo, hi, begin)
    n = tree.count_less(lo, hi, end) - before
    some = n > 0
    at, lo, hi, before, n = at[some], lo[some], hi[some], before[some], n[some]
    first = tree.smallest(lo, hi, before)
    two = n > 1
    second = tree.smallest(lo[two], hi[two], before[two] + 1)
    places, distances = [at, at[two]], [first - at, second - at[two]]
    many = n[two] > 2
    block, one, step = at[two][many], first[two][many], (second - first[two])[many]
    for here, there in zip(matches.stretch(block, step), matches.stretch(one, step)):
        places.append(block)
        distances.append(there - here)
    place, distance = np.concatenate(places), np.concatenate(distances)
    good = (distance > 0) & (place + distance < len(codes))
    pairs = np.unique(np.stack([place[good], distance[good]]), axis=1)
    return pairs[0], pairs[1]


def runs_of(codes: np.ndarray, longest_text: int | None = None) -> np.ndarray:
    """Start, length and period of all runs, sorted; a run has MIN_REPEATS periods and MIN_WORDS words at least.

    `longest_text` bounds a run's length where several texts are joined by codes that occur once.
    """
    none = np.zeros((0, 3), dtype=np.int64)
    longest = (len(codes) if longest_text is None else longest_text) // MIN_REPEATS
    if 3 * longest < MIN_WORDS:
        return none
    seed = 0
    while True:
        matches = Matches(codes, seed)
        place, period = candidates(codes, max(longest, BLOCK), matches)
        if not len(place):
            return none
        start, end = matches.stretch(place, period)
        long = end - start >= np.maximum(MIN_WORDS, MIN_REPEATS * period)
        found = np.unique(np.stack([start[long], end[long], period[long]], axis=1), axis=0)
        # One stretch may come with multiples of its period; the least one is first.
        new = np.ones(len(found), dtype=bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[new]
        if all(_is_run(codes, *run) for run in found.tolist()):
            return np.stack([found[:, 0], found[:, 1] - found[:, 0], found[:, 2]], axis=1)[np.lexsort((found[:, 2], found[:, 0]))]
        seed += 1


def _is_run(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether words `period` apart are the same in the stretch and in no longer one, by the words themselves."""
    return (
        np.array_equal(codes[start : end - period], codes[start + period : end])
        and (start == 0 or codes[start - 1] != codes[start - 1 + period])
        and (end == len(codes) or codes[end] != codes[end - period])
    )


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and where each text's words begin and end among them."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, at = lists.flatten(), lists.offsets.to_numpy()
    full = pc.not_equal(words, "")
    upto = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), upto[at - at[0]]


RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words, at = _words(batch.column("text"))
        texts, n = len(at) - 1, len(words)
        coded = words.dictionary_encode()
        # One code for each word, and between texts codes that occur once.
        codes = np.empty(n + texts, dtype=np.int64)
        place = np.arange(n) + np.repeat(np.arange(texts), np.diff(at))
        codes[place] = coded.indices.to_numpy(zero_copy_only=False)
        codes[at[1:] + np.arange(texts)] = len(coded.dictionary) + np.arange(texts)
        found = runs_of(codes, int(np.diff(at).max(initial=0)))
        begin = at[:-1] + np.arange(texts)
        owner = np.searchsorted(begin, found[:, 0], side="right") - 1
        found[:, 0] -= begin[owner]
        # Words that a run repeats: all after its first period.
        cover = np.zeros(n + 1, dtype=np.int64)
        np.add.at(cover, at[owner] + found[:, 0] + found[:, 2], 1)
        np.add.at(cover, at[owner] + found[:, 0] + found[:, 1], -1)
        kept = np.cumsum(cover[:-1]) == 0
        upto = np.concatenate([[0], np.cumsum(kept)])
        left = pa.ListArray.from_arrays(pa.array(upto[at], pa.int32()), words.filter(pa.array(kept)))
        runs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], fields=list(RUN))
        per_text = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), runs),
                pc.binary_join(left, " "),
            ],
            ["doc_id", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The periodic runs of every document's whole text, and the text with each run cut to its first period.

    Returns doc_id, runs (start, length and period in words, by start and period) and collapsed, one row per input row.
    Words stand between ASCII white space and are compared as they are. A run is a stretch of at least 24 words and
    three of its smallest period that no neighbouring word extends. Collapsed texts hold the words that no run covers after its first
    period, joined by one space.

    Null and empty texts have no runs and an empty collapsed text. Rows that repeat are worked on each for itself, null
    doc_ids stay null, other columns are ignored, and an empty table gives an empty result. Texts are worked on in
    slices of 4 MB, a longer text alone; memory grows with the words of a slice, time with them times a logarithm.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_find, SCHEMA)


def plant_periods(docs: DataFrame) -> DataFrame:
    """Documents in which every tenth, by the CRC-32 of its id, repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.floor(h / 10).alias("g"), (h % 10).alias("digit"))
    words = texts.withColumn("words", F.when(F.col("digit") == 0, split)).withColumn("n", F.size("words"))
    first = F.expr("g % n")
    period = F.expr("1 + (n - g % n) DIV (3 + g % 8)")
    place = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.when(i < first, i).otherwise(first + (i - first) % period))
    planted = F.array_join(F.transform(place, lambda i: F.get("words", i.cast("int"))), " ")
    return words.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Each document's number of runs, its run of most periods, and digests of its runs and its collapsed text.

    Among runs of as many periods the first one counts, then that of the least period; without a run its columns are null.
    """
    more = "r.length * best.period > best.length * r.period"
    lines = "concat_ws('', transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'))"
    best = f"aggregate(runs, try_element_at(runs, 1), (best, r) -> CASE WHEN {more} THEN r ELSE best END)"
    return (
        found.withColumn("best", F.expr(best))
        .selectExpr(
            "doc_id",
            "CAST(size(runs) AS BIGINT) AS n_runs",
            "best.start",
            "best.length",
            "best.period",
            "1000 * best.length DIV best.period AS exponent_milli",
            f"sha2({lines}, 256) AS runs_sha256",
            "sha2(collapsed, 256) AS collapsed_sha256",
        )
    )
