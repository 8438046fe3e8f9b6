"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import hash_words, mix64, runs, separators, slices

#: Edits allowed for each hundred words of an item.
EDIT_PERCENT = 20
#: Items of fewer words are not searched: their words meet by chance.
MIN_WORDS = 5
#: Embedded positions that one repetition samples at most: fewer find more distant copies, more leave less to verify.
SAMPLED = 4
RECALL = 0.97
#: Repetitions that a class of lengths can have, those that are tried for any number of samples first, and the changed
#: copies on which it is measured. Half the misses that the recall allows may be seen on so few copies.
REPEATS = (6, 12, 24, 48, 96, 192)
FEW_REPEATS, MAX_REPEATS = 48, REPEATS[-1]
TRIALS = 192
SEEN = 1 - (1 - RECALL) / 2
#: Lengths below are measured each for itself, those above in classes.
SINGLE_WORDS = 30
#: Meetings of word pairs that are looked at together, one text at least.
MEETINGS = 1 << 21
#: Characters of benchmark text that one pass holds in every task; a larger benchmark takes more passes.
PASS_CHARS = 16_000_000

_SEPARATORS = separators(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_NONE = np.uint64(0x5DEECE66D)
_STEP = np.uint64(0x9E3779B97F4A7C15)
CLASSES = 64
#: Walks that run side by side at most, and words that they write down together.
WALKS, WRITTEN = 16_384, 1 << 22


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words without ASCII punctuation, and the borders between texts."""
    return hash_words(texts, _SEPARATORS)


@lru_cache(maxsize=4096)
def sampled_positions(length: int, repeats: int) -> np.ndarray:
    """Embedded positions that each repetition reads for items of `length` words: (repetition, sample).

    A walk leaves its string after about twice its length; later positions would all hold the same filler.
    """
    rng = np.random.default_rng([length, 7])
    return np.stack([rng.choice(2 * length, SAMPLED, replace=False) for _ in range(MAX_REPEATS)])[:repeats]


def walk_keys(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, repeats: int, samples: list[int]
) -> list[np.ndarray]:
    """LSH keys (window, repetition) of the windows [start, start + length), cut at `ends`, for each number of samples.

    The CGK walk writes the word under its pointer at every step, and a random bit that depends on the
    step and the word says whether the pointer moves on; two similar strings soon walk in step again after
    an edit, so edit distance becomes Hamming distance. A key hashes the words at the first sampled positions.
    """
    sampled = {int(n): sampled_positions(int(n), repeats) for n in np.unique(lengths)}
    out = [np.zeros((len(starts), repeats), dtype=np.uint64) for _ in samples]
    rows = max(1, min(WALKS, WRITTEN // (2 * int(lengths.max(initial=1)))) // repeats)
    number = np.arange(repeats, dtype=np.uint64)
    for low in range(0, len(starts), rows):
        own = slice(low, low + rows)
        count = len(starts[own])
        at = np.repeat(starts[own], repeats)
        last = np.repeat(np.minimum(starts[own] + lengths[own], ends[own]), repeats)
        read = np.concatenate([sampled[int(n)] for n in lengths[own]])
        seeds = np.tile((number + np.uint64(1)) * np.uint64(0xD1342543DE82EF95), count)
        path = np.zeros((int(read.max()) + 1, len(at)), dtype=np.uint64)
        for step in range(len(path)):
            word = np.where(at < last, words[np.minimum(at, len(words) - 1)], _NONE)
            path[step] = word
            bit = (word ^ seeds) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            bit *= np.uint64(0xBF58476D1CE4E5B9)
            bit ^= bit >> np.uint64(29)
            bit *= np.uint64(0x94D049BB133111EB)
            at += (bit >> np.uint64(63)).astype(np.int64)
        key = seeds * np.repeat(lengths[own], repeats).astype(np.uint64)
        for k in range(max(samples)):
            key = mix64(key * _STEP + path[read[:, k], np.arange(len(at))])
            if k + 1 in samples:
                out[samples.index(k + 1)][own] = key.reshape(count, repeats)
    return out


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the part of `text` nearest to `item` in word edits; the first, shortest one on ties."""

    def ends(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, dtype=np.int64) if free else steps.copy()
        for k, word in enumerate(a, 1):
            new = np.concatenate([[k], np.minimum(row[:-1] + (b != word), row[1:] + 1)])
            row = np.minimum.accumulate(new - steps) + steps
        return row

    row = ends(item, text, True)
    end = int(row.argmin())
    distance = int(row[end])
    back = ends(item[::-1], text[:end][::-1], False)
    return distance, end - int(np.flatnonzero(back == distance)[0]) if (back == distance).any() else 0, end


@dataclass(frozen=True)
class Pairs:
    """Rare word pairs of items that walks don't find often enough: sorted hashes, item and place of each.

    `need` of an item's pairs are left in any part of a text within the limit.
    """

    hash: np.ndarray
    item: np.ndarray
    place: np.ndarray
    need: np.ndarray

    @staticmethod
    def build(items: list[np.ndarray], exact: list[int]) -> Pairs:
        """Each item gives its rarest pairs, so many that those an edit can break leave some over.

        Pairs that very many items share are left out where an item has enough others.
        """
        grams = [runs(items[k], 2) for k in exact]
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *grams])
        _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
        often = np.split(times[code], np.cumsum([len(g) for g in grams]))
        need = np.zeros(len(items), dtype=np.int64)
        found = [(flat[:0], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for k, g, n in zip(exact, grams, often):
            broken = 2 * (len(items[k]) * EDIT_PERCENT // 100)
            rare = g[np.lexsort((g, n))[: broken + max(1, (len(g) - broken) // 2)]]
            place = np.flatnonzero(np.isin(g, rare))
            need[k] = len(place) - broken
            found.append((g[place], np.full(len(place), k), place))
        own, item, place = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(own, kind="stable")
        return Pairs(own[order], item[order], place[order], need)


@dataclass(frozen=True)
class Index:
    """Items of one pass: those found by walks, by repetitions and length, and the pairs of all others.

    `walked` has, by samples and repetitions, the items of each length, the sorted keys and the item of each key.
    """

    ids: list
    items: list
    walked: dict
    pairs: Pairs

    @staticmethod
    def build(rows: list[tuple]) -> Index:
        words, at = words_of([text for _, text in rows])
        kept = [(i, words[a:b]) for (i, _), a, b in zip(rows, at[:-1], at[1:]) if b - a >= MIN_WORDS]
        ids, items = [i for i, _ in kept], [w for _, w in kept]
        repeats = repeats_by_length(items)
        own: dict[tuple[int, int], list[int]] = {}
        for k, w in enumerate(items):
            own.setdefault(repeats[len(w)], []).append(k)
        pairs = Pairs.build(items, own.pop(NEVER, []))
        walked = {}
        for (samples, n), numbers in sorted(own.items()):
            by_length: dict[int, list[int]] = {}
            for k in numbers:
                by_length.setdefault(len(items[k]), []).append(k)
            sizes = np.array([len(items[k]) for k in numbers], dtype=np.int64)
            ends = np.cumsum(sizes)
            keys = walk_keys(np.concatenate([items[k] for k in numbers]), ends - sizes, ends, sizes, n, [samples])[0].ravel()
            order = np.argsort(keys, kind="stable")
            walked[samples, n] = by_length, keys[order], np.array(numbers)[order // n]
        return Index(ids, items, walked, pairs)


#: Samples and repetitions of lengths whose copies no number of repetitions finds often enough.
NEVER = (0, 0)


def repeats_by_length(items: list[np.ndarray]) -> dict[int, tuple[int, int]]:
    """Samples and repetitions for each length of item."""
    classes: dict[tuple, list[np.ndarray]] = {}
    for item in items:
        n = len(item)
        classes.setdefault((0, n) if n < SINGLE_WORDS else (1, int(math.log(n, 1.25))), []).append(item)
    out = {}
    for own in classes.values():
        out.update(dict.fromkeys({len(item) for item in own}, repeats_for(own)))
    return out


def repeats_for(items: list[np.ndarray], target: float = SEEN) -> tuple[int, int]:
    """Samples and repetitions that find items changed as far as the limit allows.

    The most samples that few repetitions do for, else two or one with more. Measured on copies of the longest items. As in
    a search, a copy stands in other words, and its window begins with its first pair that is whole.
    """
    for repeats, choices in ((FEW_REPEATS, range(SAMPLED, 1, -1)), (MAX_REPEATS, range(2, 0, -1))):
        missed = _misses(items, repeats, list(choices))
        for samples, share in zip(choices, missed):
            for n in REPEATS:
                if n <= repeats and share[n - 1] <= 1 - target:
                    return samples, n
    return NEVER


def _misses(items: list[np.ndarray], repeats: int, choices: list[int]) -> np.ndarray:
    """For each number of samples, the share of changed copies that 1, 2, ... repetitions miss."""
    rng = np.random.default_rng(11)
    sample = sorted(items, key=len, reverse=True)[:24]
    misses = np.zeros((len(choices), repeats))
    each = -(-TRIALS // len(sample))
    for item in sample:
        copies = [_changed(item, rng) for _ in range(each)]
        whole = [int(np.isin(runs(c, 2), runs(item, 2)).argmax()) for c in copies]
        more = rng.integers(1 << 62, size=len(item)).astype(np.uint64)
        parts = [item, *[np.concatenate([c, more]) for c in copies]]
        ends = np.cumsum([len(p) for p in parts])
        starts = ends - [len(p) for p in parts] + [0, *whole]
        for k, own in enumerate(walk_keys(np.concatenate(parts), starts, ends, np.full(len(starts), len(item)), repeats, choices)):
            misses[k] += (~np.logical_or.accumulate(own[1:] == own[0], axis=1)).sum(axis=0)
    return misses / (each * len(sample))


def _changed(item: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A copy with as many word edits as the limit allows."""
    out = item.tolist()
    for _ in range(len(item) * EDIT_PERCENT // 100):
        kind, at = rng.integers(3), int(rng.integers(len(out)))
        new = int(rng.integers(1 << 62))
        out[at : at + (kind != 1)] = [] if kind == 2 else [new]
    return np.array(out, dtype=np.uint64)


class Finder:
    """Finds the items of an index in batches of texts."""

    def __init__(self, index: Index):
        self.index = index
        self.groups: dict[tuple[int, int], list] = {n: [] for n in index.walked}
        self.grams = [runs(words, 2) for words in index.items]
        for n, (by_length, _, _) in index.walked.items():
            lengths = sorted(by_length)
            for low in range(0, len(lengths), CLASSES):
                own = lengths[low : low + CLASSES]
                grams = [np.concatenate([self.grams[k] for k in by_length[length]]) for length in own]
                bits = max(16, math.ceil(math.log2(16 * sum(map(len, grams)))))
                mask = np.uint64((1 << bits) - 1)
                table = np.zeros(1 << bits, dtype=np.uint64)
                for c, g in enumerate(grams):
                    table[(g & mask).astype(np.int64)] |= np.uint64(1 << c)
                self.groups[n].append((own, table, mask))

    def walked(self, grams: np.ndarray, words: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """(window start, item) pairs whose keys meet; `ends` holds the end of each word's text.

        A window is looked at only if enough of its word pairs occur in some item of its length. An edit
        breaks two pairs of an item at most, so no window within the limit is left out; it is taken from
        the first pair that is whole.
        """
        inside = ends[:-1] == ends[1:]
        pairs = set()
        for (samples, repeats), (_, keys, items) in self.index.walked.items():
            starts, lengths = [], []
            for own, table, mask in self.groups[samples, repeats]:
                classes = table[(grams & mask).astype(np.int64)]
                some = np.flatnonzero((classes != 0) & inside)
                classes = classes[some]
                for c, n in enumerate(own):
                    known = some[(classes >> np.uint64(c)) & np.uint64(1) == 1]
                    upto = np.searchsorted(known, np.minimum(known + n, ends[known]) - 1)
                    starts.append(known[upto - np.arange(len(known)) >= n - 1 - 2 * (n * EDIT_PERCENT // 100)])
                    lengths.append(np.full(len(starts[-1]), n))
            at, size = np.concatenate(starts), np.concatenate(lengths)
            own = walk_keys(words, at, ends[at], size, repeats, [samples])[0]
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            window, repeat = np.nonzero(low < high)
            low, met = low[window, repeat], (high - low)[window, repeat]
            nth = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met)
            item = items[np.repeat(low, met) + nth]
            code = np.unique(item * len(words) + np.repeat(at[window], met))
            pairs.update(zip((code % len(words)).tolist(), (code // len(words)).tolist()))
        return pairs

    def paired(self, grams: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(start, item) of every part of a text that holds enough of an item's rare pairs; `at` borders the texts.

        A pair that edits leave whole stands as far behind the part's start as in the item, give or take the
        words put in and taken out before it. So pairs that belong together have starts that differ by the
        limit at most, and no part within the limit is left out.
        """
        rare = self.index.pairs
        pairs: set[tuple[int, int]] = set()
        if not len(rare.hash) or not len(grams):
            return pairs
        low = np.searchsorted(rare.hash, grams, "left")
        met = np.searchsorted(rare.hash, grams, "right") - low
        met[at[1:-1][(at[1:-1] > 0) & (at[1:-1] <= len(met))] - 1] = 0
        total = np.concatenate([[0], np.cumsum(met), [met.sum()]])
        texts, first = len(at) - 1, 0
        while first < texts:
            last = int(np.searchsorted(total[at], total[at[first]] + MEETINGS, side="right")) - 1
            last = min(texts, max(last, first + 1))
            some = np.flatnonzero(met[at[first] : at[last]]) + at[first]
            first = last
            if not len(some):
                continue
            word = np.repeat(some, met[some])
            nth = np.arange(len(word)) - np.repeat(np.cumsum(met[some]) - met[some], met[some])
            pair = np.repeat(low[some], met[some]) + nth
            item, text = rare.item[pair], np.searchsorted(at, word, side="right") - 1
            start = word - rare.place[pair]
            order = np.lexsort((start, text, item))
            item, text, start = item[order], text[order], start[order]
            until = np.arange(len(item)) + rare.need[item] - 1
            fits = np.flatnonzero(until < len(item))
            until = until[fits]
            limit = np.array([len(w) * EDIT_PERCENT // 100 for w in self.index.items])[item[fits]]
            fits = fits[(item[until] == item[fits]) & (text[until] == text[fits]) & (start[until] - start[fits] <= limit)]
            middle = fits + rare.need[item[fits]] // 2
            pairs.update(zip(np.maximum(start[middle], at[text[middle]]).tolist(), item[middle].tolist()))
        return pairs

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item, first word, end word, distance) of every verified occurrence."""
        words, at = words_of(texts)
        if not len(words):
            return []
        ends = np.repeat(at[1:], np.diff(at))
        grams = runs(words, 2)
        starts = self.walked(grams, words, ends) | self.paired(grams, at)
        if not starts:
            return []
        start, item = np.array(sorted(starts, key=lambda p: (p[1], p[0])), dtype=np.int64).T
        text = np.searchsorted(at, start, side="right") - 1
        # Starts of one item that are no further apart than its length lie in one part of a text.
        size = np.array([len(w) for w in self.index.items])[item]
        new = np.ones(len(start), dtype=bool)
        new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (start[1:] - start[:-1] > size[1:])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        found = []
        for own, k, a, b in zip(text[first].tolist(), item[first].tolist(), start[first].tolist(), start[last].tolist()):
            query = self.index.items[k]
            limit = len(query) * EDIT_PERCENT // 100
            # Before its first whole pair a copy has two words for each edit, and those put in.
            parts = [(max(int(at[own]), a - 3 * limit), min(int(at[own + 1]), b + len(query) + 2 * limit))]
            while parts:
                low, high = parts.pop()
                part = words[low:high]
                if len(part) < len(query) - limit or np.isin(self.grams[k], runs(part, 2)).sum() < len(query) - 1 - 2 * limit:
                    continue
                distance, begin, end = best_match(query, part)
                if distance <= limit:
                    found.append((own, k, low + begin - int(at[own]), low + end - int(at[own]), distance))
                    parts += [(low, low + begin), (low + end, high)]
        return sorted(found)


def _passes(benchmark: DataFrame) -> Iterator[Index]:
    """The indexes of the benchmark's parts, one at a time; the driver holds no more than one."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    parts = -(-chars // PASS_CHARS)
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    for k in range(parts):
        own = rows.where(spread == k).collect()
        index = Index.build(sorted(((r.item_id, r.text.encode()) for r in own), key=lambda r: (str(r[0]), r[1])))
        if index.items:
            yield index


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b"" if v is None else v for v in batch.column("text").cast(pa.binary()).to_pylist()]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Occurrences of benchmark items in documents: doc_id, item_id, first_word, end_word, distance, item_words.

    Words are lower-cased (A-Z) and freed of ASCII punctuation; an occurrence is a part of a document
    within one word edit for each five words of the item. Items of fewer than five words, and null texts
    on either side, take no part; empty tables give an empty result; a null doc_id stays null. Rows that
    repeat are searched each for itself. Whole texts are searched. The samples of a key and the number of repetitions
    are measured by length for a recall of 0.97 at the largest distance allowed; nearer copies are found more surely,
    exact ones always. Should a length not reach it with one sample and 192 repetitions, every part of a text that
    holds enough of an item's word pairs is verified, which misses none. The benchmark goes to the tasks in passes of
    at most 16 million characters.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, first_word long, end_word long, distance long, item_words long"

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(index)
            for batch in slices(batches, "text"):
                ids = batch.column("doc_id").to_pylist()
                found = [
                    (ids[d], index.ids[i], a, b, distance, len(index.items[i]))
                    for d, i, a, b, distance in finder.find(_texts(batch))
                ]
                columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 6)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "item_id", "first_word", "end_word", "distance", "item_words"]
                )

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for index in _passes(benchmark):
        out = out.unionByName(rows.mapInArrow(search(index), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which `find_leaks` finds nothing, with all their columns."""

    def search(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder(index)
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[d for d, *_ in finder.find(_texts(batch))]] = False
                yield batch.filter(pa.array(keep))

        return run

    for index in _passes(benchmark):
        docs = docs.mapInArrow(search(index), docs.schema)
    return docs
