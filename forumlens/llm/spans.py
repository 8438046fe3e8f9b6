"""Substring dedup: runs of consecutive sentences that occurred before are removed."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import mix64, slices, word_table

#: Sentences and words that a span has at least.
MIN_SENTENCES = 2
MIN_WORDS = 20
#: Sentences of more words are cut into clauses, and long clauses after one word in so many.
LONG_SENTENCE = 24
CUT_EVERY = 12

_FULL, _HALF = (np.isin(np.arange(256), list(marks)) for marks in (b".!?", b",;:"))
_BASES = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Sentences:
    """The sentences of several texts: first words, first bytes, and where each text's sentences begin."""

    words: np.ndarray
    first: np.ndarray
    byte: np.ndarray
    at: np.ndarray


def sentences(texts: list[bytes]) -> Sentences:
    """Cut texts into sentences; a text without a word has none.

    A sentence ends with a word that ends in a full stop or mark, or before a line feed. Long ones are cut after
    commas and colons too, and where that leaves long clauses, after words chosen by their hash, so that equal
    passages are cut alike wherever they stand. A sentence's bytes reach up to the next one's first word.
    """
    table = word_table(texts)
    n, at = len(table["hash"]), table["at"]
    begins = np.zeros(n + 1, dtype=bool)
    begins[at] = True
    begins[1:n] |= table["feed"][1:] | _FULL[table["last"][:-1]]
    for more in (_HALF[table["last"]], mix64(table["hash"]) % np.uint64(CUT_EVERY) == 0):
        first = np.flatnonzero(begins)
        length = np.diff(first)
        long = np.repeat(length > LONG_SENTENCE, length) if n else np.zeros(0, dtype=bool)
        begins[1:] |= more & long
    first = np.flatnonzero(begins)
    return Sentences(table["hash"], first, table["start"][first[:-1]], np.searchsorted(first, at))


def spans(s: Sentences, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> tuple[np.ndarray, ...]:
    """(text, first sentence, end sentence, hash, hash) of all spans, sentences counted within their text.

    A span is the shortest long enough run of sentences from a sentence on. Where no such run ends with a
    sentence, the shortest one up to it is a span as well, so that the end of a passage is covered.
    """
    count = len(s.first) - 1
    start = np.arange(count)
    owner = np.searchsorted(s.at, start, side="right") - 1
    low, high = s.at[owner], s.at[owner + 1]
    end = np.maximum(start + min_sentences, np.searchsorted(s.first, s.first[:-1] + min_words))
    fits = end <= high
    ended = np.zeros(count + 1, dtype=bool)
    ended[end[fits]] = True
    last = np.flatnonzero(~ended[1:]) + 1
    back = np.minimum(last - min_sentences, np.searchsorted(s.first, s.first[last] - min_words, side="right") - 1)
    own = (back >= low[last - 1]) if count else np.zeros(0, dtype=bool)
    begin = np.concatenate([start[fits], back[own]])
    until = np.concatenate([end[fits], last[own]])
    order = np.lexsort((until, begin))
    begin, until = begin[order], until[order]
    a, b = s.first[begin], s.first[until]
    found = []
    for base in _BASES:
        up = np.multiply.accumulate(np.full(len(s.words) + 1, base, dtype=np.uint64))
        down = np.multiply.accumulate(np.full(len(s.words) + 1, pow(int(base), -1, 1 << 64), dtype=np.uint64))
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix64(s.words ^ base) * up[:-1])])
        found.append(mix64((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)).view(np.int64))
    text = owner[begin] if count else begin
    return text, begin - s.at[text], until - s.at[text], *found


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b"" if v is None else v for v in batch.column("text").cast(pa.binary()).to_pylist()]


def _occurrences(min_sentences: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, first, until, one, two = spans(sentences(_texts(batch)), min_sentences, min_words)
            again = _again(text, one, two)
            place = (first << 33) | (until << 1) | again
            rows = pa.array(text)
            columns = [batch.column("doc_id").take(rows), batch.column("row_key").take(rows)]
            columns += [pa.array(one), pa.array(two), pa.array(place.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "span_a", "span_b", "place"])

    return run


def _again(text: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether a span came up before in its text."""
    order = np.lexsort((np.arange(len(text)), two, one, text))
    same = (text[order][1:] == text[order][:-1]) & (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    again = np.zeros(len(text), dtype=bool)
    again[order[1:]] = same
    return again


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts, covered = _texts(batch), batch.column("covered").to_pylist()
        found = sentences(texts)
        kept, total, removed = batch.column("text").to_pylist(), [], []
        for row, (raw, places) in enumerate(zip(texts, covered)):
            low, high = found.at[row], found.at[row + 1]
            total.append(int(high - low))
            change = np.zeros(high - low + 1, dtype=np.int64)
            for place in places or ():
                change[place >> 33] += 1
                change[(place >> 1) & 0xFFFFFFFF] -= 1
            gone = np.cumsum(change)[:-1] > 0
            removed.append(int(gone.sum()))
            if removed[-1]:
                cuts = [0, *found.byte[low + 1 : high].tolist(), len(raw)]
                kept[row] = b"".join(raw[a:b] for a, b, g in zip(cuts[:-1], cuts[1:], gone) if not g).decode()
        columns = [batch.column("doc_id"), pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_sentences", "n_removed"])


def remove_repeats(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without the sentences that a repeated span covers, unless it is the span's first occurrence.

    From each sentence on, the shortest run of at least two sentences and twenty words is a span, and so is the
    shortest run up to a sentence with which none of those ends. Words are compared with A-Z lower-cased; white
    space doesn't count. A span's first occurrence is the earliest in the document with the smallest doc_id.
    Returns doc_id, text, n_sentences and n_removed for each row. Null and empty texts stay as they are; rows
    without a doc_id come last and don't count as repeats of one another; rows that repeat doc_id and text are
    one document; other columns are ignored; empty tables give an empty result.

    Spans are named by 128-bit hashes. Finding the smallest doc_id of those that repeat is a grouped minimum taken
    in map tasks first; the join back meets one row per repeated span, so a span shared by very many documents is
    split over tasks. No text travels with a span.
    """
    last = F.lit((1 << 63) - 1)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text"))
    found = rows.mapInArrow(
        _occurrences(min_sentences, min_words), "doc_id long, row_key long, span_a long, span_b long, place long"
    )
    rank = F.coalesce("doc_id", last)
    repeated = (
        found.groupBy("span_a", "span_b").agg(F.count("*").alias("n"), F.min(rank).alias("first_doc")).where("n > 1").drop("n")
    )
    covered = (
        found.join(repeated, ["span_a", "span_b"])
        .where((F.col("place").bitwiseAND(F.lit(1)) == 1) | (rank > F.col("first_doc")))
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set("place").alias("covered"))
    )
    same = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.row_key") == F.col("c.row_key"))
    return (
        rows.alias("r")
        .join(covered.alias("c"), same, "left")
        .select("r.doc_id", "r.text", "c.covered")
        .mapInArrow(_cut, "doc_id long, text string, n_sentences long, n_removed long")
    )
