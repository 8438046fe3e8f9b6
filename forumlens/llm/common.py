"""Helpers the operators share: table reading, staged tables, row batches and word hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import stage

__all__ = ["digest128", "hash_words", "mix64", "read", "runs", "slices", "stage", "word_table"]

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes hashed in one go; arrays of eight bytes a character stay small whatever a text's length.
PIECE = 1 << 18
#: Bytes of text that an operator works on at a time, at least one text.
SLICE = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that `column` holds about `limit` bytes in each, one row at least."""
    for batch in batches:
        at, rows = 0, batch.num_rows
        if not rows:
            continue
        lengths = batch.column(column)
        sizes = np.array([v or 0 for v in pc.binary_length(lengths).to_pylist()], dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        while at < rows:
            end = int(np.searchsorted(total, total[at] + limit, side="right")) - 1
            end = min(rows, max(end, at + 1))
            yield batch.slice(at, end - at)
            at = end
        # Workers live on from task to task; what Arrow has freed goes back to the machine.
        pa.default_memory_pool().release_unused()


def separators(extra: bytes = b"") -> np.ndarray:
    """Byte table that is true where a byte stands between words."""
    table = np.zeros(256, dtype=bool)
    table[list(WHITE + extra)] = True
    return table


SPACE = separators()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, PIECE)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PIECE)


def _hash_block(raw: bytes, space: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one block, and its bytes."""
    global _UP, _DOWN
    buf = np.frombuffer(raw, dtype=np.uint8)
    inside = np.concatenate([[False], ~space[buf], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if len(buf) > len(_UP):
        _UP, _DOWN = _powers(_BASE, len(buf)), _powers(pow(_BASE, -1, 1 << 64), len(buf))
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[LOWER[buf] if lower else buf] * _UP[: len(buf)], out=total[1:])
    sums = (total[ends] - total[starts]) * _DOWN[starts]
    return mix64(sums + (ends - starts).astype(np.uint64)), starts, ends, buf


def _blocks(texts: Sequence[bytes], space: np.ndarray) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of text of about one piece: bytes, where each part begins, its text and its place there.

    Texts longer than a piece are cut before white space.
    """
    gap = re.compile(b"[" + re.escape(bytes(np.flatnonzero(space).tolist())) + b"]")
    parts: list[bytes] = []
    owners: list[int] = []
    places: list[int] = []
    size = 0

    def block() -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        return b" ".join(parts), begin, np.array(owners), np.array(places)

    for owner, raw in enumerate(texts):
        at = 0
        while at < len(raw):
            end = len(raw)
            if end - at > PIECE:
                cut = gap.search(raw, at + PIECE)
                end = cut.start() if cut else end
            if size and size + end - at > PIECE:
                yield block()
                parts, owners, places, size = [], [], [], 0
            parts.append(raw[at:end])
            owners.append(owner)
            places.append(at)
            size += end - at + 1
            at = end
    if parts:
        yield block()


def hash_words(texts: Sequence[bytes], space: np.ndarray = SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of `texts`, and where each text's words begin and end among them.

    Texts are hashed in blocks; a text longer than a block is cut between words. `lower` folds A-Z.
    """
    hashes = [np.zeros(0, dtype=np.uint64)]
    counts = np.zeros(len(texts), dtype=np.int64)
    for raw, begin, owners, _ in _blocks(texts, space):
        found, starts, _, _ = _hash_block(raw, space, lower)
        np.add.at(counts, owners, np.diff(np.searchsorted(starts, begin)))
        hashes.append(found)
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(counts)])


def word_table(texts: Sequence[bytes]) -> dict[str, np.ndarray]:
    """Words of all texts: hash, start in the text's bytes, last byte, line feed before it; `at` borders the texts."""
    columns: list[tuple[np.ndarray, ...]] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for raw, begin, owners, places in _blocks(texts, SPACE):
        found, starts, ends, buf = _hash_block(raw, SPACE, True)
        part = np.searchsorted(begin, starts, side="right") - 1
        np.add.at(counts, owners, np.bincount(part, minlength=len(owners)))
        feeds = np.concatenate([[0], np.cumsum(buf == 10, dtype=np.int32)])
        since = np.maximum(np.concatenate([[0], ends[:-1]]), begin[part]) if len(starts) else starts
        columns.append((found, starts - begin[part] + places[part], buf[ends - 1], feeds[starts] > feeds[since]))
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, bool))
    joined = [np.concatenate(c) for c in zip(empty, *columns)]
    return dict(zip(("hash", "start", "last", "feed"), joined)) | {"at": np.concatenate([[0], np.cumsum(counts)])}


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` neighbouring words, by its first word."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[k : k + n]
    return mix64(out)


def digest128(*columns) -> list:
    """Two independent 64-bit hashes that together name a value."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
