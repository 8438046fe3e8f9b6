"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import digest128, hash_words, mix64, runs, slices, stage
from forumlens.llm.components import components

WIDTH = 5
BANDS = 24
ROWS = 5
#: Members of a bucket, and shingles of theirs, that stand on one side of a comparison in a task.
BLOCK = 512
BLOCK_SHINGLES = 1 << 19

_SIGMA = (np.uint32(0x7FEB352D), np.uint32(0x846CA68B))
_PI = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def _permute(x: np.ndarray, keys: tuple[np.uint32, np.uint32]) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    shifted = x >> np.uint32(16)
    x ^= shifted
    x *= keys[0]
    np.right_shift(x, np.uint32(13), out=shifted)
    x ^= shifted
    x *= keys[1]
    np.right_shift(x, np.uint32(16), out=shifted)
    x ^= shifted
    return x


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the borders between texts.

    A text with fewer words than `width` has its whole sequence as its one shingle; one without words has none.
    """
    words, at = hash_words(texts)
    counts = np.diff(at)
    grams = runs(words, width)
    whole = np.zeros(len(texts), dtype=np.uint64)
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        whole[i] = runs(words[at[i] : at[i + 1]], int(counts[i]))[0] + np.uint64(counts[i])
    sets = []
    for i, n in enumerate(counts.tolist()):
        if n >= width:
            own = np.sort(grams[at[i] : at[i] + n - width + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            sets.append(whole[i : i + 1] if n else whole[:0])
    borders = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else whole), borders


def band_keys(shingles: np.ndarray, borders: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of each set: circulant MinHash coordinates, hashed by the band.

    Coordinate k is the least value that the permutation pi, shifted circularly by k, gives to a member
    after the permutation sigma. Two permutations of the 32-bit numbers serve all coordinates.
    """
    full = np.flatnonzero(np.diff(borders))
    starts = borders[full]
    placed = _permute((shingles ^ (shingles >> np.uint64(32))).astype(np.uint32), _SIGMA)
    keys = np.zeros((len(borders) - 1, bands), dtype=np.uint64)
    if not len(full):
        return keys.view(np.int64)
    for band in range(bands):
        key = np.full(len(full), band + 1, dtype=np.uint64)
        for row in range(rows):
            least = np.minimum.reduceat(_permute(placed - np.uint32(band * rows + row + 1), _PI), starts)
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[full, band] = key
    return keys.view(np.int64)


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def _signatures(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingles, borders = shingle_sets(_utf8(batch.column("text")))
            counts = np.diff(borders)
            one, two = mix64(shingles), mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))
            total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (one, two)]
            own = [(t[borders[1:]] - t[borders[:-1]]).view(np.int64) for t in total]
            keys = band_keys(shingles, borders, bands, rows)
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(own[0]), pa.array(own[1]), lists],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        shingles, borders = shingle_sets(_utf8(batch.column("text")))
        own = [shingles[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.binary())], names=["rep", "shingles"])


def _similar(percent: int):
    """Keep the pairs of sets that share at least `percent` hundredths of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (left, right))
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block_links(percent: int):
    """Links between different parts of one pair of blocks, as a forest: no more links than members."""

    def run(table: pa.Table) -> pa.Table:
        reps, parts = (table.column(c).to_numpy() for c in ("rep", "part"))
        sets = [np.frombuffer(v.as_py(), dtype=np.uint64) for v in table.column("shingles")]
        root = {p: p for p in parts.tolist()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        rank = np.argsort(flat, kind="stable")
        value, held = flat[rank], owner[rank]
        new = np.concatenate([[True], value[1:] != value[:-1]])
        code = np.cumsum(new) - 1
        often = np.bincount(code)[code] > 1
        code = (np.cumsum(np.concatenate([[True], code[often][1:] != code[often][:-1]])) - 1) if often.any() else code[:0]
        held = held[often]
        shared = np.zeros((len(sets), len(sets)), dtype=np.float32)
        width = 8192
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
            first, last = np.searchsorted(code, [low, low + width])
            dense = np.zeros((len(sets), width), dtype=np.float32)
            dense[held[first:last], code[first:last] - low] = 1
            shared += dense @ dense.T
        # Counts are exact in single precision; the comparison needs more digits than it has.
        shared = shared.astype(np.int64)
        union = sizes[:, None] + sizes[None, :] - shared
        linked = (100 * shared >= percent * union) & (parts[:, None] != parts[None, :])
        found: list[tuple[int, int]] = []
        for i, j in zip(*np.nonzero(np.triu(linked, 1))):
            p, q = find(int(parts[i])), find(int(parts[j]))
            if p != q:
                root[p] = q
                found.append((int(reps[i]), int(reps[j])))
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 2)], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 85, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """Group documents whose sets of five-word shingles have a Jaccard similarity of `percent` hundredths or more.

    Reads `doc_id` and `text`; returns one row per input row: doc_id, n_shingles, class_id (smallest
    doc_id with the same set), component_id (smallest doc_id reachable over links), kept. Words are runs
    without ASCII white space, A-Z lower-cased. Null and empty texts, and texts without words, have an
    empty set and are linked with nothing; a null doc_id takes no part and is kept. Rows that repeat a
    doc_id with different texts count as one document when linked. An empty table gives an empty result.

    Documents with equal sets are one class from the start, so groups of copies cost nothing further.
    Class representatives meet in the buckets of each band. First every member of a bucket is compared
    with the bucket's smallest member only, which joins most groups with work linear in their size. Then
    only buckets that still hold unconnected members are compared in full, in blocks of `block` members (fewer
    if they are long) against blocks, skipping pairs known to be connected. With 24 bands of 5 rows a linked pair is missed
    with a probability below 1e-6. All links are confirmed on the full sets.
    """
    base = stage(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _signatures(bands, rows), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
        )
    )
    full = base.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage(full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")))
    members = stage(
        full.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("rep"), "n_shingles", F.explode("bands").alias("bucket"))
        .distinct()
    )
    shared = stage(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rep").alias("center")).where("n > 1"))
    members = stage(members.join(shared, "bucket"))
    stars = members.where("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    stars = stage(stars)
    candidates = stars.select("a").union(stars.select("b")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = stage(
        texts.join(candidates.withColumnRenamed("a", "doc_id").hint("merge"), "doc_id", "left_semi")
        .mapInArrow(_sets, "rep long, shingles binary")
    )
    tested = (
        stars.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right")), "b")
        .mapInArrow(_similar(percent), "a long, b long")
    )
    links = stage(tested)
    parts = components(links)
    rest = _open_buckets(members, parts, block)
    more = (
        rest.join(sets, "rep")
        .groupBy("bucket", "low", "high")
        .applyInArrow(_block_links(percent), "a long, b long")
    )
    more = stage(more)
    if not more.isEmpty():
        parts = components(links.unionByName(more))
    parts = parts.select(F.col("node").alias("rep"), "component")
    named = classes.join(parts, "rep", "left").select(
        "set_a", "set_b", "n_shingles", "rep", F.coalesce("component", "rep").alias("component")
    )
    out = base.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("class_id"),
        own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def _open_buckets(members: DataFrame, parts: DataFrame, block: int) -> DataFrame:
    """Members of buckets that still hold unconnected members, once for each pair of blocks to compare.

    Buckets with the same members are taken once. Members of a bucket's most common part and the others
    go to separate blocks, and a pair of blocks of one part alone is left out.
    """
    held = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("part")
    )
    mixed = (
        held.groupBy("bucket", "part")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"), *[F.bit_xor(h).alias(c) for h, c in zip(digest128("rep"), ("who", "who_too"))])
        .groupBy("bucket")
        .agg(
            F.count("*").alias("parts"),
            F.sum("n").alias("n"),
            F.sum("size").alias("size"),
            F.max(F.struct("n", "part", "size")).alias("main"),
            F.bit_xor("who").alias("who"),
            F.bit_xor("who_too").alias("who_too"),
        )
        .where("parts > 1")
    )
    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.ceil(n / block), F.ceil(size / BLOCK_SHINGLES))

    once = mixed.groupBy("who", "who_too", "n").agg(F.min(F.struct("bucket", "main", "size")).alias("b")).select(
        "b.bucket",
        F.col("b.main.part").alias("main_part"),
        blocks(F.col("b.main.n"), F.col("b.main.size")).alias("mains"),
        blocks(F.col("n") - F.col("b.main.n"), F.col("b.size") - F.col("b.main.size")).alias("others"),
    )
    spread = held.join(once, "bucket").withColumn("main", F.col("part") == F.col("main_part"))
    spread = spread.withColumn(
        "own",
        F.when(F.col("main"), F.pmod(F.xxhash64("rep"), "mains")).otherwise(
            F.col("mains") + F.pmod(F.xxhash64("rep"), "others")
        ),
    )
    last = F.col("mains") + F.col("others") - 1
    first = F.when(F.col("main"), F.col("mains")).otherwise(F.lit(0))
    return spread.withColumn("other", F.explode(F.sequence(first, last))).select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "rep",
        "part",
    )
