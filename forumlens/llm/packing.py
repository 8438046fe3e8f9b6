"""Token packing with a fixed number of open windows per partition."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import slices, stage

CONTEXT = 2048
#: Windows that a partition keeps open; what bounds its memory.
OPEN = 64
#: Partitions whose leftover windows are merged by one task, so that no task holds those of all.
MERGED = 32
END_ID = 1
#: Bytes of text that are tokenized at a time, at least one text; what a worker holds grows with it.
SLICE = 1 << 20
#: The ids of so many words are remembered, about 40 bytes each; then all are forgotten, and the common ones
#: are back at once.
CACHE_WORDS = 1_000_000
#: Marks that the tokenizer cuts from the letters before them.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters whose normal and lower-case forms are not left to this module.
BEYOND = "[^\\x{0}-\\x{24F}]|\\x{130}"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts from a tokenizer that never joins characters across white space.

    A batch is cut at ASCII white space and its different words are worked on once. A word of plain letters
    and perhaps marks after them is two parts, as the tokenizer cuts there: letters are lower-cased and looked
    up in a bounded cache, and unknown ones go to the tokenizer's model in one long line, which is cut again
    after the ids that end a word. Any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """Known words as sorted hashes, and for each where its ids begin and how many they are."""
        self.keys = np.zeros(0, dtype=np.int64)
        self.begin, self.size = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.flat = np.zeros(0, dtype="<u4")

    def _letters(self, words: list[str]) -> pa.Array:
        """Ids of lower-cased words of letters. Words are told apart by 64-bit hashes."""
        keys = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(keys[new], kind="stable")]
            line = " ".join([words[i] for i in new.tolist()])
            ids = np.array(self.letters.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
            if len(cuts) != len(new) + 1:
                raise ValueError("the vocabulary does not end every word with one token")
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            begin, size = (len(self.flat) + cuts[:-1]).astype(np.int32), np.diff(cuts).astype(np.int32)
            self.keys = np.concatenate([self.keys, keys[new]])[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.size = np.concatenate([self.size, size])[order]
            self.flat = np.concatenate([self.flat, ids])
            at = np.searchsorted(self.keys, keys)
        size = self.size[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.begin[at] - upto[:-1], size) + np.arange(upto[-1])]
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        buffers = [None, pa.py_buffer((4 * upto).astype(np.int32)), pa.py_buffer(ids)]
        return pa.Array.from_buffers(pa.binary(), len(words), buffers)

    def _whole(self, words: list[str]) -> pa.Array:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return pa.array([np.array(e.ids, dtype="<u4").tobytes() for e in found], pa.binary())

    def batch(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of all texts as bytes, and the borders between texts."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        words, place = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        letters = pc.ascii_rtrim(words, TAIL)
        plain = pc.and_not(pc.utf8_is_alpha(letters), pc.match_substring_regex(letters, BEYOND)).to_numpy(zero_copy_only=False)
        mask = pa.array(plain)
        heads = pc.utf8_lower(letters.filter(mask)).dictionary_encode()
        tails = pc.replace_substring_regex(words.filter(mask), f"^.*?([{re.escape(TAIL)}]*)$", r"\1").dictionary_encode()
        others = words.filter(pa.array(~plain)).to_pylist()
        # Parts of words: different letters, then different marks, then different other words, then nothing.
        kinds = [self._letters(heads.dictionary.to_pylist()), self._whole(tails.dictionary.to_pylist()), self._whole(others)]
        first_tail, first_other = len(kinds[0]), len(kinds[0]) + len(kinds[1])
        atoms = pa.concat_arrays([*kinds, pa.array([b""], pa.binary())])
        part = np.full((len(words), 2), len(atoms) - 1, dtype=np.int32)
        part[plain, 0] = heads.indices.to_numpy(zero_copy_only=False)
        part[plain, 1] = first_tail + tails.indices.to_numpy(zero_copy_only=False)
        part[~plain, 0] = first_other + np.arange(len(others))
        # Taking the parts in the order of the text lines their ids up in one buffer.
        taken = atoms.take(pa.array(part[place].reshape(-1)))
        _, offsets, ids = taken.buffers()
        upto = np.frombuffer(offsets, dtype=np.int32)[: len(taken) + 1]
        return memoryview(ids or b""), upto[2 * lists.offsets.to_numpy().astype(np.int64)]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


Row = tuple  # doc_id, start, length, ids, doc_tokens


class Windows:
    """Open windows: a piece goes where it leaves least room; the fullest is emitted when none has room."""

    def __init__(self, context: int, limit: int):
        self.context, self.limit = context, limit
        self.used = np.zeros(0, dtype=np.int64)
        self.held: list[list[Row]] = []
        self.emitted: list[list[Row]] = []

    def place(self, rows: list[Row]) -> None:
        """Put pieces that stay together into one window."""
        length = sum(r[2] for r in rows)
        free = self.context - self.used
        fits = np.flatnonzero(free >= length)
        if len(fits):
            k = int(fits[free[fits].argmin()])
        else:
            if len(self.held) >= self.limit:
                self.emit(int(self.used.argmax()))
            k = len(self.held)
            self.used = np.append(self.used, 0)
            self.held.append([])
        self.held[k] += rows
        self.used[k] += length
        if self.used[k] == self.context:
            self.emit(k)

    def emit(self, k: int) -> None:
        self.used = np.delete(self.used, k)
        self.emitted.append(self.held.pop(k))

    def take(self) -> list[list[Row]]:
        out, self.emitted = self.emitted, []
        return out


PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length")]
    + [("ids", pa.binary())]
    + [(n, pa.int64()) for n in ("doc_tokens", "part", "window", "offset")]
    + [("open", pa.bool_())]
)
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, part long, window long, offset long, open boolean"
)


def _rows(windows: list[list[Row]], part: int, first: int, is_open: bool) -> pa.RecordBatch:
    out = []
    for number, window in enumerate(windows, first):
        offset = 0
        for row in window:
            out.append((*row, part, number, offset, is_open))
            offset += row[2]
    columns = zip(*out) if out else [[]] * len(PIECES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def _pack(path: str, context: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        tokenizer, windows = _tokenizer(path), Windows(context, limit)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in slices(batches, "text", SLICE):
            flat, borders = tokenizer.batch(batch.column("text"))
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), borders[:-1].tolist(), borders[1:].tolist()):
                ids = bytes(flat[a:b]) + end
                tokens = len(ids) // 4
                for start in range(0, tokens, context):
                    length = min(context, tokens - start)
                    windows.place([(doc, start, length, ids[4 * start : 4 * (start + length)], tokens)])
            done = windows.take()
            yield _rows(done, part, made, False)
            made += len(done)
        yield _rows(windows.held, part, made, True)

    return run


def _merge(context: int):
    """Put the leftover windows of several partitions together: the fullest first, each where it fits best."""

    def run(table: pa.Table) -> pa.Table:
        leftovers: dict[tuple[int, int], list[tuple[int, Row]]] = {}
        for row in table.select(PIECES.names).to_pylist():
            piece = tuple(row[n] for n in ("doc_id", "start", "length", "ids", "doc_tokens"))
            leftovers.setdefault((row["part"], row["window"]), []).append((row["offset"], piece))
        groups = [[r for _, r in sorted(rows, key=lambda r: r[0])] for _, rows in sorted(leftovers.items())]
        windows = Windows(context, len(groups))
        for group in sorted(groups, key=lambda g: -sum(r[2] for r in g)):
            windows.place(group)
        part = min(p for p, _ in leftovers)
        first = min(w for p, w in leftovers if p == part)
        return pa.Table.from_batches([_rows(windows.emitted + windows.held, part, first, False)])

    return run


def pack(
    docs: DataFrame,
    path: str | None = None,
    context: int = CONTEXT,
    open_windows: int = OPEN,
    merged: int = MERGED,
) -> DataFrame:
    """Pack all documents into sequences of at most `context` tokens.

    One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.
    A document is its ids and the end id; null and empty texts have the end id alone. Documents longer than
    a sequence are cut at its multiples. Each partition keeps `open_windows` sequences open: a piece goes
    where it leaves least room, and the fullest is emitted when none has room. What is open at the end is
    merged between `merged` partitions at a time. Nothing but the open windows' fill is held, and pieces are
    written to the shared folder before the merge. Rows that repeat are packed each for itself; null doc_ids
    stay null; an empty table gives an empty result.
    """
    path = path or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stage(rows.mapInArrow(_pack(path, context, open_windows), SCHEMA))
    left = pieces.where("open").withColumn("merge", F.floor(F.col("part") / merged))
    together = left.groupBy("merge").applyInArrow(_merge(context), SCHEMA)
    return pieces.where("NOT open").unionByName(together).select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        F.shiftleft("part", 36).bitwiseOR(F.col("window")).alias("sequence_id"),
        "offset",
    )


def digests(packed: DataFrame) -> DataFrame:
    """Each piece with the CRC-32 of its ids in place of them."""
    return packed.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
