"""Token counts by whole-token shortcut: words that are one token are looked up, only the others are merged."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import slices

LIMIT = 4096
#: The mark that stands for a space in the model's pieces.
MARK = "▁"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceCounter:
    """Token counts of texts under a sentence-piece BPE model that marks the beginning of words.

    No piece of such a model has the mark after another character, so no merge crosses from a word to the mark
    after it: a text's count is the sum over its pre-tokens, each one or more marks and what follows them up to
    the next mark. `whole` holds the words that the model itself, asked word by word when it is loaded, gives
    as one token; a pre-token of one mark and such a word counts one. All others are merged by the model.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        ids = [i for i in ids if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        pieces = [self.model.id_to_piece(i) for i in ids]
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in pieces):
            raise ValueError("the model has pieces that reach from one word into the next")
        if MARK not in pieces:
            raise ValueError("the model has no piece for a mark alone")
        probe = "ﬁ  A\t① "
        if self.model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts before it cuts them")
        words = {p[1:]: i for p, i in zip(pieces, ids) if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]}
        found = self.model.encode(list(words), num_threads=1)
        self.whole = pa.array([w for w, got in zip(words, found) if got == [words[w]]], pa.string())

    def merged(self, words: list[str]) -> np.ndarray:
        """Counts of pre-tokens by the model's merges; the model puts the first mark before each, but not before
        nothing, which here is a mark alone and so one token."""
        return np.array([len(ids) if w else 1 for w, ids in zip(words, self.model.encode(words, num_threads=1))], dtype=np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        parts = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
        words, at = parts.flatten(), parts.offsets.to_numpy()
        at = at - at[0]
        empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
        place = np.arange(len(words))
        # The place of the last word at or before each part; parts of one text never look beyond its start.
        start = np.repeat(at[:-1], np.diff(at))
        last = np.maximum.accumulate(np.where(empty, -1, place)) if len(words) else place
        since = np.maximum(np.concatenate([[-1], last[:-1]]), start - 1)
        marks = place - since
        tokens = np.zeros(len(words), dtype=np.int64)

        plain = ~empty & (marks == 1)
        coded = words.filter(pa.array(plain)).dictionary_encode()
        count = pc.is_in(coded.dictionary, value_set=self.whole.cast(pa.large_string())).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = np.flatnonzero(count == 0)
        if len(rest):
            count[rest] = self.merged(coded.dictionary.take(pa.array(rest)).to_pylist())
        tokens[plain] = count[coded.indices.to_numpy(zero_copy_only=False)]

        # Words after several spaces, and the spaces that end a text: few, and merged as they stand.
        ends = np.zeros(len(words), dtype=bool)
        ends[at[1:] - 1] = True
        no_text = np.zeros(len(words), dtype=bool)
        no_text[at[:-1][np.diff(at) == 1]] = True
        other = np.flatnonzero((~empty & (marks > 1)) | (ends & empty & ~no_text))
        if len(other):
            strings = words.take(pa.array(other)).to_pylist()
            keys = [" " * (m - 1) + w for m, w in zip(marks[other].tolist(), strings)]
            unique = {k: n for n, k in enumerate(dict.fromkeys(keys))}
            tokens[other] = self.merged(list(unique))[[unique[k] for k in keys]]
        total = np.concatenate([[0], np.cumsum(tokens)])
        return total[at[1:]] - total[at[:-1]]


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = pa.array(counter.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every document's whole text, and whether it has more than `limit` tokens.

    Returns doc_id, n_bytes, n_tokens, over_limit, one row per input row. A null or empty text has neither bytes
    nor tokens. Strings of control tokens inside a text are ordinary text. Rows that repeat are counted each for
    itself, null doc_ids stay null, other columns are ignored, and an empty table gives an empty result. Texts are
    worked on in slices of 4 MB, a longer text alone.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = rows.mapInArrow(_count(path or model_path()), SCHEMA)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
