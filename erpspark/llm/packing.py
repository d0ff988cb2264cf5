"""Packing of tokenised documents into sequences of a fixed number of tokens, by sums of squares.

Documents become pieces (only those longer than a sequence are cut). Pieces are dealt by hash to groups of
about `GROUP_PIECES`, and each group is packed by itself: longest piece first, each piece goes into the open
sequence for which the sum over all residual gaps of (open sequences with that gap) squared becomes
smallest; a sequence is opened only where no open one has room. A group wastes a few part-filled sequences
at most, so many groups cost little, and no group grows with the data.

Token ids come from a `tokenizers` file. Words between ASCII white space are encoded once and kept in a
bounded cache of the worker process; the tokenizer drops white space, so a text's ids are those of its words.

Defined results: null and empty texts are the end token alone; repeated rows are packed each; a null doc_id
keeps its rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from erpspark.llm.scratch import stored
from erpspark.llm.words import text_bytes

SEQUENCE = 4096
END_ID = 1
#: Pieces of a group, in the mean.
GROUP_PIECES = 50_000
#: Words, and parts of words, that a worker process remembers (some 250 MB); frequent ones come early and stay.
CACHE_WORDS = 700_000
BLOCK_BYTES = 2 << 20

# Words of these characters only are cut into parts here; all others go to the tokenizer whole. Letters are
# those Latin ones whose lower case is one letter, so that cutting and lower-casing agree with any Unicode version.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ſ"
_PLAIN = re.compile(rf"[!-~{_LATIN}]+").fullmatch
# The parts that the tokenizer's own pattern gives for such words, in lower case, and line ends between words.
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|\n|[^0-9{_LATIN}\n]+").findall


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit values."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core: threads of the library cost time and bring none
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, unknown: list[bytes]) -> None:
        plain, texts, other, known, learned = [], [], [], self.parts, self.words
        for raw in unknown:
            word = raw.decode("utf-8", "replace")
            if _PLAIN(word) and "<|" not in word:
                plain.append(raw)
                texts.append(word)
            else:
                other.append(raw)
        # one flat list for all words, each closed by a line end: lists of their own cost the garbage collector more than the cutting
        parts = _PARTS("".join([f"{t}\n" for t in texts]).lower())
        missing = [p for p in set(parts) if p not in known and p != "\n"]
        known.update(zip(missing, self._encode(missing), strict=True))
        ids, words = [], iter(plain)
        for p in parts:
            if p == "\n":
                learned[next(words)] = b"".join(ids)
                ids.clear()
            else:
                ids.append(known[p])
        learned.update(zip(other, self._encode([w.decode("utf-8", "replace") for w in other]), strict=True))
        if len(known) > CACHE_WORDS:
            for p in missing:
                del known[p]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text; unknown words of all of them are learned together first."""
        split = [t.split() for t in texts]
        known = self.words
        unknown = [w for w in set().union(*split) if w not in known]
        self._learn(unknown)
        ids_of = known.__getitem__
        out = [b"".join(map(ids_of, words)) for words in split]
        if len(known) > CACHE_WORDS:
            for w in unknown:
                del known[w]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker process's encoder for a file; it outlives tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _cut(path: str, size: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        first, held, total = 0, [], 0
        for i, text in enumerate(text_bytes(column)):
            held.append(text)
            total += len(text)
            if total >= BLOCK_BYTES:
                yield first, held
                first, held, total = i + 1, [], 0
        if held:
            yield first, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in blocks(batch.column(1)):
                rows = []
                for i, data in enumerate(encode.texts(texts), first):
                    data += end
                    for piece, at in enumerate(range(0, len(data), 4 * size)):
                        part = data[at : at + 4 * size]
                        rows.append((ids[i], piece, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE)

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_cut(tokenizer, size, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, in the order given. Equal sums: the smallest gap that fits."""
    count = np.zeros(size + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, n in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[n:]) + n
        if len(gaps):
            # change of the sum when one bin goes from gap g to g - n (a full bin leaves the count)
            change = 1 - 2 * count[gaps] + np.where(gaps > n, 2 * count[gaps - n] + 1, 0)
            gap = int(gaps[np.argmin(change)])
            at = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, at, made = size, made, made + 1
        bins[i], offsets[i] = at, size - gap
        if gap > n:
            count[gap - n] += 1
            open_bins[gap - n].append(at)
    return bins, offsets


def _pack_group(size: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = sum_of_squares(group["length"].to_numpy(), size)
        return group.drop(columns="part").assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    return run


def pack(cut: DataFrame, size: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with sequence_id and offset. `cut` has doc_id, piece, start, length, ids_crc32; it is written to the shared folder first."""
    held = stored(cut, "pieces")
    groups = max(1, round(held.count() / group_pieces))
    # equal rows go to different groups by their place in the written table
    dealt = held.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("part").applyInPandas(_pack_group(size), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
