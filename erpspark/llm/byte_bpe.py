"""Byte-level BPE encoding and decoding.

Texts are split by the tokenizer's pattern, and the bytes of each word are merged by rank: the leftmost pair of least rank is
joined until no pair has a rank. Spark deals the documents out and nothing is shuffled; a task merges every word that its worker
process does not remember. Words of at most `WORD_BYTES` bytes are remembered, so that the words that recur cost one look-up,
up to a fixed number of them (frequent ones come early and stay). Decoding maps every id to its bytes and concatenates the pieces.

Defined results: null and empty texts have no ids; repeated rows and null ids are encoded each; other columns are passed on
and not looked at. Letters and numbers are those of the `regex` module's Unicode version.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from erpspark.llm.quality_rules import let
from erpspark.llm.scratch import ship
from erpspark.llm.words import text_bytes

#: Words that a worker process remembers.
TABLE_WORDS = 700_000
WORD_BYTES = 32
#: Words of more bytes are merged by a heap of their pairs, shorter ones by looking at all of them.
HEAP_BYTES = 256
#: Rows that come back from a task together hold about so many characters of text.
BLOCK_CHARS = 2 << 20

# The pattern before the merges, with white space spelt out as Unicode has it: fixed values.
_S = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _pattern(letter: str, number: str, space: str) -> str:
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


PATTERN = _pattern(r"\p{L}", r"\p{N}", _S)
#: The same for texts without characters above U+02C1, in all of which letters and numbers are these.
LATIN_PATTERN = _pattern("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02c1", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0")
_words, _latin_words, _beyond = regex.compile(PATTERN).findall, re.compile(LATIN_PATTERN).findall, re.compile("[^\0-\u02c1]").search


def words(text: str) -> list[str]:
    return _words(text) if not text.isascii() and _beyond(text) else _latin_words(text)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the leftmost pair of least rank is joined until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > HEAP_BYTES:
        return _merge_long(word, ranks)
    get, none = ranks.get, len(ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    found = [get(word[i : i + 2], none) for i in range(len(word) - 1)]  # rank of every part with its next one
    while found and (least := min(found)) < none:
        i = found.index(least)
        joined = parts[i] = parts[i] + parts.pop(i + 1)
        del found[i]
        if i:
            found[i - 1] = get(parts[i - 1] + joined, none)
        if i < len(found):
            found[i] = get(joined + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n: pairs wait in a heap by rank and place, parts are known by where they begin."""
    size = len(word)
    end = list(range(1, size + 1))  # of the part that begins here; 0: none does any more
    before = list(range(-1, size))  # where the part before begins
    heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, to = heappop(heap)
        middle = end[i]
        if not middle or middle == size or end[middle] != to:
            continue  # one of the two was joined with another part
        end[i], end[middle] = to, 0
        before[to] = i
        if i and (rank := ranks.get(word[before[i] : to])) is not None:
            heappush(heap, (rank, before[i], to))
        if to < size and (rank := ranks.get(word[i : end[to]])) is not None:
            heappush(heap, (rank, i, end[to]))
    return [ranks[word[i:to]] for i, to in enumerate(end) if to]


class _Remembered(dict):
    """Ids of words, joined by spaces."""

    def __init__(self, tokens: list[bytes], limit: int):
        super().__init__()
        self.ranks, self.limit = {t: i for i, t in enumerate(tokens)}, limit

    def __missing__(self, word: str) -> str:
        data = word.encode()
        ids = " ".join(map(str, merge(data, self.ranks)))
        if len(data) <= WORD_BYTES and len(self) < self.limit:
            self[word] = ids
        return ids


_KNOWN: dict[tuple[str, int], _Remembered] = {}


def _encode(path: str, limit: int, schema: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, limit) not in _KNOWN:  # outlives tasks
            _KNOWN[path, limit] = _Remembered(read_ranks(path), limit)
        ids_of = _KNOWN[path, limit].__getitem__
        for batch in batches:
            rest, first, ids, held = batch.columns[:-1], 0, [], 0
            for i, data in enumerate(text_bytes(batch.column(batch.num_columns - 1)), 1):
                ids.append(" ".join(map(ids_of, words(data.decode("utf-8", "replace")))))
                held += len(data)
                if held >= BLOCK_CHARS or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*(c.slice(first, i - first) for c in rest), pa.array(ids, pa.string())], names=schema)
                    first, ids, held = i, [], 0

    return run


def encode(docs: DataFrame, path: str, limit: int = TABLE_WORDS) -> DataFrame:
    """The input's columns but `text`, and `__ids` (decimal ids joined by spaces, empty for an empty text)."""
    ship(docs.sparkSession)
    rest = [f for f in docs.schema if f.name != "text"]
    schema = StructType([*rest, StructField("__ids", StringType())])
    narrow = docs.select(*(F.col(f"`{f.name}`") for f in rest), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_encode(path, limit, schema.names), schema)


def pieces_of(spark: SparkSession, tokens: list[bytes]) -> Column:
    """Bytes of every id, in hex."""
    return spark.createDataFrame([([t.hex() for t in tokens],)], "p array<string>").scalar()


def id_list(ids: Column) -> Column:
    return F.when(ids == "", F.array().cast("array<string>")).otherwise(F.split(ids, " "))


def decode(encoded: DataFrame, path: str, ids: str = "__ids") -> DataFrame:
    """`encoded` with `__bytes`: what its ids (joined by spaces) stand for."""
    pieces = pieces_of(encoded.sparkSession, read_ranks(path))
    joined = let(F.col("__pieces"), lambda p: F.unhex(F.array_join(F.transform(id_list(F.col(ids)), lambda i: F.get(p, i.cast("int"))), "")))
    return encoded.withColumn("__pieces", pieces).select(*(F.col(f"`{c}`") for c in encoded.columns), joined.alias("__bytes"))
