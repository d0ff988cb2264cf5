"""Hashes of words and of word sequences, computed on whole byte blocks with NumPy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 those bytes never occur
inside a longer character, so bytes and characters give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
#: Blocks of documents are hashed together until they hold about this many bytes.
BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)  # odd, so it has an inverse modulo 2^64
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every input bit (finaliser with two multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {False: _byte_values(False), True: _byte_values(True)}


class _Powers:
    """base^j and base^-j modulo 2^64 for j < n, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64)))) for b in (self.base, self.inverse))
        return self.up, self.down


_BYTE_POWERS = _Powers(_BASE)
_WORD_POWERS = _Powers(np.uint64(0xC2B2AE3D27D4EB4F | 5))


def word_spans(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of every word of the block."""
    space = _IS_SPACE[np.frombuffer(block, np.uint8)]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _block_hashes(block: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = word_spans(block)
    up, down = _BYTE_POWERS.get(len(block) + 1)
    sums = np.zeros(len(block) + 1, np.uint64)
    np.cumsum(_VALUES[lower][np.frombuffer(block, np.uint8)] * up[: len(block)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(text: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, first byte and end byte of every word; long texts are cut at white space into blocks."""
    if len(text) <= 2 * BLOCK_BYTES:
        return _block_hashes(text, lower)
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + BLOCK_BYTES)
        while end < len(text) and not _IS_SPACE[text[end]]:
            end += 1
        h, s, e = _block_hashes(text[at:end], lower)
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def sequence_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hash of every run of `length` consecutive words (empty when there are fewer)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _WORD_POWERS.get(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * down[:n])


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of every text of an Arrow string column, without a copy of the column; null gives b''."""
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def in_blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts of consecutive rows that hold about BLOCK_BYTES together."""
    first, held, size = 0, [], 0
    for i, text in enumerate(text_bytes(column)):
        held.append(text)
        size += len(text) + 1
        if size >= BLOCK_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def block_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts, and where each text's words begin (one entry more than texts)."""
    hashes, starts, _ = word_hashes(b"\n".join(texts), lower)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return hashes, np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
