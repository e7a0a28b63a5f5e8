"""Words of whole text columns as flat arrays, without a Python object per word.

A word is a longest run of ASCII letters (A-Z taken as a-z), digits and characters
beyond ASCII, that is `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased text.
In UTF-8 all bytes of a character beyond ASCII are 0x80 or more, so words are found
in the bytes of an Arrow column. Each word gets a 64-bit hash of its lower-cased
bytes. Texts are taken in groups of bounded size and hashed in pieces, so memory
follows the piece and eight-byte numbers per word, also for very long texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20  # texts that are handled together
PIECE_BYTES = 1 << 18  # bytes that are hashed together
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _byte_table() -> np.ndarray:
    """Byte to lower-cased word byte, 0 where no word byte is."""
    table = np.zeros(256, dtype=np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


WORD_BYTES = _byte_table()


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, PIECE_BYTES + 1)
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                    steps = np.full(n, base, dtype=np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of a group of texts, in order: hash, first byte, end byte (in `data`)
    and the text's number in the group; `first` has the first word of each text
    and the number of words at its end."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    data: np.ndarray


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte values in each [start, end)."""
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most `limit` bytes, or of one text."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of texts that lie one after another in `data`."""
    n = len(data)
    hashes, starts, ends = [], [], []
    low = 0
    with np.errstate(over="ignore"):
        while low < n:
            high = min(low + PIECE_BYTES, n)
            if high < n:
                high = _cut(data, offsets, low, high)
            values = WORD_BYTES[data[low:high]]
            inside = np.zeros(len(values) + 2, dtype=bool)
            inside[1:-1] = values != 0
            new = np.zeros(len(values) + 1, dtype=bool)  # a text begins here
            at = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, side="right")]
            new[at - low] = True
            start = np.flatnonzero(inside[1:] & (~inside[:-1] | new))
            end = np.flatnonzero(inside[:-1] & (~inside[1:] | new))
            hashes.append(spans_hash(values, start, end))
            starts.append(start + low)
            ends.append(end + low)
            low = high
    empty = np.empty(0, dtype=np.int64)
    start = np.concatenate(starts) if starts else empty
    end = np.concatenate(ends) if ends else empty
    hash_ = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(hash_, start, end, text, first, data)


def _cut(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> int:
    """An end of a piece, near `high`, that cuts no word."""
    gaps = np.flatnonzero(WORD_BYTES[data[low:high]] == 0)
    if len(gaps):
        return low + int(gaps[-1]) + 1
    bound = offsets[(offsets > low) & (offsets <= high)]
    if len(bound):
        return int(bound[-1])
    step = PIECE_BYTES  # one word fills the piece: go on to its end
    stop = int(offsets[np.searchsorted(offsets, high, side="right")])
    while high < stop:
        gaps = np.flatnonzero(WORD_BYTES[data[high : min(high + step, stop)]] == 0)
        if len(gaps):
            return high + int(gaps[0])
        high = min(high + step, stop)
    return stop


def word_text(words: Words, low: int, high: int) -> bytes:
    """The lower-cased words low..high-1, joined by a blank."""
    piece = WORD_BYTES[words.data[words.start[low] : words.end[high - 1]]].tobytes()
    return b" ".join(word for word in piece.split(b"\0") if word)


def groups_of(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """The words of a column, group by group: first text, end, words."""
    data, offsets = text_bytes(texts)
    for low, high in groups(offsets):
        part = offsets[low : high + 1]
        yield low, high, words_of(data[part[0] : part[-1]], part - part[0])


def blocks_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each `width` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            out = out * np.uint64(_BASE) + hashes[k : k + n]
        return mix(out)
