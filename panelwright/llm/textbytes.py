"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; A-Z count as a-z. Everything works on chunks of bounded size, so memory doesn't grow with a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PARTED = np.arange(256, dtype=np.uint8)
_PARTED[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, joined, and the offsets of each text; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    texts = texts.cast(pa.large_binary())
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def without_punctuation(data: np.ndarray) -> np.ndarray:
    """The bytes with blanks for ASCII punctuation."""
    return _PARTED[data]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def _table(which: str, base: int, length: int) -> np.ndarray:
    if which not in _powers or len(_powers[which]) < length:
        table = np.full(length, U64(base))
        table[0] = 1
        _powers[which] = np.multiply.accumulate(table)
    return _powers[which]


@dataclass
class Words:
    """Words of a chunk: bounds in bytes, the number of the text they are in, and a 64-bit hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, step: int = 1 << 20) -> Words:
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets[:-1]] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets[1:]] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    return Words(start, end, text, hashes(_LOWER[data], start, end, step))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of byte ranges, ordered by place; ranges may overlap if all are short."""
    out = np.empty(len(start), dtype=U64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            last = max(int(np.searchsorted(start, start[first] + step, "left")), first + 1)
            low, high = start[first], end[first:last].max()
            size = max(step * 2, int(high - low) + 1)
            power, inverse = _table("power", _BASE, size), _table("inverse", _INVERSE, size)
            total = np.zeros(high - low + 1, dtype=U64)
            part = data[low:high].astype(U64)
            part += U64(1)
            part *= power[:high - low]
            np.cumsum(part, out=total[1:])
            a, b = start[first:last] - low, end[first:last] - low
            out[first:last] = mix((total[b] - total[a]) * inverse[a] + (b - a).astype(U64))
            first = last
    return out


def shingles(words_: Words, count: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` consecutive words per text, sorted, and their texts' offsets.

    A text with fewer words has one, of all its words; a text without words has none.
    """
    h, text = words_.hash, words_.text
    bounds = np.searchsorted(text, np.arange(count + 1))
    with np.errstate(over="ignore"):
        if len(h) >= size:
            value = h[:len(h) - size + 1].copy()
            for i in range(1, size):
                value = mix(value * U64(3)) + h[i:len(h) - size + 1 + i]
            value = mix(value)
        else:
            value = np.zeros(0, U64)
    out, offsets = [], np.zeros(count + 1, np.int64)
    for i in range(count):
        a, b = bounds[i], bounds[i + 1]
        if b - a >= size:
            own = np.sort(value[a:b - size + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            own = h[a:a + 1].copy()
            with np.errstate(over="ignore"):
                for j in range(1, b - a):
                    own = mix(own * U64(5)) + h[a + j:a + j + 1]
                own = mix(own + U64(b - a))
        else:
            own = h[:0]
        out.append(own)
        offsets[i + 1] = offsets[i] + len(own)
    return np.concatenate(out) if out else h[:0], offsets
