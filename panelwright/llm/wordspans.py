"""Bounds of words in the bytes of many texts, for any set of separating bytes, and texts made of chosen words."""

from __future__ import annotations

import numpy as np

from panelwright.llm import textbytes as T

BLANKS = (9, 32)
LINE_ENDS = (10, 11, 12, 13)
BLOCK = 1 << 16


def table(separators) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(separators)] = True
    return found


def bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every word: a maximal run of bytes of one text that separate nothing."""
    inside = ~separator[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[offsets[:-1]] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[offsets[1:]] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), then those of first[1], and so on."""
    total = np.cumsum(count)
    if not len(total):
        return np.zeros(0, np.int64)
    return np.repeat(first - total + count, count) + np.arange(total[-1])


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray, between: int = 32,
           behind: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes with one byte ``between`` after each, and where each word ends in it.

    After a word with ``last`` comes ``behind``, or nothing if that is None.
    """
    gap = np.ones(len(start), np.int64) if behind is not None else 1 - last.astype(np.int64)
    size = end - start
    ends = np.cumsum(size + gap)
    out = np.full(int(ends[-1]) if len(ends) else 0, between, np.uint8)
    at = ends - size - gap
    for low in range(0, len(at), BLOCK):
        some = slice(low, low + BLOCK)
        out[ranges(at[some], size[some])] = data[ranges(start[some], size[some])]
    if behind is not None:
        out[(ends - 1)[last]] = behind
    return out, ends


def codes(*parts: np.ndarray) -> np.ndarray:
    """One integer per row of several columns of non-negative integers: equal for equal rows, and in their order."""
    code = parts[0].astype(np.int64)
    high = int(code.max(initial=0)) + 1
    for part in parts[1:]:
        width = int(part.max(initial=0)) + 1
        if high * width >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            high = int(code.max(initial=0)) + 1
        code = code * width + part
        high *= width
    return code


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words that follow each other."""
    return T.hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
