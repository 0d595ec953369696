"""Suffix arrays by induced sorting, in numpy, and the common prefixes of neighbours.

The text is an array of bytes. Suffixes are classified as smaller or larger than their right neighbour;
substrings between leftmost-smaller places are sorted and named; neighbouring names are joined pairwise,
recursively, until all differ or span ``depth`` bytes; and from the sorted leftmost-smaller suffixes all others
are induced, bucket by bucket, in two linear scans. Order holds for the first ``depth`` bytes of a suffix.
"""

from __future__ import annotations

import numpy as np

from panelwright.llm import textbytes as T

U64 = np.uint64


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its right neighbour (the last one isn't)."""
    change = np.flatnonzero(s[1:] != s[:-1])
    out = np.zeros(len(s), dtype=bool)
    rises = np.repeat(s[change] < s[change + 1], np.diff(change, prepend=-1))
    out[:len(rises)] = rises
    return out


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that ``lms``, leftmost-smaller places in order, induce."""
    n = len(s)
    counts = np.bincount(s, minlength=256)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    last = first + counts
    out = np.full(n, -1, np.int64)

    def put(places: np.ndarray, pointer: np.ndarray, down: bool) -> None:
        """Places go to the next free seats of their buckets, in the order they come."""
        chars = s[places]
        order = np.argsort(chars, kind="stable")
        places, chars = places[order], chars[order]
        edges = np.flatnonzero(np.concatenate(([True], chars[1:] != chars[:-1]))) if len(chars) else np.zeros(0, np.int64)
        many = np.diff(np.append(edges, len(chars)))
        seat = np.arange(len(chars)) - np.repeat(edges, many)
        if down:
            out[pointer[chars] - 1 - seat] = places
            pointer[chars[edges]] -= many
        else:
            out[pointer[chars] + seat] = places
            pointer[chars[edges]] += many

    used = np.flatnonzero(counts)
    groups = s[lms]
    order = np.argsort(groups, kind="stable")
    sorted_lms = lms[order]
    bounds = np.searchsorted(groups[order], np.arange(257))
    head = first.copy()
    # Larger suffixes, in rising order; the text's last suffix comes before all of its bucket.
    put(np.array([n - 1]), head, False)
    for c in used.tolist():
        done = first[c]
        while done < head[c]:
            here = out[done:head[c]]
            done = head[c]
            before = here[here > 0] - 1
            put(before[~smaller[before]], head, False)
        here = sorted_lms[bounds[c]:bounds[c + 1]]
        before = here[here > 0] - 1
        put(before[~smaller[before]], head, False)
    # Smaller suffixes, in falling order.
    tail = last.copy()
    for c in used.tolist()[::-1]:
        done = last[c]
        while done > tail[c]:
            here = out[tail[c]:done][::-1]
            done = tail[c]
            before = here[here > 0] - 1
            put(before[smaller[before]], tail, True)
        here = out[first[c]:head[c]][::-1]
        before = here[here > 0] - 1
        put(before[smaller[before]], tail, True)
    return out


def _ranks(names: np.ndarray, rounds: int) -> np.ndarray:
    """Ranks of the suffixes of ``names``: pairs of neighbours are named anew, twice as long each time."""
    reach = 1
    rank = names
    while rounds and rank.max(initial=0) + 1 < len(rank):
        after = np.zeros_like(rank)
        after[:-reach or None] = rank[reach:] + 1 if reach < len(rank) else 0
        size = np.bincount(rank)
        open_ = np.flatnonzero(size[rank] > 1)
        base = np.cumsum(size) - size
        pair = rank[open_] * (len(rank) + 1) + after[open_]
        # Equal pairs get one rank, so their order doesn't count.
        order = np.argsort(pair)
        value = pair[order]
        fresh = np.concatenate(([True], value[1:] != value[:-1]))
        # A rank is the number of smaller suffixes; a group's members are renumbered within its range.
        place = np.maximum.accumulate(np.where(fresh, np.arange(len(value)), 0))
        group = rank[open_][order]
        begin = np.concatenate(([True], group[1:] != group[:-1]))
        start = np.maximum.accumulate(np.where(begin, np.arange(len(value)), 0))
        full = base[rank]
        full[open_[order]] = base[group] + place - start
        there = np.zeros(len(full), dtype=np.int64)
        there[full] = 1
        rank = (np.cumsum(there) - 1)[full]
        reach, rounds = reach * 2, rounds - 1
    return rank


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``s`` (bytes), in the order of at least their first ``depth`` bytes."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    smaller = _smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        rough = _induce(s, smaller, lms)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        sorted_lms = rough[is_lms[rough]]
        number = np.empty(n, np.int64)
        number[lms] = np.arange(len(lms))
        ends = np.append(lms[1:] + 1, n)
        # Equal substrings between neighbouring places have one name; the last one runs to the end of the text.
        value = T.hashes(s, lms, ends)
        own = number[sorted_lms]
        size, mark = (ends - lms)[own], value[own]
        differs = (size[1:] != size[:-1]) | (mark[1:] != mark[:-1])
        name = np.empty(len(lms), np.int64)
        name[own] = np.concatenate(([0], np.cumsum(differs)))
        rank = _ranks(name, max(1, int(np.ceil(np.log2(depth))) + 1))
        if rank.max() + 1 == len(rank):
            order = np.empty(len(rank), np.int64)
            order[rank] = np.arange(len(rank))
        else:
            order = np.argsort(rank, kind="stable")
        lms = lms[order]
    return _induce(s, smaller, lms)


def words8(s: np.ndarray) -> np.ndarray:
    """Eight bytes from every place on, as one number; zeros follow the text."""
    n = len(s)
    raw = np.zeros(n + 16, np.uint8)
    raw[:n] = s
    out = np.empty((n + 7) // 8 * 8, U64)
    for k in range(8):
        part = raw[k:k + len(out)].view("<u8")
        out[k::8] = part
    return out[:n]


def common_prefixes(s: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Permuted common prefixes, up to ``depth``: by place, bytes shared with its predecessor in ``order``.

    ``order`` holds places in suffix order; the first has none.
    """
    plcp = np.zeros(len(s), np.int64)
    eight = words8(s)
    place, before = order[1:], order[:-1]
    reached = 0
    alive = np.arange(len(place))
    while reached < depth and len(alive):
        a, b = place[alive] + reached, before[alive] + reached
        left = len(s) - np.maximum(a, b)
        differs = eight[np.minimum(a, len(s) - 1)] ^ eight[np.minimum(b, len(s) - 1)]
        # The zero bits below the lowest one that is set; all 64 if none is.
        with np.errstate(over="ignore"):
            count = np.bitwise_count((differs & (~differs + U64(1))) - U64(1)) >> 3
        count = np.minimum(count, np.maximum(left, 0))
        same = count == 8
        plcp[place[alive[~same]]] = reached + count[~same]
        alive = alive[same]
        reached += 8
    plcp[place[alive]] = reached
    return np.minimum(plcp, depth)
