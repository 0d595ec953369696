"""Token ids of many texts at once: pre-tokens are found and told apart with numpy, new ones go to the tokenizer.

Ids are those the ``tokenizers`` library gives for a byte-level BPE file with GPT-2's pre-tokens and no special
tokens added. Pre-tokens are encoded independently of each other, so each distinct one is encoded once per
worker. Texts that hold a special token's string go to the ``tokenizers`` library as a whole.
"""

from __future__ import annotations

import json
from functools import cached_property

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

from panelwright.llm import textbytes as T

U64 = np.uint64
# The pre-tokens of GPT-2's byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, OTHER = range(4)
SLOTS = 21


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level BPE files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """``encode(bytes, offsets)`` gives the ids of all texts, joined, and their offsets."""

    def __init__(self, path: str, most: int = 3_000_000):
        self.path, self.most = path, most
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {x["content"] for x in spec["added_tokens"]}
        self.special = sorted(x.encode() for x in special)
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, U64), np.zeros(0, np.int64)
        self.slot_key, self.slot_place = np.zeros(1 << SLOTS, U64), np.full(1 << SLOTS, -1, np.int32)
        self.ids, self.bounds, self.used, self.count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0, 0

    @cached_property
    def classes(self) -> np.ndarray:
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        table = np.full(0x110000, OTHER, np.uint8)
        points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[points[m.start():m.end()]] = kind
        return table

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def pretokens(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte offsets where pre-tokens begin, and the end."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(1, np.int64)
        place = np.flatnonzero((data & 0xC0) != 0x80)
        kind = self.classes[points]
        n = len(points)
        text_starts = np.searchsorted(place, offsets[:-1][np.diff(offsets) > 0])
        first = np.zeros(n + 1, dtype=bool)
        first[0] = first[n] = True
        first[1:n] = kind[1:] != kind[:-1]
        first[text_starts] = True
        edge = np.zeros(n + 1, dtype=bool)  # where texts begin or end
        edge[text_starts] = edge[n] = True
        # The last white space before something else: a blank joins it, another character stands alone.
        last = np.flatnonzero((kind == SPACE) & first[1:] & ~edge[1:])
        first[last] = True
        joined = last[points[last] == 32]
        first[joined + 1] = False
        # An apostrophe that begins a pre-token takes the letters of a contraction.
        quote = np.flatnonzero((points == 39) & first[:-1])
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~edge[quote + 1]]
        for q in quote:
            stop = q + 1
            while stop < min(n, q + 3) and kind[stop] == LETTER and (stop == q + 1 or not first[stop]):
                stop += 1
            letters = "".join(map(chr, points[q + 1:stop]))
            suffix = next((x for x in SUFFIXES if letters.startswith(x)), None)
            if suffix:
                first[q + 1] = False
                first[q + 1 + len(suffix)] = True
        return np.concatenate((place, [len(data)]))[np.flatnonzero(first)]

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> None:
        raw = data.tobytes()
        found = [self.bpe._core_bpe.encode_single_piece(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())]
        sizes = np.array([len(x) for x in found])
        total = int(sizes.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while self.count + len(found) + 1 > len(self.bounds):
            self.bounds = np.concatenate((self.bounds, np.zeros_like(self.bounds)))
        self.ids[self.used:self.used + total] = np.fromiter((i for x in found for i in x), np.uint32, total)
        self.bounds[self.count + 1:self.count + len(found) + 1] = self.used + np.cumsum(sizes)
        known = np.concatenate((self.known, hashes))
        place = np.concatenate((self.place, np.arange(self.count, self.count + len(found))))
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], place[order]
        slot = (hashes >> U64(64 - SLOTS)).astype(np.int64)
        free = self.slot_place[slot] < 0
        self.slot_key[slot[free]] = hashes[free]
        self.slot_place[slot[free]] = np.arange(self.count, self.count + len(found))[free]
        self.used, self.count = self.used + total, self.count + len(found)

    def _places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The number of each pre-token among those known; new ones are learnt."""
        slot = (value >> U64(64 - SLOTS)).astype(np.int64)
        out = self.slot_place[slot]
        rest = np.flatnonzero((self.slot_key[slot] != value) | (out < 0))
        unique, at, index = np.unique(value[rest], return_index=True, return_inverse=True)
        if len(unique):
            spot = np.searchsorted(self.known, unique)
            new = np.append(self.known, U64(0))[spot] != unique
            new |= spot == len(self.known)
            if new.any():
                if self.count and self.count + new.sum() > self.most:
                    self._forget()
                    return self._places(data, start, end, value)
                fresh = rest[at[new]]
                self._learn(data, start[fresh], end[fresh], unique[new])
                spot = np.searchsorted(self.known, unique)
            out[rest] = self.place[spot][index]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bounds = self.pretokens(data, offsets)
        start, end = bounds[:-1], bounds[1:]
        value = T.hashes(data, start, end)
        piece = self._places(data, start, end, value)
        low, size = self.bounds[piece], self.bounds[piece + 1] - self.bounds[piece]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(low - total[:-1], size) + np.arange(total[-1])]
        out = total[np.searchsorted(start, offsets)]
        odd = self._odd(data, offsets)
        if odd:
            parts = [ids[out[i]:out[i + 1]] for i in range(len(offsets) - 1)]
            for i in odd:
                text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8")
                parts[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(parts)
            out = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        return ids, out

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        raw, found = data.tobytes(), set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                found.add(int(np.searchsorted(offsets, at, "right")) - 1)
                at = raw.find(token, at + 1)
        return sorted(found)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
