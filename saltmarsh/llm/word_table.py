"""Token ids of many texts at once: distinct words are encoded, everything else is array work.

Texts become one array of code points with marks between them; words are found and hashed on the whole
array, and each distinct word is looked up once in a table that a process keeps between batches. The
table holds two independent 64-bit hashes per word, both of which must agree. They are running sums of
powers for short words; long words, for which such sums can be alike by design, are hashed byte by byte.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import xxhash

from .bpe import split_special, starts_of
from .text import mix

#: code points behind the last one of Unicode: a mark between texts, then the special tokens
MARK = 0x110000
PART = 1 << 20
ROOM = 400_000
#: words of more code points are hashed whole
LONG = 32
_SAFE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, factor, np.uint64), np.full(n, pow(factor, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def parts_of(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of about ``size``, cut where a word must begin whatever stands around."""
    at = 0
    while len(text) - at > 2 * size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


class WordTable:
    """Ids of words, by hash; the words used longest ago leave when there is no room.

    ``encode`` takes the UTF-8 bytes of many words in a row and where each ends, and returns the ids of each.
    """

    def __init__(self, encode: Callable[[bytes, list[int]], list[list[int]]], special: dict[str, int], room: int = ROOM):
        self.encode, self.special, self.room = encode, special, room
        self.h = np.empty(0, np.uint64)
        self.h2 = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.used = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)
        self.turn = 0
        self.tables = [_powers(f, PART) for f in _FACTORS]

    def _hashes(self, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        out = []
        for i, f in enumerate(_FACTORS):
            if len(self.tables[i][0]) <= len(code):
                self.tables[i] = _powers(f, 1 << len(code).bit_length())
            up, down = self.tables[i]
            total = np.zeros(len(code) + 1, np.uint64)
            np.cumsum((code + np.uint32(1)).astype(np.uint64) * up[: len(code)], out=total[1:])
            out.append(mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)))
        for w in np.flatnonzero(end - start > LONG).tolist():
            both = xxhash.xxh3_128_intdigest(code[start[w]:end[w]].tobytes())
            out[0][w], out[1][w] = both >> 64, both & 0xFFFFFFFFFFFFFFFF
        return out

    def _find(self, code, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Per word where its ids begin in ``self.ids``, and how many there are."""
        h, h2 = self._hashes(code, start, end)
        order = np.argsort(h)
        sorted_h = h[order]
        begins = np.concatenate([np.ones(min(1, len(h)), bool), sorted_h[1:] != sorted_h[:-1]])
        keys, first = sorted_h[begins], order[begins]
        where = np.empty(len(h), np.int64)
        where[order] = np.cumsum(begins) - 1
        if (h2[first][where] != h2).any():
            raise ValueError("two words share a hash")
        self.turn += 1
        place = np.minimum(np.searchsorted(self.h, keys), max(0, len(self.h) - 1))
        known = (self.h[place] == keys) & (self.h2[place] == h2[first]) if len(self.h) else np.zeros(len(keys), bool)
        self.used[place[known]] = self.turn
        new = np.flatnonzero(~known)
        if len(new):
            begin, length = start[first[new]], (end - start)[first[new]]
            some = code[expand(begin, length)]
            raw = some.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            width = 1 + (some >= 0x80).astype(np.int64) + (some >= 0x800) + (some >= 0x10000)
            got = self.encode(raw, np.cumsum(width)[np.cumsum(length) - 1].tolist())
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self._keep(keys[new], h2[first[new]], sizes, np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum())))
            place = np.searchsorted(self.h, keys)
            if (self.h[place] != keys).any() or (self.h2[place] != h2[first]).any():
                raise ValueError("two words share a hash")
        return self.at[place][where], self.size[place][where]

    def _keep(self, h, h2, sizes, ids) -> None:
        if len(self.h) + len(h) > self.room:  # what this turn used stays
            stay = (self.used == self.turn) | (self.used > np.median(self.used))
            self.ids = self.ids[expand(self.at[stay], self.size[stay])]
            self.h, self.h2, self.size, self.used = self.h[stay], self.h2[stay], self.size[stay], self.used[stay]
            self.at = np.cumsum(self.size) - self.size
        all_h = np.concatenate([self.h, h])
        order = np.argsort(all_h, kind="stable")
        self.h, self.h2 = all_h[order], np.concatenate([self.h2, h2])[order]
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(sizes) - sizes])[order]
        self.size = np.concatenate([self.size, sizes])[order]
        self.used = np.concatenate([self.used, np.full(len(h), self.turn)])[order]
        self.ids = np.concatenate([self.ids, ids])

    def _codes(self, text: str) -> list[np.ndarray]:
        return [np.array([MARK + 1 + p], np.uint32) if isinstance(p, int) else np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32)
                for p in split_special(text, self.special)]

    def _encode_part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        mark = np.array([MARK], np.uint32)
        code = np.concatenate([a for t in texts for a in (*self._codes(t), mark)])
        start = starts_of(code)
        end = np.append(start[1:], len(code))
        head = code[start]
        plain = np.flatnonzero(head < MARK)
        at, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        at[plain], size[plain] = self._find(code, start[plain], end[plain])
        special = np.flatnonzero(head > MARK)
        source = self.ids
        if len(special):
            at[special], size[special] = len(source) + np.arange(len(special)), 1
            source = np.concatenate([source, head[special] - np.uint32(MARK + 1)])
        total = np.cumsum(size)[head == MARK]
        return source[expand(at, size)], np.diff(total, prepend=0)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        ids, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        held: list[tuple[int, str]] = []
        chars = 0

        def flush():
            nonlocal held, chars
            if held:
                got, n = self._encode_part([p for _, p in held])
                ids.append(got)
                np.add.at(sizes, [i for i, _ in held], n)
                held, chars = [], 0

        for i, text in enumerate(texts):
            for part in parts_of(text):
                held.append((i, part))
                chars += len(part)
                if chars >= PART // 2:
                    flush()
        flush()
        return np.concatenate(ids), sizes


def expand(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions at, at + 1, ... of runs, one run behind the other."""
    shift = np.repeat(at - np.cumsum(size) + size, size)
    return shift + np.arange(len(shift))
