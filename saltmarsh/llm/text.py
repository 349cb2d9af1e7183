"""Words and word shingles of UTF-8 bytes.

Words are runs of bytes other than 0x20 and 0x09-0x0D, after lower-casing A-Z. A word is hashed whole
(XXH3, 64 bits; words met before come from a bounded table), and the hash of a shingle chains those of its
words, so it depends on every word and on their order. A text is split in pieces of about a megabyte.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

PIECE = 1 << 20
WIDTH = 5
GROUP = 1 << 18
ROOM = 1 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class _Known(dict):
    """Hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= ROOM:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_known = _Known()


def mix(h: np.ndarray) -> np.ndarray:
    x = h >> np.uint64(30)
    x ^= h
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pieces_of(text: bytes, size: int = PIECE) -> Iterator[np.ndarray]:
    """The lower-cased bytes in parts that end between words; a word longer than a part stays whole."""
    b, at = _LOWER[np.frombuffer(text, np.uint8)], 0
    while at < len(b):
        end = min(len(b), at + size)
        while end < len(b):
            step = _BLANK[b[end:end + size]]
            if step.any():
                end += int(step.argmax())
                break
            end = min(len(b), end + size)
        yield b[at:end]
        at = end


def word_hashes(text: bytes, size: int = PIECE) -> np.ndarray:
    """Hash of every word in order."""
    found = [np.empty(0, np.uint64)]
    for part in pieces_of(text, size):
        some = part.tobytes().split()
        found.append(np.fromiter(map(_known.__getitem__, some), np.uint64, len(some)))
    return np.concatenate(found)


_SECRET = np.frombuffer(bytes.fromhex("b8fe6c3923a44bbe7c01812cf721ad1cded46de9839097db7240a4a4b7b3671fcb79e64eccc0e578825ad07dccff7221b8084674f743248e"), "<u8")
_FLIP_3 = np.uint64(int(_SECRET[0]) % 2**32 ^ int(_SECRET[0]) >> 32)
_FLIP_8, _FLIP_LOW, _FLIP_HIGH = _SECRET[1] ^ _SECRET[2], _SECRET[3] ^ _SECRET[4], _SECRET[5] ^ _SECRET[6]
_HALF = np.uint64(2**32 - 1)


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return h << np.uint64(bits) | h >> np.uint64(64 - bits)


def _folded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both halves of the product of 128 bits, one on the other."""
    half = np.uint64(32)
    a0, a1, b0, b1 = a & _HALF, a >> half, b & _HALF, b >> half
    low, one, other = a0 * b0, a1 * b0, a0 * b1
    middle = (low >> half) + (one & _HALF) + other
    return (a1 * b1 + (one >> half) + (middle >> half)) ^ (middle << half | low & _HALF)


def _short_hashes(b: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of the words of up to 16 bytes, ``n`` of each from ``starts``, many at a time; of others, no hash."""
    out = np.empty(len(starts), np.uint64)
    raw = np.concatenate([b, np.zeros(8, np.uint8)])
    four = np.ndarray(len(raw) - 3, "<u4", raw, strides=(1,))
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    i = np.flatnonzero(n <= 3)
    if len(i):
        at, k = starts[i], n[i]
        first, middle, last = (raw[p].astype(np.uint64) for p in (at, at + (k >> 1), at + k - 1))
        h = (first << np.uint64(16) | middle << np.uint64(24) | last | k.astype(np.uint64) << np.uint64(8)) ^ _FLIP_3
        h = (h ^ h >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
        out[i] = h ^ h >> np.uint64(32)
    i = np.flatnonzero((n > 3) & (n <= 8))
    if len(i):
        at, k = starts[i], n[i]
        h = (four[at + k - 4].astype(np.uint64) + (four[at].astype(np.uint64) << np.uint64(32))) ^ _FLIP_8
        h = (h ^ _turned(h, 49) ^ _turned(h, 24)) * np.uint64(0x9FB21C651E98DF25)
        h = (h ^ (h >> np.uint64(35)) + k.astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
        out[i] = h ^ h >> np.uint64(28)
    i = np.flatnonzero((n > 8) & (n <= 16))
    if len(i):
        at, k = starts[i], n[i]
        low, high = eight[at] ^ _FLIP_LOW, eight[at + k - 8] ^ _FLIP_HIGH
        h = k.astype(np.uint64) + low.byteswap() + high + _folded(low, high)
        h = (h ^ h >> np.uint64(37)) * np.uint64(0x165667919E3779F9)
        out[i] = h ^ h >> np.uint64(32)
    return out


def grouped_hashes(texts: Sequence[bytes], size: int = GROUP) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The hashes of the words of several texts at once, some ``size`` bytes: the first of the texts, the hashes of
    all their words in order, and the number of words of each."""
    at = 0
    while at < len(texts):
        end, room = at + 1, size - len(texts[at])
        while end < len(texts) and len(texts[end]) < room:
            room -= len(texts[end]) + 1
            end += 1
        if room < 0:
            h = word_hashes(texts[at])
            yield at, h, np.array([len(h)])
        else:
            b = _LOWER[np.frombuffer(b" " + b" ".join(texts[at:end]) + b" ", np.uint8)]
            blank = _BLANK[b]
            edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
            starts, ends = edges[::2], edges[1::2]
            h = _short_hashes(b, starts, ends - starts)
            for i in np.flatnonzero(ends - starts > 16).tolist():
                h[i] = _known[b[starts[i]:ends[i]].tobytes()]
            bounds = np.cumsum([1, *(len(t) + 1 for t in texts[at:end])])
            yield at, h, np.diff(np.searchsorted(starts, bounds))
        at = end


def shingles(text: bytes, width: int = WIDTH, size: int = PIECE) -> np.ndarray:
    """Hash of every window of ``width`` words in order; one for all words if there are fewer; none without words."""
    return chained(word_hashes(text, size), width)


def chained(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The same from the hashes of all words."""
    if not len(h):
        return h
    w = min(width, len(h))
    n = len(h) - w + 1
    out = np.full(n, w, np.uint64)
    for k in range(w):
        out = mix(out) + h[k:k + n]
    return mix(out)


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingle hashes, ascending."""
    return np.unique(shingles(text, width))


def words(text: bytes) -> list[bytes]:
    """The lower-cased words; plain and slow, for spans and for tests."""
    return bytes(_LOWER[np.frombuffer(text, np.uint8)]).split()
