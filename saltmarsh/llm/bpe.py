"""Byte-level BPE by longest matches with backtracking, and decoding by an offset table.

Text is cut into words as the vocabulary's file prescribes (the usual byte-level pattern), on arrays of
code point classes. A word's tokens follow from one pass of an Aho-Corasick automaton, which gives the
longest token at every byte: take it if the pair with the token before is one that merging would leave
apart, else its longest prefix, else step back. Merging order is encoded in the ids, so a pair is judged
once, by undoing the younger of its two tokens until no earlier merge can cross the border; verdicts are
kept. The time is linear in the length of a word. Words seen before come from a bounded table.
"""

from __future__ import annotations

import json

import ahocorasick
import numpy as np
from tokenizers.pre_tokenizers import ByteLevel

#: fixed values: endings cut off behind an apostrophe
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
SPACE, LETTER, NUMBER, OTHER, APART = range(5)
KNOWN_WORDS, KNOWN_PAIRS = 100_000, 300_000

#: code points whose classes are asked for together, as a power of two
RANGE_BITS = 12

_classes = np.append(np.full(0x110000, OTHER, np.uint8), np.uint8(APART))
_asked = np.zeros((0x110000 >> RANGE_BITS) + 1, bool)
_asked[-1] = True


def _ask(number: int) -> None:
    """Fill in the classes of a range of code points.

    Those behind the first 256 are split as one text: a piece holds neighbours of one class, which is asked
    for once.
    """
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str

    def kind(c: str) -> int:
        return next((k for k, known in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(known + c)) == 1), SPACE)

    every = range(number << RANGE_BITS, (number + 1) << RANGE_BITS)
    rest = np.array([i for i in every if i >= 256 and not 0xD800 <= i < 0xE000], np.int64)
    for i in range(every.start, min(256, every.stop)):
        _classes[i] = kind(chr(i))
    for _, (i, j) in split("".join(map(chr, rest.tolist()))):
        _classes[rest[i:j]] = kind(chr(rest[j - 1]))
    _asked[number] = True


def classes(code: np.ndarray | None = None) -> np.ndarray:
    """Class of every code point, or of those in ``code`` at least; the number above them, which stands for no text, is apart.

    Classes are those of the library's own splitter, whatever version of Unicode the interpreter has. It is
    asked for a range of code points when the first of them is met.
    """
    met = _asked if code is None else np.bincount(code >> RANGE_BITS, minlength=len(_asked)) > 0
    for number in np.flatnonzero(~_asked & (met | (code is None))).tolist():
        _ask(number)
    return _classes


def starts_of(code: np.ndarray) -> np.ndarray:
    """Where words begin in an array of code points, as the pattern of byte-level vocabularies cuts them."""
    code_or_mark = np.minimum(code, 0x110000)
    kind = classes(code_or_mark)[code_or_mark]
    n = len(code)
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == APART
    # the last blank before a word is a word of its own, or part of the next one if it is 0x20
    after = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] != APART)) + 1
    start[after - 1] = True
    start[after[code[after - 1] == 32]] = False
    # a lone apostrophe that begins a word, before a letter
    for i in np.flatnonzero((code[:-1] == 39) & start[:-1] & (kind[1:] == LETTER)):
        rest = "".join(chr(c) if c < 128 else "\0" for c in code[i + 1:i + 3].tolist())
        ending = next((e for e in ENDINGS if rest.startswith(e)), None)
        if ending:
            start[i + 1] = False
            if i + 1 + len(ending) < n:
                start[i + 1 + len(ending)] = True
    return np.flatnonzero(start)


def words_of(text: str) -> list[str]:
    if not text:
        return []
    at = starts_of(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)).tolist()
    return [text[i:j] for i, j in zip(at, [*at[1:], len(text)])]


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in vocabulary files: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens of a byte-level BPE file: ids, how each was merged, prefixes, bytes by offset."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        raw = {i: bytes(letters[c] for c in t) for t, i in ids.items()}
        n = max([*raw, *self.special.values()]) + 1
        self.left, self.right, self.merged = [-1] * n, [-1] * n, {}
        last = -1
        for a, b in merges:
            x, y, z = ids[a], ids[b], ids[a + b]
            if z <= last:
                raise ValueError("ids must follow the order of merges")
            last = self.merged[x, y] = z
            self.left[z], self.right[z] = x, y
        self.size = [len(raw.get(i, b"")) for i in range(n)]
        by_bytes = {t: i for i, t in raw.items()}
        self.shorter = [-1] * n
        self.matcher = ahocorasick.Automaton()
        for t, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_bytes), -1)
            self.matcher.add_word(t.decode("latin-1"), (i, len(t)))
        self.matcher.make_automaton()
        for text, i in self.special.items():
            raw[i] = text.encode()
        self.offsets = np.zeros(n + 1, np.int64)
        np.cumsum([len(raw.get(i, b"")) for i in range(n)], out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(n)), np.uint8)
        self.pairs: dict[int, bool] = {}

    def apart(self, x: int, y: int) -> bool:
        """Whether ``x`` followed by ``y`` is what merging their joint bytes gives."""
        bound = 1 << 62
        while True:
            m = self.merged.get((x, y))
            if m is not None and m < bound:
                return False
            can_x, can_y = self.right[x] >= 0, self.left[y] >= 0
            if can_x and (x > y or not can_y):
                bound, x = x, self.right[x]
            elif can_y:
                bound, y = y + 1, self.left[y]
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        n, size, pairs = len(word), self.size, self.pairs
        longest = [0] * n
        for end, (token, length) in self.matcher.iter(word.decode("latin-1")):
            longest[end - length + 1] = token  # ends ascend: the last one is the longest
        open_at = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + size[token]
            fits = open_at[end]
            if fits and out:
                key = out[-1] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= KNOWN_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.apart(out[-1], token)
            if fits:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                open_at[at] = 0
                token = out.pop()
                at -= size[token]

    def decode(self, ids: np.ndarray, part: int = 1 << 20) -> bytes:
        """Bytes of the ids, cut from one array of all token bytes at the offsets of each."""
        out = []
        for i in range(0, len(ids), part):
            some = ids[i:i + part]
            begin = self.offsets[some]
            length = self.offsets[some + 1] - begin
            shift = np.repeat(begin - np.cumsum(length) + length, length)
            out.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(out)


class Known(dict):
    """Word to (ids as little-endian unsigned 32-bit bytes, decimal ids each with a comma); forgets all when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if len(self) >= KNOWN_WORDS:
            self.clear()
        ids = self.encode(word)
        found = np.array(ids, "<u4").tobytes(), b"".join(b"%d," % i for i in ids)
        if len(word) <= 64:
            self[word] = found
        return found


_loaded: dict[str, tuple[Vocabulary, Known]] = {}


def load(path: str) -> tuple[Vocabulary, Known]:
    """Vocabulary and word table of this process."""
    if path not in _loaded:
        v = Vocabulary(path)
        _loaded[path] = v, Known(lambda w: v.encode_word(w.encode("utf-8", "surrogatepass")))
    return _loaded[path]


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """Parts of the text between special tokens, and the ids of those."""
    parts: list[str | int] = [text]
    for token, i in special.items():
        if token in text:
            parts = [q for p in parts for q in ([p] if isinstance(p, int) else _around(p, token, i))]
    return parts


def _around(text: str, token: str, i: int) -> list[str | int]:
    first, *rest = text.split(token)
    return [first, *[x for r in rest for x in (i, r)]]


def encode(text: str, special: dict[str, int], known: Known) -> tuple[bytes, bytes]:
    """Ids of a whole text as bytes, and as decimals with a comma behind each."""
    found = []
    for part in split_special(text, special):
        if isinstance(part, int):
            found.append((np.array([part], "<u4").tobytes(), b"%d," % part))
        else:
            found.extend(map(known.__getitem__, words_of(part)))
    return b"".join([f[0] for f in found]), b"".join([f[1] for f in found])
