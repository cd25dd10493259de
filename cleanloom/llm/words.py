"""Words and their hashes, for the operators on words and word shingles.

A word is a run of letters, digits or underscores, in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
#: hashes that a worker remembers, and the characters of their words
KNOWN, KNOWN_CHARS = 200_000, 4 << 20


class _Hashes(dict):
    chars = 0

    def clear(self) -> None:
        super().clear()
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self.chars += len(word)
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def split_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hashed(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    if len(_HASHES) > KNOWN or _HASHES.chars > KNOWN_CHARS:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


#: bytes of ASCII texts: words in lower case, all else spaces
_ASCII = bytes(ord(c.lower()) if WORD.match(c := chr(k)) and k < 128 else 32 for k in range(256))
#: the same for texts of which all other characters are of words, and the characters that are not
_LETTERS, _NO_WORD = _ASCII[:128] + bytes(range(128, 256)), re.compile(r"[^\w\x00-\x7f]+")
#: words of more bytes than this are hashed one by one; the first k bytes of eight
LONG, _FIRST = 64, np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_line(text: str | None) -> bytes:
    """The words of a text in UTF-8, a space between any two."""
    if not text:
        return b""
    if text.isascii():
        return b" ".join(text.encode().translate(_ASCII).split())
    return b" ".join(_NO_WORD.sub(" ", text.lower()).encode().translate(_LETTERS).split())


def hashed_lines(lines: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of the words of each line, eight bytes at a time for all words together. They are not those of `hashed`."""
    data = b"".join(x + b" " for x in lines if x) + bytes(8)
    ends = np.flatnonzero(np.frombuffer(data, np.uint8, len(data) - 8) == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    length = ends - starts
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # those from each byte on
    h = mix(mix(length.astype(np.uint64)) + (eight[starts] & _FIRST[np.minimum(length, 8)]))
    rest = np.flatnonzero((length > 8) & (length <= LONG))
    for k in range(8, LONG, 8):
        rest = rest[length[rest] > k]
        h[rest] = mix(h[rest] * np.uint64(0x9E3779B97F4A7C15) + (eight[starts[rest] + k] & _FIRST[np.minimum(length[rest] - k, 8)]))
    for i in np.flatnonzero(length > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    return np.split(h, np.searchsorted(ends, np.cumsum([len(x) + 1 if x else 0 for x in lines])[:-1])) if lines else []


def hashed_texts(texts: Iterable[str | None], size: int = 1 << 19) -> Iterator[tuple[bytes, np.ndarray]]:
    """(line, hashes of its words) of each text, for about `size` bytes at a time."""
    lines, n = [], 0
    for t in texts:
        lines.append(word_line(t))
        n += len(lines[-1])
        if n >= size:
            yield from zip(lines, hashed_lines(lines), strict=True)
            lines, n = [], 0
    yield from zip(lines, hashed_lines(lines), strict=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of `size` words, sorted; of all words where there are fewer; none without words."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    h = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : n - size + 1 + k] + np.uint64(size))
    return np.unique(h)
