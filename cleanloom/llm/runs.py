"""Periodic runs of words: stretches that repeat themselves at once, as loops of a page or of a model do.

A run is a stretch of consecutive words with smallest period q, at least `least` words and `times` periods long, that no neighbouring
word extends. So the words a period apart overlap in at least k words, k being the least of max(least, times * q) - q over all q, and every
word of a run lies in a k-gram that its document has twice. Words outside such k-grams are masked; what is left falls into segments, and Main and
Lorentz's algorithm finds the runs of each: at the middle of a segment, a Z-function each way gives for every period how far words a period
apart agree on either side; then each half by itself. A run within a half that reaches the half's edge is told by the words
beyond, and was found whole further up. That is n * log(n) steps for n words, however they repeat.

k-grams are told apart by 64-bit hashes, which can only unmask more; segments are compared by the words themselves.

Defined results: a null text counts as empty; a text without words, or with fewer than `least`, has no run; runs are in order of start, then
period, and may overlap; repeated rows and null ids are documents of their own; an empty table gives an empty result. Texts are never cut:
one row's words are in a task's memory at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..shipping import ship
from .common import pieces
from .words import mix

Run = tuple[int, int, int]


def overlap(least: int, times: int) -> int:
    """The fewest words in which any run overlaps itself, a period on: beyond q = least the overlap only grows."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def unmasked(words: list[bytes], k: int) -> list[tuple[int, int]]:
    """The stretches (start, end) of words that lie in k-grams which occur more than once."""
    n = len(words) - k + 1
    if n < 2:
        return []
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[j : n + j]
    grams = mix(grams)
    order = np.sort(grams)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, grams)
    starts = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == grams)
    cuts = np.flatnonzero(np.diff(starts) > k)  # what only touches is one stretch
    first = starts[np.concatenate([[0], cuts + 1])]
    last = starts[np.concatenate([cuts, [len(starts) - 1]])]
    return list(zip(first.tolist(), (last + k).tolist(), strict=True))


def prefixes(s: list[int], count: int) -> list[int]:
    """The Z-function: for i below count, how far s from i on agrees with s."""
    n, z, left, right = len(s), [0] * count, 0, 0
    if count:
        z[0] = n
    for i in range(1, count):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def matches(pattern: list[int], text: list[int], count: int) -> list[int]:
    """For i below count, how far text from i on agrees with pattern."""
    z, m, n = prefixes(pattern, len(pattern)), len(pattern), len(text)
    out, left, right = [0] * count, 0, 0
    for i in range(count):
        k = min(right - i, z[i - left]) if i < right else 0
        while k < m and i + k < n and pattern[k] == text[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def _beyond(u: list[int], v: list[int], most: int) -> Iterator[tuple[int, int, int]]:
    """For each period q of at most `most` that v has room for: how many words on either side of the middle, backwards into u and
    forwards into v, equal the word q further on."""
    most = min(most, len(v))
    back = u[::-1]
    ahead = prefixes(v, most + 1) if most < len(v) else [*prefixes(v, most), 0]
    behind = matches(back, v[:most][::-1] + back, most)
    for q in range(1, most + 1):
        yield q, behind[most - q], ahead[q]


def main_lorentz(s: list[int], least: int, times: int) -> list[Run]:
    """All runs (start, length, period) of s."""
    n, found, todo = len(s), {}, [(0, len(s))]

    def keep(start: int, end: int, q: int) -> None:
        whole = (start == 0 or s[start - 1] != s[start - 1 + q]) and (end == n or s[end] != s[end - q])
        if whole and end - start >= max(least, times * q):
            found[start, end] = min(q, found.get((start, end), q))

    while todo:
        low, high = todo.pop()
        if high - low < least:
            continue
        mid = (low + high) // 2
        u, v, most = s[low:mid], s[mid:high], (high - low) // times
        for q, back, ahead in _beyond(u, v, most):
            if back + ahead + q >= least:
                keep(mid - back, mid + q + ahead, q)
        for q, back, ahead in _beyond(v[::-1], u[::-1], most):  # the same from the other side
            if back + ahead + q >= least:
                keep(mid - q - ahead, mid + back, q)
        todo += [(low, mid), (mid, high)]
    return sorted((start, end - start, q) for (start, end), q in found.items())


def find_runs(words: list[bytes], least: int = 6, times: int = 4) -> list[Run]:
    """The runs of a text's words, by start, then period."""
    out = []
    for start, end in unmasked(words, overlap(least, times)):
        names: dict[bytes, int] = {}
        s = [names.setdefault(w, len(names)) for w in words[start:end]]
        out += [(start + at, length, q) for at, length, q in main_lorentz(s, least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period, a space between any two."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(batches: Iterable[pa.RecordBatch], least: int, times: int, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        at, size, found, texts = 0, 0, [], []

        def made(b: pa.RecordBatch, start: int, found: list, texts: list) -> pa.RecordBatch:
            columns = [b["id"].slice(start, len(texts)), pa.array(found, RUNS), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["id", "runs", "collapsed"])

        for t in b["text"]:
            words = (t.as_py() or "").encode().split()  # at space, tab, line feed, vertical tab, form feed and carriage return
            runs = find_runs(words, least, times)
            found.append([{"start": start, "length": length, "period": q} for start, length, q in runs])
            texts.append(collapsed(words, runs).decode())
            size += len(texts[-1])
            if size >= most:  # bytes, not rows, bound what a batch holds
                yield made(b, at, found, texts)
                at, size, found, texts = at + len(texts), 0, [], []
        if texts:
            yield made(b, at, found, texts)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """One row per row of docs: id, runs (array of start, length, period; start and length in words), collapsed (the text's words with the
    first period of each run only)."""
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return read.mapInArrow(lambda it: _find(it, least, times), f"id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
