"""Substring deduplication: paragraph MinHash banding.

A paragraph is a run of `words` words that starts at an anchor (winnowing): of each `within` - `words` + 1 neighbouring places the last whose
hash of two words is the least. What two texts share over at least `within` words, of whatever words, so has an anchor and a paragraph in common,
wherever it stands in a text, whatever its lines are. Paragraphs overlap; they start every (`within` - `words`) / 2 words or so.

1. One pass over the texts writes every paragraph's place and the 128-bit digest of its words: key and check, 64 bits each. Rows go by key, and
   a key with more than one check is split by it, so equal paragraphs are equal in 128 bits of a digest of the words themselves.
2. The same pass writes the bands of their MinHash values. A task gives each paragraph's once (by a bounded memory of keys),
   so one in a third of all texts makes few rows.
3. Each band's rows come together; only those of bands with different paragraphs of different texts (told by 32 bits of loc) go on, not what
   merely overlaps in a text. Their shingles are read from the texts.
4. Colliding paragraphs are verified by exact Jaccard similarity, in blocks of bounded size, and connected into clusters.
5. In each cluster (of copies or near copies) the first occurrence by (id, file, row, place) stays, and so does what is merely near
   it in the same text, as paragraphs are that start a word apart.
6. Equal paragraphs are extended word by word to both sides, as far as another text goes on alike (to the next paragraph, `within` - `words` words),
   and over one word that is changed, left out or put in if at least `size` words after it are alike again: a passage and its near copy
   then differ by at most one word in that stretch, an edit distance that is far within the threshold. What an earlier occurrence shares
   is removed, what only later ones share is this passage's first occurrence. Overlapping parts merge to spans.

With `rows` 2 and `bands` 5 two paragraphs of similarity 0.8 collide with probability 0.994, equal ones always.

A text is told from others by loc: the number of its file, of all files in order of their paths, and its row in it.
A task passes on, of equal surroundings of a paragraph, those that may be the first and ends the others there (by a bounded memory), so
a passage in a third of all texts makes few rows for the task in which its occurrences meet. Words beside a paragraph are compared on 32 bits.

Defined results: texts (or null) of fewer than `words` words have no paragraph; what repeats within one text only is left unless `across` is
unset; rows with the same id or equal rows are texts of their own; null ids sort last; ties of place cannot occur; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import forget, free_name, group_starts, listed, partitions, stage, tidy, unstage, whole_groups
from .components import components
from .exact_dedup import located
from .near_duplicates import _blocks, _labels, _pairs, _sorted_groups
from .words import WORD, hashed, hashed_texts, mix  # noqa: F401

#: keys of paragraphs, and surroundings, that a task remembers
SEEN, SEEN_BESIDE = 300_000, 50_000
#: characters of file names that are broadcast
SMALL = 10 << 20
#: bits of a text's number for its row
ROW_BITS = 39


@dataclass(frozen=True)
class Paragraphs:
    words: int = 20
    within: int = 50
    size: int = 5
    threshold: float = 0.8
    rows: int = 2
    bands: int = 5
    bucket: int = 512
    across: bool = True

    @property
    def window(self) -> int:
        return self.within - self.words + 1


def _last_least(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each `width` neighbours, of equal ones the last, by doubling."""
    n, at = 1, np.arange(len(h))
    while 2 * n <= width:
        a, b = at[:-n], at[n:]
        at, n = np.where(h[b] <= h[a], b, a), 2 * n
    a, b = at[: len(h) - width + 1], at[width - n : len(h) - n + 1]
    return np.where(h[b] <= h[a], b, a)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the `size` words from each place on."""
    n = len(words) - size + 1
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k])
    return h


_TIMES, _PLUS = mix(np.arange(1, 129, dtype=np.uint64)) | np.uint64(1), mix(np.arange(129, 257, dtype=np.uint64))


def anchors(texts: list[np.ndarray], p: Paragraphs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """texts: the words' hashes of each text. (text, start) of every paragraph of all texts, the words of all and its place there."""
    most, gap = np.uint64(2**64 - 1), max(p.words, p.window)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + gap) - lengths
    words = np.zeros(int(begins[-1] + lengths[-1]) + gap, np.uint64)
    for t, s in zip(texts, begins, strict=True):  # texts apart from each other, so that no window sees two
        words[s : s + len(t)] = t
    h = mix(mix(words[:-1]) + words[1:])
    room = np.maximum(lengths - p.words + 1, 0)  # places where a paragraph fits
    long = room > 0
    inside, whole = np.zeros(len(words) + 1, np.int8), np.zeros(len(words) + 1, np.int8)
    for marks, n in ((inside, room), (whole, np.maximum(room - p.window + 1, 1))):
        marks[begins[long]] += 1
        marks[begins[long] + n[long]] -= 1
    h[np.cumsum(inside)[: len(h)] == 0] = most
    least = _last_least(h, p.window)
    at = np.unique(least[np.cumsum(whole)[: len(least)] > 0])
    text = np.searchsorted(begins, at, side="right") - 1
    return text, at - begins[text], words, at


def bands_of(words: np.ndarray, at: np.ndarray, p: Paragraphs) -> np.ndarray:
    """The bands of the MinHash values of the paragraphs at some places of words."""
    runs = grams(words, p.size)[at + np.arange(p.words - p.size + 1)[:, None]]
    bands = np.zeros((len(at), p.bands), np.uint64)
    for k in range(p.rows):
        for b in range(p.bands):
            v = k * p.bands + b
            bands[:, b] += (runs * _TIMES[v] + _PLUS[v]).min(axis=0)
        bands = mix(bands)
    return mix(bands + np.arange(p.bands, dtype=np.uint64))


def digests(texts: list[list[str] | bytes], text: np.ndarray, start: np.ndarray, p: Paragraphs) -> np.ndarray:
    """(key, check) of each paragraph: a digest of its words. texts: of each its words, or the line of them."""
    out: list[bytes] = []
    cuts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])) if len(text) else np.zeros(1, np.int64)  # without a paragraph none
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        line = texts[int(text[lo])]
        if not isinstance(line, bytes):
            line = " ".join(line).encode("utf-8", "surrogatepass")
        begins = np.concatenate([[0], np.flatnonzero(np.frombuffer(line, np.uint8) == 32) + 1, [len(line) + 1]])
        own = start[lo:hi]
        places = zip(begins[own].tolist(), (begins[own + p.words] - 1).tolist(), strict=True)
        out += [blake2b(line[s:e], digest_size=16).digest() for s, e in places]
    return np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)


def _slabs(texts: Iterable[str | None], words: int = 100_000) -> Iterator[tuple[int, list[bytes], list[np.ndarray]]]:
    """(number of the first text, lines of words and the words' hashes of some texts), about `words` words at a time."""
    lines, part, first, n = [], [], 0, 0
    for k, (line, h) in enumerate(hashed_texts(texts)):
        lines.append(line)
        part.append(h)
        n += len(h)
        if n >= words:
            yield first, lines, part
            lines, part, first, n = [], [], k + 1, 0
    if part:
        yield first, lines, part


def _places(batches: Iterable[pa.RecordBatch], p: Paragraphs, more: Callable[..., dict] | None = None) -> Iterator[pa.RecordBatch]:
    """Each paragraph's text (its columns but the text itself), start, key and check, and what `more` makes of a slab's words, the paragraphs'
    places there and their keys."""
    for b in batches:
        kept = [c for c in b.schema.names if c != "text"]
        for first, split, part in _slabs(b["text"].to_pylist()):
            text, start, words, at = anchors(part, p)
            take, key = pa.array(text + first, pa.int64()), digests(split, text, start, p)
            columns = {c: b[c].take(take) for c in kept} | {"start": start.astype(np.int32), "key": key[:, 0], "check": key[:, 1]}
            yield pa.RecordBatch.from_pydict(columns | (more(words, at, key[:, 0]) if more else {}))


def band_names(p: Paragraphs) -> list[str]:
    return [f"band{k}" for k in range(p.bands)]


@tidy
def _banded(batches: Iterable[pa.RecordBatch], p: Paragraphs) -> Iterator[pa.RecordBatch]:
    """Paragraphs and the bands of their MinHash values; these are null where the task has given them before, for equal words."""
    seen: set[int] = set()

    def bands(words: np.ndarray, at: np.ndarray, key: np.ndarray) -> dict:
        if len(seen) > SEEN:
            seen.clear()
        new = np.array([x not in seen and not seen.add(x) for x in key.tolist()], bool)
        values = np.zeros((p.bands, len(at)), np.int64)
        values[:, new] = bands_of(words, at[new], p).view(np.int64).T
        return {name: pa.array(v, mask=~new) for name, v in zip(band_names(p), values, strict=True)}

    yield from _places(batches, p, bands)


def _colliding(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by band (one number, which Spark sorts by its digits), those of the bands that have more than one key and more than one
    text: paragraphs of one text that overlap collide too, but are no copies. Of a band that goes on in the next batch no more is kept than one
    text's rows."""
    band, tag, key = (np.empty(0, k) for k in (np.int64, np.int32, np.int64))
    for b in batches:
        band, tag, key = (np.concatenate([x, b[c].to_numpy()]) for x, c in ((band, "band"), (tag, "tag"), (key, "key")))
        if not len(band):
            continue
        starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
        live = _live(starts, tag) & _live(starts, key)
        rows = np.repeat(live, np.diff([*starts, len(band)]))
        yield pa.RecordBatch.from_arrays([pa.array(band[rows]), pa.array(key[rows])], ["band", "key"])
        band, tag, key = (x[starts[-1] :] for x in (band, tag, key))
        if live[-1] or (key == key[0]).all():
            few = np.unique([x for v in (tag, key) for x in (v.argmin(), v.argmax())])  # as many keys and texts as matter
        else:
            few = np.unique(key, return_index=True)[1]
        band, tag, key = band[few], tag[few], key[few]


def _live(starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.minimum.reduceat(values, starts) != np.maximum.reduceat(values, starts)


@tidy
def _insides(batches: Iterable[pa.RecordBatch], p: Paragraphs) -> Iterator[pa.RecordBatch]:
    """Of texts with the paragraphs that are asked of them, each paragraph's shingles."""
    for b in batches:
        text, (key, start) = _asked(b["asked"], "key", "start")
        for first, _, part in _slabs(b["text"].to_pylist()):
            lo, hi = np.searchsorted(text, [first, first + len(part)])
            words, begins = _apart(part, 0)
            inside = np.sort(grams(words, p.size)[(begins[text[lo:hi] - first] + start[lo:hi])[:, None] + np.arange(p.words - p.size + 1)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(key[lo:hi]), _binary(np.full(hi - lo, 8 * inside.shape[1]), inside)], ["key", "inside"])


def _asked(column: pa.ListArray, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of what is asked of each text: the text's number, ascending, and some fields."""
    text = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
    asked = column.flatten()
    return text, [asked.field(name).to_numpy() for name in names]


def _apart(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of some texts, `gap` zeros before, between and after them, and where each text begins."""
    zeros = np.zeros(gap, texts[0].dtype)
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.concatenate([zeros, *(x for t in texts for x in (t, zeros))]), np.cumsum(lengths + gap) - lengths


def _binary(lengths: np.ndarray, data: np.ndarray) -> pa.BinaryArray:
    """A column of binary values of these lengths, whose bytes data holds one after the other."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The bytes of a binary column without nulls as an array of numbers, a row for each value; all are of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _verify(batches: Iterable[pa.RecordBatch], p: Paragraphs) -> Iterator[pa.RecordBatch]:
    for t in whole_groups(batches, ["band", "i", "j"], 4096):
        starts, n = group_starts(t, ["band", "i", "j"]), t.num_rows
        ids = t["uid"].to_numpy()
        inside = _joined(t["inside"], np.uint64)
        new = np.concatenate([np.ones((n, 1), bool), inside[:, 1:] != inside[:, :-1]], axis=1)  # repeats within a paragraph count once
        size, bits = new.sum(axis=1), np.bitwise_or.reduce(np.uint64(1) << (inside & np.uint64(63)), axis=1)
        side, same = t["side"].to_numpy(), t["i"].to_numpy() == t["j"].to_numpy()
        enough = lambda common, a, b: common >= p.threshold * (size[a] + size[b] - common) - 1e-9  # noqa: B023, E731
        maybe = []
        for a, b in _pairs(starts, n, side, same):
            most = size[a] - np.bitwise_count(bits[a] & ~bits[b])  # a bit that the other has not is of a shingle that it has not
            ok = enough(most, a, b)
            maybe.append((a[ok], b[ok]))
        if maybe:
            a, b = (np.concatenate(x) for x in zip(*maybe, strict=True))
            turned, new, ok = np.ascontiguousarray(inside.T), np.ascontiguousarray(new.T), np.zeros(len(a), bool)
            for s in range(0, len(a), 4096):
                x, y = a[s : s + 4096], b[s : s + 4096]
                own, its = turned[:, x], turned[:, y]
                common = sum((its == own[k]).any(axis=0) & new[k, x] for k in range(len(own)))
                ok[s : s + 4096] = enough(common, x, y)
            a, b = a[ok], b[ok]
            label = _labels(ids, a, b)
            to = np.flatnonzero(label != ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids[to]), pa.array(label[to])], ["a", "b"])


def _near(places: DataFrame, texts: DataFrame, p: Paragraphs) -> DataFrame:
    """(node, root): clusters of different paragraphs, by their hashes."""
    banded = places.where(F.col(band_names(p)[0]).isNotNull())
    bands = banded.select(F.explode(F.array(*band_names(p))).alias("band"), F.hash("loc").alias("tag"), "key")
    found = bands.repartition(partitions(texts.sparkSession), "band").sortWithinPartitions("band").mapInArrow(_colliding, "band long, key long")
    hits = stage(found.distinct(), "passage-hits", 10_000)
    del bands, found
    forget(texts.sparkSession)
    keys, sizes = stage(hits.select("key").distinct(), "passage-keys"), stage(hits.groupBy("band").agg(F.count("*").alias("n")), "passage-sizes")
    # one place of each key, before the join: a hot key's places meet in partial aggregates
    at = places.groupBy("key").agg(F.min("loc").alias("loc"), F.min_by("start", "loc").alias("start")).join(keys, "key", "left_semi")
    asked = at.groupBy("loc").agg(F.collect_list(F.struct("key", "start")).alias("asked"))  # a text's paragraphs
    del at
    asked = stage(asked, "passage-asked")
    forget(texts.sparkSession)  # the shuffle files behind it go before the texts move
    read = asked.join(texts.select("loc", "text"), "loc").select("asked", "text")
    insides = read.mapInArrow(lambda it: _insides(it, p), "key long, inside binary")
    full = hits.join(sizes, "band").join(insides, "key").withColumnRenamed("key", "uid")
    edges = _sorted_groups(_blocks(full, F.ceil(F.col("n") / p.bucket)).drop("n"), "band", "i", "j").mapInArrow(lambda it: _verify(it, p), "a long, b long")
    out = stage(components(edges), "passage-clusters")
    unstage(hits, keys, sizes, asked)
    forget(texts.sparkSession)
    return out


class _Firsts:
    """Of a paragraph's surroundings that a task has met, the first place so far, and whether two texts went on with them: what comes
    later in another text then goes no further."""

    def __init__(self):
        self.known: dict[bytes, tuple[tuple, bool]] = {}

    def later(self, what: bytes, place: tuple) -> bool:
        if len(self.known) > SEEN_BESIDE:
            self.known.clear()
        first, two = self.known.get(what, (place, False))
        if two and first < place and first[2] != place[2]:
            return True
        self.known[what] = min(first, place), two or first[2] != place[2]
        return False


@tidy
def _beside(batches: Iterable[pa.RecordBatch], p: Paragraphs) -> Iterator[pa.RecordBatch]:
    """Of texts with paragraphs that are asked of them, the words after (side 0) and before (side 1) each, as 32-bit hashes; 0 is the text's
    end. Those that have their like earlier in the task are done: salt spreads them, and their words stay here but for how many they are."""
    reach, firsts = p.window - 1, _Firsts()
    for b in batches if reach else ():
        text, fields = _asked(b["asked"], "key", "side", "start", "cluster")
        for first, _, part in _slabs(b["text"].to_pylist()):
            lo, hi = np.searchsorted(text, [first, first + len(part)])
            of, (key, side, start, cluster) = text[lo:hi], (x[lo:hi] for x in fields)
            words, begins = _apart([np.maximum(x >> np.uint64(32), np.uint64(1)).astype(np.uint32) for x in part], reach)
            at, both = begins[of - first] + start, np.concatenate([words, words[::-1]])
            at = np.where(side == 0, at + p.words, len(both) - at)
            some = np.flatnonzero(both[at])
            of, key, side, start, cluster, at = (x[some] for x in (of, key, side, start, cluster, at))
            beside = np.lib.stride_tricks.sliding_window_view(both, reach)[at]
            whats = np.concatenate([key.view(np.uint32).reshape(-1, 2), side.astype(np.uint32)[:, None], beside], axis=1)
            whats = whats.view(f"V{4 * whats.shape[1]}").ravel().tolist()
            to = pa.array(of)
            ids, locs = b["id"].take(to), b["loc"].take(to)
            places = zip(ids.is_null().to_pylist(), ids.fill_null(0).to_pylist(), locs.to_pylist(), start.tolist(), strict=True)
            done = np.fromiter(map(firsts.later, whats, places), bool, len(whats))
            salt, over = (np.where(done, x, 0).astype(np.int32) for x in (1 + locs.to_numpy() % 1024, np.count_nonzero(beside, axis=1)))
            cols = (key, side, beside[:, 0].astype(np.int64), salt, start, cluster, over)
            yield pa.RecordBatch.from_arrays([ids, locs, *map(pa.array, cols), _binary(np.where(done, 0, 4 * reach), beside[~done])], [x.split()[0] for x in BESIDE.split(", ")])


BESIDE = "id long, loc long, key long, side int, word long, salt int, start int, cluster long, done int, words binary"
GROUP = ["key", "side", "word", "salt"]


def _over_an_edit(words: np.ndarray, row: np.ndarray, other: np.ndarray, alike: np.ndarray, size: int) -> np.ndarray:
    """How far (in words of row) each row is like its other one over one word that is changed, left out or put in after the first
    `alike` words: `alike` where fewer than `size` words after it are like the other's again."""
    best, reach = alike.copy(), words.shape[1]
    padded = np.concatenate([words, np.zeros((len(words), 2), np.uint32)], axis=1)
    for own, its in ((1, 1), (1, 0), (0, 1)):  # words skipped of the row, of the other
        run, going = np.zeros(len(row), np.int64), np.ones(len(row), bool)
        for r in range(reach):
            x, y = np.minimum(alike + own + r, reach), np.minimum(alike + its + r, reach)
            going &= (padded[row, x] == padded[other, y]) & (padded[row, x] != 0)
            if not going.any():
                break
            run += going
        best = np.where(run >= size, np.maximum(best, alike + own + run), best)
    return best


def _span(t: pa.Table, rows: np.ndarray, length: np.ndarray, removed: bool, p: Paragraphs) -> pa.RecordBatch:
    """The spans of some rows' paragraphs with `length` words beside them."""
    start, side = t["start"].to_numpy()[rows], t["side"].to_numpy()[rows]
    begin, end = start - np.where(side == 1, length, 0), start + p.words + np.where(side == 0, length, 0)
    to = pa.array(rows)
    cols = [*(t[c].take(to).combine_chunks() for c in ("id", "loc")), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), t["cluster"].take(to).combine_chunks()]
    return pa.RecordBatch.from_arrays([*cols, pa.array(np.full(len(rows), removed))], ["id", "loc", "start", "end", "cluster", "removed"])


def _lengthen(batches: Iterable[pa.RecordBatch], p: Paragraphs) -> Iterator[pa.RecordBatch]:
    """Spans from each paragraph to the last word that another text has in common (kept), that an earlier occurrence has (removed)."""
    for t in whole_groups(batches, GROUP, 8192):
        done = t["done"].to_numpy()
        yield _span(t, over := np.flatnonzero(done), done[over], True, p)
        t = t.filter(pa.array(done == 0)).combine_chunks()
        n = t.num_rows
        if not n:
            continue
        words = _joined(t["words"], np.uint32)
        group = np.zeros(n, np.int64)
        group[group_starts(t, GROUP)] = 1
        group = np.cumsum(group)
        loc, start = t["loc"].to_numpy(), t["start"].to_numpy()
        by_rank = np.lexsort((start, loc, t["id"].fill_null(0).to_numpy(), t["id"].is_null().to_numpy()))
        rank = np.empty(n, np.int64)
        rank[by_rank] = np.arange(n)
        o = np.lexsort((*words.T[::-1], group))
        new = np.concatenate([[True], group[o][1:] != group[o][:-1]])
        shared, earlier = np.zeros(n, np.int64), np.zeros(n, np.int64)
        first, other = np.arange(n), np.arange(n)  # of those that go on alike the longest, the first; where a row is that itself, the next
        for r in range(words.shape[1]):  # those that go on alike for r + 1 words stand together
            new[1:] |= words[o[1:], r] != words[o[:-1], r]
            at = np.flatnonzero(new)
            count = np.diff([*at, n])
            low = np.repeat(np.minimum.reduceat(loc[o], at) != np.maximum.reduceat(loc[o], at), count) if p.across else np.repeat(count > 1, count)
            ok = low & (words[o, r] != 0)
            if not ok.any():
                break
            least = np.repeat(np.minimum.reduceat(rank[o], at), count)
            most = np.repeat(np.maximum.reduceat(rank[o], at), count)
            shared[o] += ok
            earlier[o] += ok & (rank[o] != least)
            first[o[ok]], other[o[ok]] = by_rank[least[ok]], by_rank[most[ok]]
        rows = np.arange(n)
        later = first != rows
        met = np.flatnonzero(shared)
        beyond = _over_an_edit(words, met, np.where(later, first, other)[met], shared[met], p.size)
        further = np.where(later[met] & (earlier[met] == shared[met]), beyond, earlier[met])
        shared[met], earlier[met] = beyond, further
        for length, removed, rows in ((earlier, True, np.flatnonzero(earlier)), (shared, False, np.flatnonzero(shared > earlier))):
            yield _span(t, rows, length[rows], removed, p)


def _extended(found: DataFrame, texts: DataFrame, p: Paragraphs) -> DataFrame:
    """Spans (id, loc, start, end, cluster, removed) of equal paragraphs with the words beside them that are shared too. Asked are the
    paragraphs that no other of their text overlaps on a side, wherever they occur."""
    by_text = Window.partitionBy("loc", "removed").orderBy("start")
    after, before = F.lead("start").over(by_text) - F.col("start"), F.col("start") - F.lag("start").over(by_text)
    open_side = lambda gap: F.coalesce(gap > p.words, F.lit(True))
    sides = F.array_compact(F.array(F.when(open_side(F.col("after")), F.lit(0)), F.when(open_side(F.col("before")), F.lit(1))))
    open_keys = found.withColumn("after", after).withColumn("before", before).select("key", F.explode(sides).alias("side")).distinct()
    open_keys = stage(open_keys, "passage-open")
    asked = found.join(open_keys, "key").groupBy("loc").agg(F.collect_list(F.struct("key", "side", "start", "cluster")).alias("asked"))
    asked = stage(asked, "passage-beside")
    forget(texts.sparkSession)
    read = asked.join(texts, "loc").select("id", "loc", "asked", "text")
    beside = read.mapInArrow(lambda it: _beside(it, p), BESIDE)
    return _sorted_groups(beside, *GROUP).mapInArrow(lambda it: _lengthen(it, p), "id long, loc long, start int, end int, cluster long, removed boolean")


def numbers(scan: DataFrame) -> DataFrame:
    """(path, number) of the files of a scan. The driver lists all of them anyway, to plan the scan."""
    _, file, _ = located(scan)
    paths = sorted(r[0] for r in scan.select(file).distinct().collect())
    if len(paths) >> (63 - ROW_BITS):
        raise ValueError("more files than a text's number has room for")
    named = listed(scan.sparkSession, {"path": paths, "number": range(len(paths))}, "path string, number long")
    return F.broadcast(named) if sum(map(len, paths)) < SMALL else stage(named, "file-numbers", 10_000)  # of a size that Spark knows


def with_loc(scan: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """scan and the number of each row: its file's, then its row's."""
    _, file, row = located(scan)
    f, r, path, number = (free_name(scan, x) for x in ("at_file", "at_row", "file_path", "file_number"))
    tagged = scan.select("*", file.alias(f), row.alias(r)).join(files.select(F.col("path").alias(path), F.col("number").alias(number)), F.col(f) == F.col(path))
    return tagged.withColumn(name, F.shiftleft(F.col(number), ROW_BITS).bitwiseOR(F.col(r))).drop(f, r, path, number)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Paragraphs = Paragraphs()) -> DataFrame:  # noqa: B008
    """Spans of words that occur in more than one text: id, start and end (in words of the text), removed (unset for a cluster's first
    occurrence), cluster (of one of its paragraphs), loc (of the text: file and row)."""
    scan, _, _ = located(docs)
    return _repeats(scan, numbers(scan), id_col, text_col, p)


def _repeats(scan: DataFrame, files: DataFrame, id_col: str, text_col: str, p: Paragraphs) -> DataFrame:
    ship(scan.sparkSession)
    loc = free_name(scan, "loc")
    texts = with_loc(scan, files, loc).select(F.col(id_col).cast("long").alias("id"), F.col(loc).alias("loc"), F.col(text_col).cast("string").alias("text"))
    places = stage(texts.mapInArrow(lambda it: _banded(it, p), ", ".join(["id long, loc long, start int, key long, check long", *(f"{x} long" for x in band_names(p))])), "passages")
    keys = places.groupBy("key").agg(F.count("*").alias("n"), F.min("check").alias("least"), F.max("check").alias("most")).where("n > 1")
    several = stage(keys.select("key", (F.col("least") != F.col("most")).alias("split")), "passage-again", 10_000)
    split = several.where("split").select("key")  # different paragraphs with one key: go by their check instead, and are near nothing
    near = _near(places, texts, p).join(split, F.col("node") == F.col("key"), "left_anti")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "loc", "start")
    wanted = several.unionByName(near.join(several, F.col("node") == F.col("key"), "left_anti").select(F.col("node").alias("key"), F.lit(False).alias("split")))
    wanted = stage(wanted, "passage-wanted", 10_000)
    met = places.drop(*band_names(p)).join(wanted, "key").withColumn("key", F.when(F.col("split"), F.xxhash64("key", "check")).otherwise(F.col("key")))
    met = stage(met.drop("check", "split"), "passage-met", 10_000)  # what is like nothing else goes no further
    forget(scan.sparkSession)
    known = met.groupBy("key").agg(F.min(place).alias("first"), F.min("loc").alias("low"), F.max("loc").alias("high")).join(near, F.col("key") == F.col("node"), "left")
    known = stage(known.select("key", F.coalesce("root", "key").alias("cluster"), "first", "low", "high"), "passage-known", 10_000)
    heads = known.groupBy("cluster").agg(F.min("first").alias("head"), F.min("low").alias("low"), F.max("high").alias("high"))
    heads = stage((heads.where("low <> high") if p.across else heads).drop("low", "high"), "passage-heads", 10_000)
    known = known.join(heads, "cluster").select("key", "cluster", "first", "head")
    again = ~place.eqNullSafe(F.col("first")) | (F.col("loc") != F.col("head.loc"))  # in the head's text, only what occurs again word by word
    found = met.join(known, "key").select("key", "id", "loc", "start", "cluster", again.alias("removed"))
    found = stage(found, "passage-found", 10_000)
    unstage(places, several, wanted, met)
    forget(scan.sparkSession)
    found = found.select("id", "loc", "start", (F.col("start") + p.words).alias("end"), "cluster", "removed").unionByName(_extended(found, texts, p))
    by_text = Window.partitionBy("loc", "removed").orderBy("start", "end")
    before = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.coalesce(F.col("start") > before, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("loc", "removed", "island").agg(F.min("id").alias("id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("cluster").alias("cluster")).select("id", "start", "end", "removed", "cluster", "loc")


def word_spans(text: str) -> list[tuple[int, int]]:
    """The places in a text of the words of the text in lower case. A character may be two in lower case, and is cut whole."""
    low = text.lower()
    found = [m.span() for m in WORD.finditer(low)]
    if len(low) == len(text):
        return found
    ends = np.cumsum([len(c.lower()) for c in text])
    return [(int(np.searchsorted(ends, s, "right")), int(np.searchsorted(ends, e)) + 1) for s, e in found]


def _cut(batches: Iterable[pa.RecordBatch], text_col: str, spans_col: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for text, spans in zip(b[text_col].to_pylist(), b[spans_col].to_pylist(), strict=True):
            if spans:
                at = word_spans(text)
                for s in sorted(spans, key=lambda s: -s["start"]):
                    text = text[: at[s["start"]][0]] + text[at[s["end"] - 1][1] :]
            texts.append(text)
        cols = [pa.array(texts, pa.string()) if c == text_col else b[c] for c in b.schema.names if c != spans_col]
        yield pa.RecordBatch.from_arrays(cols, [c for c in b.schema.names if c != spans_col])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Paragraphs = Paragraphs()) -> DataFrame:  # noqa: B008
    """docs with the words of removed spans cut out of their texts; all rows and columns stay. Null and empty texts, and those without a
    removed span, are as they were; of repeated rows each is a text of its own, the first keeps its words."""
    scan, _, _ = located(docs)
    files = numbers(scan)
    spans = _repeats(scan, files, id_col, text_col, p).where("removed").groupBy("loc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    at, sp = free_name(scan, "at_loc"), free_name(scan, "cut_spans")
    tagged = with_loc(scan, files, at)
    joined = tagged.join(spans.select(F.col("loc").alias("__loc"), F.col("spans").alias(sp)), tagged[at] == F.col("__loc"), "left").drop("__loc", at)
    return joined.mapInArrow(lambda it: _cut(it, text_col, sp), scan.schema)
