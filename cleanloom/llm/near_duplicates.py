"""N-gram Jaccard join with Bayesian candidate pruning.

1. Texts with the same words are one class. Every class has MinHash values of its word shingles; bands of them make candidates.
2. Candidates are compared on their MinHash values, a step of values at a time. With a uniform prior on the similarity, the
   posterior probability that it reaches the threshold, given m of n equal values, is a binomial sum; pairs for which it falls below
   the tolerance are dropped.
3. What is left connects classes into loose components. There each class's shingles, made once, meet those of the others in blocks; the
   pairs that survive the posterior, and only those, are verified exactly. So a chain of texts each less like the next than the
   threshold costs a pair for each link, not all pairs of the chain.

No pairs are written out: tasks hand on, per class, how many documents it is linked to and one edge towards its group.
Buckets and components of any size are cut into blocks (by rows and by shingles), one task per pair of blocks, so no task holds an
unbounded group. A component of M different texts that are all near each other has M * M / 2 links to verify, and its shingles are copied once
for each of its M / `block` blocks: the price of exact numbers of links.

Defined results: a text without words (or null) is in a class of its own, without links; a text shorter than a shingle is one shingle;
rows with the same id or equal rows are documents of their own; null ids sort last; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import forget, group_starts, partitions, stage, tidy, unstage, whole_groups
from .components import components
from .exact_dedup import FILTERS, located, settings, texts_at, without
from .words import hashed, mix, shingles, split_words


@dataclass(frozen=True)
class Join:
    """What similarity counts, and how candidates are found: a pair at the threshold is missed by all bands with
    probability (1 - threshold ** rows) ** bands, 3e-6 by default."""

    size: int = 5
    threshold: float = 0.8
    rows: int = 5
    bands: int = 32
    tolerance: float = 1e-6
    step: int = 32
    bucket: int = 512
    block: int = 512
    block_shingles: int = 1 << 20

    @property
    def values(self) -> int:
        return self.rows * self.bands


_FACTORS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def minhash(sh: np.ndarray, values: int) -> np.ndarray:
    """The least of each hash function over the shingles, as 32-bit values."""
    if values not in _FACTORS:
        k = mix(np.arange(1, 2 * values + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _FACTORS[values] = k[:values] | np.uint64(1), k[values:]
    times, plus = _FACTORS[values]
    best = np.full(values, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(sh), 512):
        best = np.minimum(best, (sh[s : s + 512, None] * times + plus).min(axis=0))
    return (best >> np.uint64(32)).astype(np.uint32)


def least_equal(join: Join) -> np.ndarray:
    """For n values compared, the fewest equal ones with which a pair stays. Values are compared on 8 bits, so unequal ones
    agree once in 256; the posterior P(similarity >= threshold) is P(Binomial(n + 1, threshold) <= m)."""
    t = join.threshold + (1 - join.threshold) / 256
    out = np.zeros(join.values + 1, np.int64)
    for n in range(1, join.values + 1):
        below, m = 0.0, 0
        while m <= n:
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if below >= join.tolerance:
                break
            m += 1
        out[n] = m
    return out


@tidy
def _sign(batches: Iterable[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, bands, codes = [], [], []
        for text in b["text"].to_pylist():
            words = split_words(text)
            keys.append(hashlib.blake2b("\n".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
            if not words:
                bands.append(None)
                codes.append(None)
                continue
            sig = minhash(shingles(hashed(words), join.size), join.values)
            h = np.zeros(join.bands, np.uint64)
            for k in range(join.rows):
                h = mix(h + sig[k :: join.rows].astype(np.uint64) + np.uint64(k + 1))
            bands.append(mix(h + np.arange(join.bands, dtype=np.uint64)).view(np.int64))
            codes.append(sig.astype(np.uint8).tobytes())
        cols = [b[c] for c in b.schema.names if c != "text"]
        names = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(codes, pa.binary())], [*names, "key", "bands", "code"])


def _pairs(starts: np.ndarray, n: int, side: np.ndarray, same: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each group, a distance at a time; where same is unset, only pairs of different sides."""
    ends = np.repeat([*starts[1:], n], np.diff([*starts, n]))
    left = np.arange(n)
    for d in range(1, n):
        left = left[left + d < ends[left]]
        if not len(left):
            return
        ok = same[left] | (side[left] != side[left + d])
        yield left[ok], left[ok] + d


def _labels(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the smallest id that the pairs a-b connect it with."""
    label = ids.copy()
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (old == label).all():
            return label


def _survivors(code: np.ndarray, starts: np.ndarray, side: np.ndarray, same: np.ndarray, join: Join, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of each group that the posterior leaves."""
    for a, b in _pairs(starts, len(code), side, same):
        equal = np.zeros(len(a), np.int64)
        for s in range(0, join.values, join.step):
            e = min(s + join.step, join.values)
            equal += (code[a, s:e] == code[b, s:e]).sum(axis=1)
            stay = equal >= least[e]
            a, b, equal = a[stay], b[stay], equal[stay]
            if not len(a):
                break
        if len(a):
            yield a, b


def _codes(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["code"].to_pylist()), np.uint8).reshape(t.num_rows, -1)


def _prune(batches: Iterable[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    least, keys = least_equal(join), ["band", "i", "j"]
    for t in whole_groups(batches, keys, 8192):
        ids = t["uid"].to_numpy()
        found = list(_survivors(_codes(t), group_starts(t, keys), t["side"].to_numpy(), t["i"].to_numpy() == t["j"].to_numpy(), join, least))
        if not found:
            continue
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        label = _labels(ids, a, b)
        to = np.flatnonzero(label != ids)
        yield pa.RecordBatch.from_arrays([pa.array(ids[to]), pa.array(label[to])], ["a", "b"])


@tidy
def _shingled(batches: Iterable[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingles(hashed(split_words(x)), join.size) for x in b["text"].to_pylist()]
        names = [c for c in b.schema.names if c != "text"]
        made = [pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays([*(b[c] for c in names), *made], [*names, "length", "shingles"])


def _verify(batches: Iterable[pa.RecordBatch], join: Join) -> Iterator[pa.RecordBatch]:
    least, keys = least_equal(join), ["root", "i", "j"]
    for t in whole_groups(batches, keys, 1024):
        starts = group_starts(t, keys)
        ids, weight, size = t["uid"].to_numpy(), t["n"].to_numpy(), t["length"].to_numpy()
        found = list(_survivors(_codes(t), starts, t["side"].to_numpy(), t["i"].to_numpy() == t["j"].to_numpy(), join, least))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        linked = np.zeros(len(a), bool)
        cuts = np.searchsorted(a, [*starts, t.num_rows])
        for s, e, lo, hi in zip(starts, [*starts[1:], t.num_rows], cuts, cuts[1:], strict=False):
            if lo < hi:
                sets = [np.frombuffer(x, np.uint64) for x in t["shingles"][s:e].to_pylist()]
                common = commons(sets, a[lo:hi] - s, b[lo:hi] - s)
                linked[lo:hi] = common >= join.threshold * (size[a[lo:hi]] + size[b[lo:hi]] - common) - 1e-9
        a, b = a[linked], b[linked]
        links = np.bincount(a, weight[b], t.num_rows) + np.bincount(b, weight[a], t.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(_labels(ids, a, b)), pa.array(links.astype(np.int64))], ["a", "b", "links"])


def commons(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, cells: int = 1 << 24) -> np.ndarray:
    """How many elements sets a and b have in common, for each pair: sets are bit rows over the elements that two or more of them have."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    row, column = row[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(64, cells // len(sets) // 64 * 64)
    out = np.zeros(len(a), np.int64)
    for s in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [s, s + width])
        has = np.zeros((len(sets), min(width, -(-(int(column[hi - 1]) - s + 1) // 64) * 64)), bool)
        has[row[lo:hi], column[lo:hi] - s] = True
        bits = np.packbits(has, axis=1).view(np.uint64)
        step = max(1, (1 << 20) // bits.shape[1])
        for k in range(0, len(a), step):
            out[k : k + step] += np.bitwise_count(bits[a[k : k + step]] & bits[b[k : k + step]]).sum(axis=1, dtype=np.int64)
    return out


def _blocks(df: DataFrame, blocks: Column) -> DataFrame:
    """Every row once for each pair of blocks i <= j of its group's `blocks` that its own block, side, is in."""
    df = df.withColumn("blocks", blocks.cast("int")).withColumn("side", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return df.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).drop("blocks", "other")


def _sorted_groups(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:  # noqa: B008
    """One row per row of docs: id, class_id (the smallest id of its group: documents connected by links), n_links (other
    documents whose similarity reaches the threshold), kept (one row of each group: the first by id), file, row."""
    ship(docs.sparkSession)
    forget(docs.sparkSession)
    scan, file, row = located(docs)
    read = scan.select(scan[id_col].alias("id"), file.alias("file"), row.alias("row"), scan[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = stage(read.mapInArrow(lambda it: _sign(it, join), f"id {kind}, file string, row long, key binary, bands array<long>, code binary"), "near-rows")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")
    classes = rows.where("code is not null").groupBy("key").agg(F.count("*").alias("n"), F.min(first).alias("first"), F.max("bands").alias("bands"), F.max("code").alias("code"))
    classes = stage(classes.withColumn("uid", F.monotonically_increasing_id()), "near-classes")

    bands = classes.select("uid", F.explode("bands").alias("band"))
    # what joins back to rows of a hot key is written first: then adaptive execution can split the rows' side
    live = stage(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "near-live")
    hits = _blocks(bands.join(live, "band"), F.ceil(F.col("n") / join.bucket)).select("uid", "band", "i", "j", "side")
    coded = hits.join(classes.select("uid", "code"), "uid")
    loose = _sorted_groups(coded, "band", "i", "j").mapInArrow(lambda it: _prune(it, join), "a long, b long")

    members = stage(components(loose), "near-members")
    at = members.join(classes, F.col("node") == F.col("uid")).select("root", "uid", "n", "code", F.col("first.file").alias("f"), F.col("first.row").alias("r"))
    at = stage(at, "near-at", 10_000)  # of known size, so that it is broadcast to the texts if it is small
    with settings(docs.sparkSession, FILTERS):
        met = texts_at(scan, text_col, at, "root", "uid", "n", "code")
        sets = stage(met.mapInArrow(lambda it: _shingled(it, join), "root long, uid long, n long, code binary, length long, shingles binary"), "near-sets")
    sizes = sets.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / join.block), F.ceil(F.sum("length") / join.block_shingles)).alias("cut"))
    sizes = stage(sizes, "near-sizes", 10_000)
    verified = _sorted_groups(_blocks(sets.join(sizes, "root"), F.col("cut")).drop("cut"), "root", "i", "j").mapInArrow(lambda it: _verify(it, join), "a long, b long, links long")
    verified = stage(verified, "near-verified")
    forget(docs.sparkSession)

    groups = stage(components(verified.select("a", "b")), "near-groups")
    links = verified.groupBy("a").agg(F.sum("links").alias("links"))
    known = classes.select("uid", "key", "n", "first").join(groups, F.col("uid") == F.col("node"), "left").join(links, F.col("uid") == F.col("a"), "left")
    known = known.select("key", "uid", "n", "first", F.coalesce("root", "uid").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    known = stage(known, "near-rooted")
    heads = stage(known.groupBy("root").agg(F.min("first").alias("head")), "near-heads")
    rooted, known = known, stage(known.join(heads, "root").select("key", (F.col("n") - 1 + F.col("links")).alias("n_links"), "head"), "near-known")
    unstage(live, members, at, sets, sizes, verified, groups, rooted, heads)
    out = rows.join(known, (rows["key"] == known["key"]) & rows["code"].isNotNull(), "left")
    alone = F.col("head").isNull()
    return out.select("id", F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), (alone | first.eqNullSafe(F.col("head"))).alias("kept"), "file", "row")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", join: Join = Join()) -> DataFrame:  # noqa: B008
    """docs with one row of each group of near duplicates; columns as they were."""
    scan, _, _ = located(docs)
    return without(scan, near_duplicates(scan, id_col, text_col, join).where("not kept"))
