"""MinHash near duplicates from two permutations (circulant MinHash), confirmed on whole shingle sets.

1. A text's shingles are hashed, and one permutation of 64-bit integers scatters them over a ring of `RING` places. A second permutation, of
   the ring's places, is shifted by 0, 1, 2, ... places: the k-th coordinate of a signature is the least value that the k-th shift gives to any place of the
   text. So two permutations make all coordinates, and a shingle reads consecutive entries of one table.
2. Texts with equal shingle sets are one class. Bands of a class's signature make buckets. Two classes of similarity s share none of them
   with probability (1 - s ** rows) ** bands, 2.6e-7 at the default's 0.85. Large sets that meet in the same places only look more alike.
3. A bucket's first and last class meet all the others of the bucket: two pairs a member, confirmed by exact counts. What these links connect is a group.
4. Buckets whose other classes are of one group are done, which leaves few: members of one group need no link between them. In those left, all pairs of different
   groups meet, in blocks of `block` classes and `block_shingles` shingles, each class once for buckets of the same members.
5. Components of all links.

No pairs are written but the two a member, and no task holds more than a pair of blocks. Pairs whose sizes alone rule out the threshold are not compared.

Defined results: only A-Z are lower-cased, words are what ASCII white space separates; a text with fewer words than a shingle is one shingle, of all its
words; a text without words, or null, has an empty set and is linked with nothing; rows with the same id or equal rows are documents of their own, all with the
component's smallest id; null ids sort last; an empty table gives an empty result. Shingles are told apart by 64-bit hashes, sets by a digest of 128 bits of these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import group_starts, partitions, stage, unstage, whole_groups
from .components import components
from .exact_dedup import FILTERS, located, settings, texts_at
from .near_duplicates import commons
from .words import hashed_lines, mix, shingles

#: places of the ring; a power of two
RING = 1 << 21
#: rows of shingle sets in an Arrow batch
SETS = 100
_LOWER = bytes.maketrans(ascii_uppercase.encode(), ascii_lowercase.encode())


@dataclass(frozen=True)
class Circulant:
    """What similarity counts (shingles of `size` words, `percent` of the union in common), and how candidates are found."""

    size: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 32
    star: int = 256
    block: int = 512
    block_shingles: int = 1 << 20

    @property
    def values(self) -> int:
        return self.rows * self.bands


def word_lines(texts: Iterable[str | None]) -> list[bytes]:
    return [b" ".join((t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()) for t in texts]


def shingle_sets(texts: list[str | None], size: int, most: int = 1 << 19) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text; words are hashed for about `most` bytes of texts at a time."""
    lines, n = [], 0
    for line in word_lines(texts):
        lines.append(line)
        n += len(line)
        if n >= most:
            yield from (shingles(h, size) for h in hashed_lines(lines))
            lines, n = [], 0
    yield from (shingles(h, size) for h in hashed_lines(lines))


_TABLES: dict[int, np.ndarray] = {}


def shifted(values: int) -> np.ndarray:
    """The second permutation, as a table whose row p holds what the shifts 0, 1, ... give to place p: a view of one array, wound once round."""
    if values not in _TABLES:
        ring = np.random.default_rng(0x5EED).permutation(RING).astype(np.uint32)
        _TABLES[values] = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[: values - 1]]), values)
    return _TABLES[values]


def signature(sh: np.ndarray, values: int, step: int = 512) -> np.ndarray:
    """The least value of each shift over the places of the shingles; not for an empty set."""
    table = shifted(values)
    places = (mix(sh + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(RING - 1)).astype(np.int64)
    best = np.full(values, RING, np.uint32)
    for s in range(0, len(places), step):
        best = np.minimum(best, table[places[s : s + step]].min(axis=0))
    return best


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A hash of each band's number and values."""
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[k::rows].astype(np.uint64))
    return h.view(np.int64)


def _sign(batches: Iterable[pa.RecordBatch], how: Circulant) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, sizes, bands = [], [], []
        for sh in shingle_sets(b["text"].to_pylist(), how.size):
            keys.append(hashlib.blake2b(sh.tobytes(), digest_size=16).digest())
            sizes.append(len(sh))
            bands.append(band_keys(signature(sh, how.values), how.rows, how.bands) if len(sh) else None)
        names = [c for c in b.schema.names if c != "text"]
        made = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*(b[c] for c in names), *made], [*names, "key", "length", "bands"])


def _shingled(batches: Iterable[pa.RecordBatch], how: Circulant) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [x.tobytes() for x in shingle_sets(b["text"].to_pylist(), how.size)]
        names = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(b[c] for c in names), pa.array(sets, pa.binary())], [*names, "shingles"])


def reaches(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of a and b elements with so many in common are linked: in whole numbers."""
    return 100 * common >= percent * (a + b - common)


def _meets(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of such sizes can be linked at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _against(batches: Iterable[pa.RecordBatch], how: Circulant) -> Iterator[pa.RecordBatch]:
    """Of groups whose first row is the star's middle, the links of the middle with the others."""
    for t in whole_groups(batches, ["middle", "part"], 512):
        starts = group_starts(t, ["middle", "part"])
        uid, middle, raw = t["uid"].to_numpy(), t["middle"].to_numpy(), t["shingles"].to_pylist()
        a, b = [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
            own = np.frombuffer(raw[s], np.uint64)
            if uid[s] != middle[s]:
                raise ValueError("a star without its middle")
            for i in range(s + 1, e):
                other = np.frombuffer(raw[i], np.uint64)
                at = np.searchsorted(own, other)
                common = int((own[np.minimum(at, len(own) - 1)] == other).sum())
                if reaches(common, len(own), len(other), how.percent):
                    a.append(middle[s])
                    b.append(uid[i])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _apart(batches: Iterable[pa.RecordBatch], how: Circulant) -> Iterator[pa.RecordBatch]:
    """Of pairs of blocks, links between different groups: of those that connect the same groups one each."""
    keys = ["bucket", "i", "j"]
    for t in whole_groups(batches, keys, 1024):
        starts = group_starts(t, keys)
        uid, root, side, size = t["uid"].to_numpy(), t["root"].to_numpy(), t["side"].to_numpy(), t["length"].to_numpy()
        same = t["i"].to_numpy() == t["j"].to_numpy()
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows], strict=True):
            a, b = np.triu_indices(e - s, 1)
            low, high = np.minimum(size[s + a], size[s + b]), np.maximum(size[s + a], size[s + b])
            ok = (root[s + a] != root[s + b]) & (100 * low >= how.percent * high) & (same[s] | (side[s + a] != side[s + b]))
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            sets = [np.frombuffer(x, np.uint64) for x in t["shingles"][s:e].to_pylist()]
            linked = reaches(commons(sets, a, b), size[s + a], size[s + b], how.percent)
            a, b = a[linked] + s, b[linked] + s
            pair = np.stack([np.minimum(root[a], root[b]), np.maximum(root[a], root[b])])
            _, first = np.unique(pair, axis=1, return_index=True)
            if len(first):
                yield pa.RecordBatch.from_arrays([pa.array(uid[a[first]]), pa.array(uid[b[first]])], ["a", "b"])


def circulant_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Circulant = Circulant()) -> DataFrame:  # noqa: B008
    """One row per row of docs: id, n_shingles, component_id (the smallest id of its component), first (whether it is the component's first
    row by id, one in each)."""
    spark = docs.sparkSession
    ship(spark)
    scan, file, row = located(docs)
    read = scan.select(scan[id_col].alias("id"), file.alias("file"), row.alias("row"), scan[text_col].cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, file string, row long, key binary, length long, bands array<long>"
    rows = stage(read.mapInArrow(lambda it: _sign(it, how), schema), "circulant-rows")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")
    classes = rows.where("length > 0").groupBy("key").agg(F.min(first).alias("first"), F.first("length").alias("length"), F.first("bands").alias("bands"))
    classes = stage(classes.withColumn("uid", F.monotonically_increasing_id()), "circulant-classes")

    # the buckets of two members or more, with their ends; written, so that a hot bucket's rows can be split where they meet them
    bands = classes.select("uid", "length", F.explode("bands").alias("band"))
    low, high = (F.min("uid").alias("low"), F.min_by("length", "uid").alias("low_length")), (F.max("uid").alias("high"), F.max_by("length", "uid").alias("high_length"))
    live = stage(bands.groupBy("band").agg(F.count("*").alias("n"), *low, *high).where("n > 1"), "circulant-live", 10_000)
    met = stage(bands.join(live, "band"), "circulant-met", 10_000)
    ends = [met.where(F.col("uid") != F.col(end)).where(_meets(F.col("length"), F.col(f"{end}_length"), how.percent)).select("uid", end) for end in ("low", "high")]
    pairs = ends[0].union(ends[1]).select(F.least("uid", "low").alias("a"), F.greatest("uid", "low").alias("b")).distinct()
    pairs = stage(pairs, "circulant-pairs", 10_000)

    # a pair is dealt to the end that has more of them, so that stars are few and large; a star's others are cut into parts
    place = classes.select("uid", "length", F.col("first.file").alias("f"), F.col("first.row").alias("r"))
    counts = pairs.select(F.explode(F.array("a", "b")).alias("uid")).groupBy("uid").agg(F.count("*").alias("n"))
    counts = stage(counts.join(place, "uid"), "circulant-counts", 10_000)
    degree = lambda c: counts.select(F.col("uid").alias(c), F.struct("n", "length", F.col("uid").alias("middle")).alias(f"of_{c}"))
    dealt = pairs.join(degree("a"), "a").join(degree("b"), "b").withColumn("of", F.greatest("of_a", "of_b"))
    parts = F.ceil(F.greatest(F.col("of.n") / how.star, F.col("of.n") * F.col("of.length") / how.block_shingles))
    dealt = dealt.select("of.middle", F.when(F.col("a") == F.col("of.middle"), F.col("b")).otherwise(F.col("a")).alias("uid"), parts.alias("parts"))
    dealt = stage(dealt.select("middle", "uid", F.pmod(F.xxhash64("uid"), "parts").cast("int").alias("part")), "circulant-dealt", 10_000)
    middles = dealt.select("middle", "part").distinct().select("middle", F.col("middle").alias("uid"), "part")
    sets = _sets(scan, text_col, counts, how)
    stars = dealt.unionByName(middles).join(sets.select("uid", "shingles"), "uid").withColumn("other", F.col("uid") != F.col("middle"))
    stars = stars.repartition(partitions(spark), "middle", "part").sortWithinPartitions("middle", "part", "other")
    linked = stage(stars.mapInArrow(lambda it: _against(it, how), "a long, b long"), "circulant-linked", SETS)
    groups = stage(components(linked), "circulant-groups")

    # what the ends have not connected: buckets whose other members are of several groups, once where several have the same members
    root = F.coalesce("root", "uid").alias("root")
    inner = met.where((F.col("n") > 3) & (F.col("uid") != F.col("low")) & (F.col("uid") != F.col("high"))).select("uid", "length", "band")
    inner = stage(inner.join(groups, F.col("uid") == F.col("node"), "left").select("uid", "length", "band", root), "circulant-inner")
    several = inner.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"), F.sum("length").alias("total"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y"))
    several = several.where("least <> most").groupBy("n", "total", "x", "y").agg(F.min("band").alias("band"))
    cut = F.greatest(F.ceil(F.col("n") / how.block), F.ceil(F.col("total") / how.block_shingles)).cast("int")
    several = stage(several.select("band", cut.alias("cut")), "circulant-several", 10_000)
    left = inner.join(several, "band").withColumn("side", F.pmod(F.xxhash64("uid"), F.col("cut")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    left = left.select("uid", "length", "root", F.col("band").alias("bucket"), F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side")
    blocks = left.join(sets.select("uid", "shingles"), "uid")
    blocks = blocks.repartition(partitions(spark), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    more = stage(blocks.mapInArrow(lambda it: _apart(it, how), "a long, b long"), "circulant-more", SETS)

    final = groups if more.isEmpty() else stage(components(linked.unionByName(more)), "circulant-components")
    known = classes.select("key", "uid", "first").join(final, F.col("uid") == F.col("node"), "left").select("key", "first", root)
    known = stage(known, "circulant-known")
    heads = stage(known.groupBy("root").agg(F.min("first").alias("head")), "circulant-heads")
    named = stage(known.join(heads, "root").select("key", "head"), "circulant-named")
    unstage(live, met, pairs, counts, dealt, sets, linked, groups, inner, several, more, final, known, heads, classes)
    out = rows.join(named, (rows["key"] == named["key"]) & (rows["length"] > 0), "left")
    alone = F.col("head").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("head.id"))
    return out.select("id", F.col("length").alias("n_shingles"), component.alias("component_id"), (alone | first.eqNullSafe(F.col("head"))).alias("first"))


def _sets(scan: DataFrame, text_col: str, places: DataFrame, how: Circulant) -> DataFrame:
    """The shingle sets of places (uid, f, r), a staged table: of known size, it is broadcast to the scan if it is small."""
    with settings(scan.sparkSession, FILTERS):
        met = texts_at(scan, text_col, places, "uid")
        return stage(met.mapInArrow(lambda it: _shingled(it, how), "uid long, shingles binary"), "circulant-sets", SETS)
