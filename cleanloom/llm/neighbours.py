"""Nearest neighbours by cosine: a block matrix join over int8 tiles.

Vectors are scaled to length 1 and rounded to int8 with a scale of their own, and what that leaves off is rounded to int16; the length of what
each layer leaves off bounds the error. Queries and candidates are cut into blocks of bounded size, one task per pair of blocks; only codes
and four numbers a vector are copied to the tiles, a candidate's once for each QUERIES queries. In a tile, the integer product of the first layer gives an interval for
each cosine, for a stripe of queries at a time; pairs whose interval reaches the k-th best lower bound are bounded again by both layers, now from the length of their
difference, which is the more exact the nearer they are; those leave the tile that still reach it: few of a cluster of near copies, too, all of whose products look alike. A heap of the k best lower bounds over a query's tiles then drops what cannot be
among its k nearest any more; the original vectors are joined to the few pairs left, and these are computed anew in double precision.
The result is exact: no pair is left out that could be among the k nearest.

Rows are told apart by a number of their own (uid), never by their id. Of equal vectors (compared as a whole) the k + 1 of the smallest ids
are candidates for all: no query's k nearest can hold another, so a vector that a third of all rows share fills no tile and no heap.
They all ask their own questions.

In numpy the product of int8 tiles runs in float32, which holds its integers exactly up to 1040 dimensions (float64 beyond), as only that
uses the machine's matrix product; the tile's codes are widened in the task.

Defined results: vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor do null ids; vectors are
compared with those of their own dimension; ties go to the smaller id, of equal ids to either row; rows with the same id have their
own neighbours each, and one may be the other's; with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import group_starts, partitions, stage, unstage, whole_groups

QUERIES, CANDIDATES = 8192, 16384
#: queries of a tile that are multiplied together, pairs that are bounded again together
STRIPE, PAIRS = 256, 1 << 16
#: more than a cosine in double precision is off
ROUNDING = 1e-12
CODES = ("dim", "code", "scale", "slack", "code2", "scale2", "slack2")
KIND = "uid long, id long, vector array<double>, dim int, code binary, scale double, slack double, code2 binary, scale2 double, slack2 double"
PAIR = "q long, c long, low double, high double"


def _round(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for v in b["vector"].to_numpy(zero_copy_only=False):
            v = np.asarray(v, np.float64)
            unit = v / np.abs(v).max()
            unit /= np.sqrt((unit * unit).sum())
            scale = np.abs(unit).max() / 127
            code = np.rint(unit / scale).astype(np.int8)
            left = unit - scale * code
            scale2 = max(np.abs(left).max() / 32767, 1e-300)
            code2 = np.rint(left / scale2).astype("<i2")
            left2 = left - scale2 * code2
            length = lambda x: float(np.sqrt((x * x).sum()))
            rows.append((len(v), code.tobytes(), scale, length(left) + 1e-9, code2.tobytes(), scale2, length(left2) + 1e-12))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.binary(), pa.float64(), pa.float64())
        made = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([b["uid"], b["id"], b["vector"], *made], [x.split()[0] for x in KIND.split(", ")])


def rounded(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    ship(vectors.sparkSession)
    v = F.col("vector")
    read = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    read = read.where(v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull())
    return read.select(F.monotonically_increasing_id().alias("uid"), "id", "vector").mapInArrow(_round, KIND)


def _codes(p: pd.DataFrame, kind: type, layer: str = "code", of: str = "i1") -> np.ndarray:
    return np.frombuffer(b"".join(p[layer]), of).reshape(len(p), -1).astype(kind)


def _both(p: pd.DataFrame) -> np.ndarray:
    """What the two layers of codes stand for."""
    return _codes(p, np.float64) * p["scale"].to_numpy()[:, None] + _codes(p, np.float64, "code2", "<i2") * p["scale2"].to_numpy()[:, None]


def _tile(q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    """(q, c, low, high) of the pairs that may be among the k nearest of the tile's candidates."""
    if not len(q) or not len(c):
        return pd.DataFrame({"q": np.zeros(0, np.int64), "c": np.zeros(0, np.int64), "low": np.zeros(0), "high": np.zeros(0)})
    kind = np.float32 if q["dim"].iloc[0] <= 1040 else np.float64
    codes, scale, slack = _codes(c, kind), c["scale"].to_numpy(), c["slack"].to_numpy()
    full_q, full_c, slack_q, slack_c = _both(q), _both(c), q["slack2"].to_numpy(), c["slack2"].to_numpy()
    own, ids, found = q["uid"].to_numpy(), c["uid"].to_numpy(), []
    for s in range(0, len(q), STRIPE):
        part = q.iloc[s : s + STRIPE]
        near = (_codes(part, kind) @ codes.T).astype(np.float64) * (part["scale"].to_numpy()[:, None] * scale[None, :])
        qs = part["slack"].to_numpy()[:, None]
        off = qs + (1 + qs) * slack[None, :]
        low, high = near - off, near + off
        itself = own[s : s + STRIPE, None] == ids[None, :]
        low[itself] = -np.inf
        reach = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(part), -np.inf)
        at, to = np.nonzero((high >= reach[:, None]) & ~itself)
        at += s
        low, high = np.empty(len(at)), np.empty(len(at))
        for p in range(0, len(at), PAIRS):
            x, y = at[p : p + PAIRS], to[p : p + PAIRS]
            apart = full_q[x] - full_c[y]
            length, off = np.sqrt(np.einsum("ij,ij->i", apart, apart)), slack_q[x] + slack_c[y]
            low[p : p + PAIRS] = 1 - (length + off) ** 2 / 2 - ROUNDING  # the cosine is 1 less half the square of the distance
            high[p : p + PAIRS] = 1 - np.maximum(length - off, 0) ** 2 / 2 + ROUNDING
        stay = np.zeros(len(at), bool)
        cuts = np.searchsorted(at, np.arange(s, s + len(part) + 1))
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            best = np.partition(low[lo:hi], hi - lo - k)[hi - lo - k] if hi - lo > k else -np.inf
            stay[lo:hi] = high[lo:hi] >= best
        found.append((own[at[stay]], ids[to[stay]], low[stay], high[stay]))
    return pd.DataFrame(dict(zip(("q", "c", "low", "high"), map(np.concatenate, zip(*found, strict=True)), strict=True)))


def tiler(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    return lambda q, c: _tile(q, c, k)


def _meet(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of each query's pairs of all tiles, those that reach the k-th best lower bound of all."""
    for t in whole_groups(batches, ["q"], 65_536):
        low, high = t["low"].to_numpy(), t["high"].to_numpy()
        stay = np.zeros(t.num_rows, bool)
        starts = group_starts(t, ["q"])
        for s, e in zip(starts, [*starts[1:], t.num_rows], strict=True):
            best = heapq.nlargest(k, low[s:e])
            stay[s:e] = high[s:e] >= (best[-1] if len(best) == k else -np.inf)
        yield pa.RecordBatch.from_arrays([t[c].combine_chunks().filter(pa.array(stay)) for c in ("q", "c")], ["q", "c"])


def _exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        score = []
        for q, c in zip(b["q_vector"].to_numpy(zero_copy_only=False), b["c_vector"].to_numpy(zero_copy_only=False), strict=True):
            score.append(float((q * c).sum() / (np.sqrt((q * q).sum()) * np.sqrt((c * c).sum()))))
        yield pa.RecordBatch.from_arrays([b["q"], b["query_id"], b["vec_id"], b["c"], pa.array(score, pa.float64())], ["q", "query_id", "vec_id", "c", "score"])


def _candidates(rows: DataFrame, k: int) -> DataFrame:
    """rows without those of which k + 1 equal vectors have smaller ids. Hashes only say whose vectors are compared."""
    mark = F.xxhash64("vector")
    common = stage(rows.groupBy(mark.alias("mark")).agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("mark"), "near-common")
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id", "uid"))
    marked = rows.select("uid", "id", "vector").withColumn("mark", mark).join(common, "mark", "left_semi")
    more = marked.withColumn("rank", rank)
    few = more.where(F.col("rank") <= k + 1).select("uid")  # cut before the shuffle too, for the ranks are limited
    plain = rows.withColumn("mark", mark).join(common, "mark", "left_anti").drop("mark")
    return plain.select("uid", *CODES).unionByName(rows.join(few, "uid").select("uid", *CODES))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of all other rows, for each row where is_query holds (over column id)."""
    spark = vectors.sparkSession
    rows = stage(rounded(vectors, id_col, vector_col), "near-rows")
    asked, light = rows.where(is_query), stage(_candidates(rows, k), "near-candidates", 10_000)
    n, m = light.count(), asked.count()
    left, right = max(1, -(-m // QUERIES)), max(1, -(-n // CANDIDATES))
    block = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    q = asked.select("uid", *CODES).withColumn("i", block(left)).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(right - 1))))
    c = light.withColumn("j", block(right)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(left - 1))))
    keys = ["dim", "i", "j"]
    tiles = stage(q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(tiler(k), PAIR), "near-tiles")
    pairs = tiles.repartition(partitions(spark), "q").sortWithinPartitions("q").mapInArrow(lambda it: _meet(it, k), "q long, c long")
    pairs = stage(pairs, "near-pairs", 10_000)
    unstage(light, tiles)
    whole = lambda side, name: rows.select(F.col("uid").alias(side), F.col("id").alias(name), F.col("vector").alias(f"{side}_vector"))
    scored = pairs.join(whole("c", "vec_id"), "c").join(whole("q", "query_id"), "q").mapInArrow(_exact, "q long, query_id long, vec_id long, c long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id", "c"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
