"""Best-fit packing with certified bounds.

Documents become pieces of at most `capacity` tokens. Pieces are dealt to partitions of about `PIECES`, whatever the size of the
table; each is packed by best-fit decreasing. Dual-feasible functions bound from below how many sequences the pieces of
a partition need at least: a partition that meets its bound and wastes less than a quarter of a sequence is certified and
done. One with a gap gives its emptiest sequences, of `PIECES` pieces together at most, to an exchange, where those of `FAN_IN`
partitions meet and are packed again; a worse packing is never taken. So no task ever holds more than FAN_IN * PIECES pieces, however
lengths are distributed, and each round has a sixteenth of the last one's groups. Rounds go on until no gap is left, all groups
have met, or `ROUNDS` are over. What a group does not hand on stays where it is, certified or not: column gap says how
many sequences more than its lower bound the group had that packed a piece last, and `certificate` bounds the whole table.

Only (piece, length) rows move; texts never do.

Defined results: null text counts as empty (one piece that holds only the end id); rows with the same id are packed one by
one; ties of length go by the order in the group; columns of other names pass through `pack`, but uid, part, loose, gap,
sequence_id and offset are its own; a piece longer than the capacity is an error; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..shipping import ship
from .common import stage, unstage
from .tokens import encoded, remembering

#: pieces in a partition and given up by one at most, partitions that meet in an exchange, sequences given up beside those that
#: a gap costs, rounds of exchange at most
PIECES, FAN_IN, SPARE, ROUNDS = 4096, 16, 64, 8
#: bits of a sequence's id for its place in its group and for its group
BIN_BITS, PART_BITS = 20, 36


@remembering
def _cut(batches: Iterable[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end = end_id.to_bytes(4, "little")
    for b in batches:
        rows: list[tuple] = []
        for at, ids in enumerate(encoded(b["text"].to_pylist(), path, True)):
            ids += end
            rows += ((at, k, s // 4, len(part := ids[s : s + 4 * capacity]) // 4, zlib.crc32(part)) for k, s in enumerate(range(0, len(ids), 4 * capacity)))
        at, *cols = zip(*rows, strict=True) if rows else [()] * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([b["id"].take(pa.array(at, pa.int64())), *map(pa.array, cols, kinds)], ["id", "piece", "start", "length", "ids_crc32"])


def cut(docs: DataFrame, path: str, capacity: int, id_col: str, text_col: str, end_id: int = 0) -> DataFrame:
    """The pieces of every document: id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return read.mapInArrow(lambda it: _cut(it, path, capacity, end_id), f"id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    return _bound(np.bincount(lengths, minlength=capacity + 1).astype(np.int64))


def _bound(count: np.ndarray) -> int:
    """No packing of count[n] pieces of each length n has fewer bins: the largest bound by three families of dual-feasible functions."""
    if not count.any():
        return 0
    capacity = len(count) - 1
    size = np.arange(capacity + 1)
    best = -(-int(count @ size) // capacity)
    n_from, sum_from = count[::-1].cumsum()[::-1], (count * size)[::-1].cumsum()[::-1]  # of sizes x and more
    cut_at = np.arange(1, capacity // 2 + 1)  # small sizes count 0, those over capacity less that count as whole bins
    large = n_from[capacity - cut_at + 1]
    middle = sum_from[cut_at] - sum_from[capacity - cut_at + 1]
    best = max(best, int((large + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 33):  # rounding to k-ths
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        value = np.where(whole, size * k, scaled // capacity * capacity)
        best = max(best, -(-int(count @ value) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each item, its offset there, free space of each bin)"""
    order = np.argsort(-lengths, kind="stable")
    bins, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[int] = []
    with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0  # bit s is set when a bin has s free
    for at, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        if fits := spaces >> n:
            s = n + (fits & -fits).bit_length() - 1
            b = with_space[s].pop()
            if not with_space[s]:
                spaces ^= 1 << s
        else:
            b, s = len(free), capacity
            free.append(capacity)
        bins[at], offset[at], free[b] = b, capacity - s, s - n
        with_space[s - n].append(b)
        spaces |= 1 << (s - n)
    return bins, offset, np.array(free, np.int64)


def _loose(lengths: np.ndarray, bins: np.ndarray, free: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(which sequences a group gives to an exchange: the emptiest, of PIECES pieces at most; its gap)"""
    gap = len(free) - lower_bound(lengths, capacity)
    loose = np.zeros(len(free), bool)
    if gap > 0 or 4 * free.sum() >= capacity:
        emptiest = np.argsort(-free, kind="stable")[: (SPARE + 1) * gap + SPARE]
        loose[emptiest[np.bincount(bins, minlength=len(free))[emptiest].cumsum() <= PIECES]] = True
    return loose & (free > 0), gap


def _pack(group: pd.DataFrame, step: int, capacity: int) -> pd.DataFrame:
    """Packs the pieces of a partition; those to exchange have loose set. From step 1 on they come with a packing."""
    lengths = group["length"].to_numpy()
    if lengths.max() > capacity:
        raise ValueError(f"a piece is longer than a sequence of {capacity}")
    bins, offset, free = best_fit_decreasing(lengths, capacity)
    old, old_bin = np.unique(group["sequence_id"].to_numpy(), return_inverse=True) if step else (None, None)
    if step and len(old) <= len(free):
        free = capacity - np.bincount(old_bin, weights=lengths).astype(np.int64)
        bins = old_bin
    else:
        part = int(group["part"].iloc[0])
        if len(free) >> BIN_BITS or part >> PART_BITS:
            raise ValueError("more sequences or groups than their ids have room for")
        base = (step << (BIN_BITS + PART_BITS)) + (part << BIN_BITS)
        group = group.assign(sequence_id=base + bins, offset=offset)
    loose, gap = _loose(lengths, bins, free, capacity)
    return group.assign(loose=loose[bins], gap=gap)


def packer(step: int, capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda group: _pack(group, step, capacity)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """pieces (any columns, with length) with sequence_id, offset: their place; and gap: that of the group that packed them."""
    spark = pieces.sparkSession
    rows = stage(pieces.withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    parts = max(1, -(-rows.count() // PIECES))
    todo = rows.select("*", F.pmod(F.xxhash64("uid"), F.lit(parts)).alias("part"), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    kind = StructType([*todo.schema, StructField("loose", BooleanType()), StructField("gap", LongType())])
    done = []
    for step in range(ROUNDS + 1):
        packed = stage(todo.groupBy("part").applyInPandas(packer(step, capacity), kind), f"pack-{step}")
        if parts == 1 or step == ROUNDS or packed.where("loose").isEmpty():
            done.append(packed)
            break
        done.append(packed.where("not loose"))
        parts = -(-parts // FAN_IN)
        todo = packed.where("loose").drop("loose", "gap").withColumn("part", (F.col("part") / FAN_IN).cast("long"))
    unstage(rows)
    return reduce(DataFrame.union, done).drop("uid", "part", "loose")


def certificate(packed: DataFrame, capacity: int = 2048) -> tuple[int, int]:
    """(sequences of a packing, sequences that any packing of the whole table needs): the bound sees the count of each length."""
    used = packed.agg(F.count_distinct("sequence_id")).first()[0]
    lengths = packed.groupBy("length").agg(F.count("*")).collect()  # capacity rows at most
    count = np.zeros(capacity + 1, np.int64)
    for n, c in lengths:
        count[n] = c
    return used, _bound(count)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(cut(docs, path, capacity, id_col, text_col), capacity)
