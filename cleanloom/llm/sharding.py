"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2**64 places; every shard has `nodes` virtual nodes on it. A row's key is the hash of its text, so equal texts are at one place,
and belongs to the first virtual node clockwise. Shards have room for exactly their share of the rows (counts differ by one at most);
a row that finds its shard full goes on clockwise to the next virtual node of a shard that has room.

Rows between two neighbouring nodes try the same shards in the same order, so how many of them each shard takes follows from the
counts per arc: shards * nodes numbers, whatever the size of the table. Those go to the driver, which walks the ring once; nodes of full
shards are skipped by links that shorten as they are followed. The rows themselves are range-sorted by ring place, then a hash of
the row. A row's rank, its place in its range and the rows of the ranges before it, says which stretch of the walk it is in: its shard and
its slot. Ranks go by place, so at each shard that fills at most one text is split.

A text with more rows than half a shard's room (there are less than twice as many as shards) cannot stay together in a ring of exact rooms without
moving the others: its rows have places of their own, by a hash of text and id. Rows change shards when the ring grows: those that the new
shard takes, and, because rooms are exact, those that overflow differently: from 8 to 9 shards 0.12 of all rows on uniform keys, 0.15 where one
text has a third of the rows and others a hundredth each, where 0.11 must (60,000 rows).

Defined results: null text has no bytes (size 1, CRC 0) and the key of an empty text; equal rows are placed one by one, null ids too;
other columns are not read; fewer rows than shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import numbered, partitions, stage, unstage

#: virtual nodes of a shard, rows that a range holds
NODES, ROWS = 256, 2_000_000


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(places, shards) of the virtual nodes, clockwise; a node keeps its place however many shards there are. Of nodes at
    one place, the later shard's come after the earlier's, and find no rows of their own."""
    digest = lambda s, k: hashlib.blake2b(f"{s}/{k}".encode(), digest_size=8).digest()
    places = np.frombuffer(b"".join(digest(s, k) for s in range(shards) for k in range(nodes)), ">u8").astype(np.uint64)
    order = np.argsort(places, kind="stable")
    return places[order], np.repeat(np.arange(shards), nodes)[order]


def arcs(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of the arc of each key: that of its first node clockwise; after the last node, one more than all (the first node's)."""
    return np.searchsorted(places, keys, side="left")


def walk(counts: np.ndarray, owners: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """counts: rows of each arc, the one after the last node too. (first rank, shard, slot of the first) of each stretch of ranks."""
    n = len(owners)
    base, more = divmod(int(counts.sum()), shards)
    room = [base + (s < more) for s in range(shards)]
    used, following = [0] * shards, list(range(1, n)) + [0]
    owner = owners.tolist()

    def open_from(at: int) -> int:
        """The first node from `at` on whose shard has room; the nodes passed point to it afterwards."""
        passed = []
        while used[owner[at]] == room[owner[at]]:
            passed.append(at)
            at = following[at]
        for p in passed:
            following[p] = at
        return at

    out, rank = [], 0
    for arc in np.flatnonzero(counts).tolist():
        at, left = arc % n, int(counts[arc])
        while left:
            at = open_from(at)
            shard = owner[at]
            take = min(left, room[shard] - used[shard])
            out.append((rank, shard, used[shard]))
            used[shard] += take
            rank, left = rank + take, left - take
    first, shard, slot = np.array(out, np.int64).reshape(-1, 3).T
    return first, shard, slot


def _count(batches: Iterable[pa.RecordBatch], places: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        arc, n = np.unique(arcs(b["place"].to_numpy().view(np.uint64), places), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(arc), pa.array(n)], ["arc", "n"])


def _place(batches: Iterable[pa.RecordBatch], before: np.ndarray, first: np.ndarray, shard: np.ndarray, slot: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = b["at"].to_numpy()
        rank = before[at >> 33] + (at & ((1 << 33) - 1))
        k = np.searchsorted(first, rank, side="right") - 1
        cols = [b["id"], b["size"], b["text_crc32"], pa.array(shard[k].astype(np.int32)), pa.array(slot[k] + rank - first[k])]
        yield pa.RecordBatch.from_arrays(cols, ["id", "size", "text_crc32", "shard", "slot"])


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES) -> DataFrame:
    """One row per row of docs: id, size (UTF-8 bytes and 1), text_crc32, shard, slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = F.xxhash64(text)
    rows = docs.select(docs[id_col].alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = stage(rows, "shard-rows", 10_000)
    n = rows.count()
    large = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") * 2 * shards > n).select(F.col("key").alias("large"))
    large = stage(large, "shard-large")  # less than 2 * shards rows
    own = F.xxhash64("key", "id")
    placed = rows.join(F.broadcast(large), rows["key"] == large["large"], "left").withColumn("place", F.when(F.col("large").isNull(), F.col("key")).otherwise(own)).drop("key", "large")
    clockwise = F.col("place").bitwiseXOR(F.lit(-(2**63)))  # signed numbers in the order of unsigned places
    ordered, before = numbered(placed, [clockwise, F.xxhash64("id", "text_crc32", "size"), "id"], partitions(spark, n, ROWS), "shard-order")
    unstage(rows, large)
    places, owners = ring(shards, nodes)
    counted = ordered.select("place").mapInArrow(lambda it: _count(it, places), "arc long, n long").groupBy("arc").agg(F.sum("n"))
    counts = np.zeros(len(places) + 1, np.int64)
    for arc, n in counted.collect():  # shards * nodes + 1 at most
        counts[arc] = n
    known = spark.sparkContext.broadcast((np.array(before), *walk(counts, owners, shards)))  # a number for each range, 3 for each arc and shard
    kind = docs.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(lambda it: _place(it, *known.value), f"id {kind}, size long, text_crc32 long, shard int, slot long")
