"""Helpers shared by the training-data operators: staging folder, staged tables, Arrow batches and grouping."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging
from ..shipping import ship
from ..staging import drop_path
from . import words

_SCRATCH: list[list[str]] = []
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: rows of whole texts in an Arrow batch, where a batch is made while a table is staged
TEXT_ROWS = 1000


@contextmanager
def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> Iterator[None]:
    """Arrow batches hold whole texts here, of any length: fewer rows in a batch bound what a task holds at once. The session's
    own setting is back at the end."""
    old = spark.conf.get(ARROW_ROWS, None)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(ARROW_ROWS) if old is None else spark.conf.set(ARROW_ROWS, old)


def new_path(spark: SparkSession, name: str) -> str:
    path = staging.new_path(spark, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def stage(df: DataFrame, name: str, rows: int = TEXT_ROWS) -> DataFrame:
    """Writes df as a Parquet table into the shared folder and rereads it: the lineage ends there,
    and a lost executor costs no recomputation beyond it."""
    spark = df.sparkSession
    ship(spark)
    path = new_path(spark, name)
    with text_batches(spark, rows):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Deletes staged tables that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_staged_at", None):
            drop_path(df.sparkSession, path)


def give_back() -> None:
    """The hashes of words that a worker remembers go, and its free memory goes back to the machine."""
    words._HASHES.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def tidy(function: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """function over a task's batches; a worker gives its memory back at the task's end. Workers wait for further tasks, in turn and
    more of them than there are cores, and would keep what the largest task has needed."""

    @wraps(function)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        yield from function(*args, **options)
        give_back()  # what function held is gone here

    return run


def pieces(batches: Iterable[pa.RecordBatch], rows: int = TEXT_ROWS) -> Iterator[pa.RecordBatch]:
    """batches in slices of `rows` rows at most: for whole texts, where whoever writes the result sets the size of batches."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def forget(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a step when the driver's JVM has collected what referred to them, which by itself waits for its heap to
    fill. The driver is asked to collect here, where a step is written; executors are left alone."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end: for whoever has written what comes of them (to a path made before)."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            drop_path(spark, path)


def staged(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """make() as a staged table; all that it stages itself goes once that is written."""
    path = new_path(spark, name)
    with scratch(spark):
        df = make()
        with text_batches(spark):
            df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def numbered(df: DataFrame, keys: list, n: int, name: str) -> tuple[DataFrame, list[int]]:
    """df in the order of keys as a staged table, in n ranges, with column at: range << 33 | place in the range; and the
    number of rows before each range. Keys must tell hot values' rows apart, so that ranges can cut between them."""
    out = stage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), name, 10_000)
    sizes = dict(out.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*")).collect())  # a number for each range
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    return out, [*before, total]


def partitions(spark: SparkSession, amount: int = 0, each: int = 1) -> int:
    """The cluster's shuffle partitions, or more where `amount` would put over `each` into one."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each))


def listed(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A table of a few values that the driver has. Out of a list of rows Spark would make one that Python workers read: a daemon and workers of
    their own on each executor, which stay there beside those of Arrow functions. Out of an Arrow table it makes one of the JVM's."""
    return spark.createDataFrame(pa.table(columns), schema)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores in front until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 20_000, most: int = 64 << 20) -> Iterator[pa.Table]:
    """From batches sorted by keys, tables of about `rows` rows, or `most` bytes, that hold each group whole."""
    kept: list[pa.Table] = []
    n = held = 0
    for b in batches:
        if not b.num_rows:
            continue
        kept.append(pa.Table.from_batches([b]))
        n, held = n + b.num_rows, held + b.nbytes
        if n < rows and held < most:
            continue
        t = pa.concat_tables(kept).combine_chunks()
        start = int(group_starts(t, keys)[-1])
        if start:
            yield t.slice(0, start)
        kept = [t.slice(start)]
        n, held = kept[0].num_rows, kept[0].nbytes
    if n:
        yield pa.concat_tables(kept).combine_chunks()


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a new group begins in a table sorted by keys."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for k in keys:
        v = t[k].to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)
