"""All rows of an issue, as runs of consecutive row numbers.

Rows are cut into blocks of consecutive numbers, and runs are found block by block, so a rule that half of a table breaks is spread over as many
groups as the table has blocks, none of more rows than a block has numbers. Runs that touch a block's edge, two a block at most, are then stitched
to those of the next block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("table", "column", "rule", "severity")
BLOCK = 1 << 16


def row_runs(issues: DataFrame, keys: Sequence[str] = KEYS, row: str = "row", block: int = BLOCK) -> DataFrame:
    """keys, first, last: each maximal run of consecutive rows. Rows that occur several times under one key count once. What has no row (a column
    that is missing) is a run of its own, without numbers."""
    at = F.floor(F.col(row) / block)
    found = issues.where(F.col(row).isNotNull()).select(*keys, F.col(row).cast("long").alias("__row"), at.alias("__block"))
    # rows less their rank stay the same as long as they follow each other; the rank of equal rows is the same
    rank = F.dense_rank().over(Window.partitionBy(*keys, "__block").orderBy("__row"))
    runs = found.withColumn("__island", F.col("__row") - rank).groupBy(*keys, "__block", "__island").agg(F.min("__row").alias("first"), F.max("__row").alias("last"))
    runs = runs.select(*keys, "first", "last")
    edge = (F.pmod("first", F.lit(block)) == 0) | (F.pmod("last", F.lit(block)) == block - 1)
    by_first = Window.partitionBy(*keys).orderBy("first")
    new = F.coalesce(F.col("first") != F.lag("last").over(by_first) + 1, F.lit(True)).cast("int")
    stitched = runs.where(edge).withColumn("__new", new).withColumn("__run", F.sum("__new").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
    stitched = stitched.groupBy(*keys, "__run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("__run")
    none = issues.where(F.col(row).isNull()).select(*keys, F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last")).distinct()
    return runs.where(~edge).unionByName(stitched).unionByName(none)


def run_lists(runs: DataFrame, keys: Sequence[str] = KEYS, span: int = BLOCK) -> DataFrame:
    """keys, chunk, n, rows: the runs in order as text (`3-17, 20`), in chunks of those that begin within `span` row numbers: chunk is the first of these
    numbers. However many rows an issue has, a line holds no more than half of span runs."""
    one = F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", "first", "last"))
    cut = runs.where(F.col("first").isNotNull()).select(*keys, (F.floor(F.col("first") / span) * span).alias("chunk"), F.struct("first", one.alias("text")).alias("run"), (F.col("last") - F.col("first") + 1).alias("rows"))
    lists = cut.groupBy(*keys, "chunk").agg(F.sum("rows").alias("n"), F.sort_array(F.collect_list("run")).alias("runs"))
    return lists.select(*keys, "chunk", "n", F.array_join(F.transform("runs", lambda r: r["text"]), ", ").alias("rows"))


def first_rows(runs: DataFrame, keys: Sequence[str] = KEYS, most: int = 20) -> DataFrame:
    """keys, first_rows: the first `most` rows of each key, a view of its runs. Tasks hand on `most` runs of a key at most."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("first").asc_nulls_last()))
    few = runs.withColumn("__rank", rank).where(F.col("__rank") <= most)
    rows = F.when(F.col("first").isNotNull(), F.sequence("first", F.least(F.col("last"), F.col("first") + most - 1))).otherwise(F.array().cast("array<bigint>"))
    return few.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list(rows))), 1, most).alias("first_rows"))
