"""Checks that need more than one row: unique keys and foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import blank


def mark_duplicates(df: DataFrame, key: str, mark: str) -> DataFrame:
    """df with a column mark: whether the key's text occurs more than once. Null is never a duplicate.

    Counts are partial before the shuffle, and only keys that repeat are joined back: a key in many rows is the large side of
    a join whose other side has it once. They move once more, when all are counted: only then does Spark know how few they are. It broadcasts them, where it
    would take as many as there are keys for granted, and sort whole rows to meet them."""
    again = df.where(df[key].isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__n")).where("__n > 1").select("__key").repartition(F.xxhash64("__key"))
    return df.join(again, df[key] == again["__key"], "left").withColumn(mark, F.col("__key").isNotNull()).drop("__key")


def mark_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, mark: str, allow_null: bool = True) -> DataFrame:
    """child with a column mark: whether its key is no key of parent. Null and blank pass if they are allowed; they take no part in the
    join, where they would all meet in one task."""
    known = parent.select(F.col(parent_key).alias("__parent")).where("__parent is not null").distinct()
    kind = dict(known.dtypes)["__parent"]
    own = child[key] if dict(child.dtypes)[key] == kind else child[key].cast(kind)
    missing = F.coalesce(blank(child[key].cast("string")), F.lit(True))
    asked = child.where(~missing)
    joined = asked.join(known, own == known["__parent"], "left").withColumn(mark, F.col("__parent").isNull()).drop("__parent")
    return joined.unionByName(child.where(missing).withColumn(mark, F.lit(not allow_null)))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, allow_null: bool = True) -> DataFrame:
    """The rows of child whose key parent does not have."""
    if allow_null:
        child = child.where(child[key].isNotNull() & ~blank(child[key].cast("string")))
    known = parent.select(F.col(parent_key).alias("__parent")).where("__parent is not null")
    return child.join(known, child[key] == known["__parent"], "left_anti")
