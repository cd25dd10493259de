"""Keys of a parent table, kept for the deliveries of its children.

The keys are a table of their own, once each, in buckets by the key and sorted within: a child's delivery moves its own distinct keys to these buckets and
meets them there, and the parent never moves again. Of a child only the keys travel, each once a task, so one in many rows weighs no more than others; the rows
stay where they are and are told by the keys that have no parent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import blank
from ..staging import new_path

KEY = "key"


@dataclass(frozen=True)
class KeptKeys:
    table: str
    buckets: int
    kind: str

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


def keep_keys(parent: DataFrame, key: str, table: str, buckets: int = 200, path: str | None = None) -> KeptKeys:
    """The distinct keys of parent as the table `table` (at path, or where the catalog keeps its tables), made anew. Null is no key."""
    keys = parent.select(F.col(key).alias(KEY)).where(F.col(KEY).isNotNull()).distinct()
    writer = keys.repartition(buckets, KEY).sortWithinPartitions(KEY).write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return KeptKeys(table, buckets, dict(parent.dtypes)[key])


def add_keys(parent: DataFrame, key: str, kept: KeptKeys) -> None:
    """A further delivery of the parent: keys that are not there yet are added, to the same buckets."""
    new = _distinct(parent.where(F.col(key).isNotNull()), key, kept)
    new = new.join(kept.frame(parent.sparkSession), KEY, "left_anti").sortWithinPartitions(KEY)
    path = new_path(parent.sparkSession, "new-keys")  # a table cannot be read and added to at once
    new.write.parquet(path)
    added = parent.sparkSession.read.schema(new.schema).parquet(path)
    added.repartition(kept.buckets, KEY).sortWithinPartitions(KEY).write.mode("append").bucketBy(kept.buckets, KEY).sortBy(KEY).format("parquet").saveAsTable(kept.table)


def _distinct(df: DataFrame, key: str, kept: KeptKeys) -> DataFrame:
    """The keys of df, once each, in the buckets of the kept ones; partial results come before they move."""
    return df.groupBy(F.col(key).cast(kept.kind).alias(KEY)).count().select(KEY).repartition(kept.buckets, KEY)


def missing_keys(child: DataFrame, key: str, kept: KeptKeys) -> DataFrame:
    """key: the keys of child that are not kept, once each; not null or blank ones. Only child's keys move."""
    asked = child.where(~F.coalesce(blank(child[key].cast("string")), F.lit(True)))
    return _distinct(asked, key, kept).join(kept.frame(child.sparkSession).hint("merge"), KEY, "left_anti")


def mark_missing(child: DataFrame, key: str, kept: KeptKeys, mark: str, allow_null: bool = True) -> DataFrame:
    """child with a column mark: whether its key is no kept key. What is missing is written first, so that Spark knows its size: it is broadcast to the rows
    where it is small."""
    spark, path = child.sparkSession, new_path(child.sparkSession, "missing-keys")
    missing = missing_keys(child, key, kept)
    missing.write.parquet(path)
    gone = spark.read.schema(missing.schema).parquet(path).select(F.col(KEY).alias("__missing"))
    out = child.join(gone, child[key].cast(kept.kind) == gone["__missing"], "left")
    none = F.coalesce(blank(child[key].cast("string")), F.lit(True))
    return out.withColumn(mark, F.when(none, F.lit(not allow_null)).otherwise(F.col("__missing").isNotNull())).drop("__missing")
