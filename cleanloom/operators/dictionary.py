"""Value mappings of any size: a dictionary of raw values and labels is a table, joined to the values.

A literal map in the plan serves some hundred entries; it is part of every task's code. A dictionary beyond that is written once, so that Spark knows its
size: it broadcasts a small one by its own limit, and shuffles a large one, where adaptive execution splits values that occur often. Null has no
entry and is dealt by a salt, so that nulls do not meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import SchemaError
from ..functions.strings import strip
from ..staging import new_path

#: entries up to which a mapping is a literal in the plan; rows that nulls are dealt to
LITERAL, SALTS = 1000, 997


def normalised(c: Column) -> Column:
    return F.lower(strip(c))


def entries(spark: SparkSession, mapping: Mapping[str, Iterable[str]]) -> DataFrame:
    """The dictionary of a configuration's mapping; of a raw value that several labels name, the last one's."""
    pairs = {str(raw).strip().lower(): str(label) for label, raws in mapping.items() for raw in raws or ()}
    return dictionary(spark.createDataFrame(list(pairs.items()), "raw string, label string"))


def dictionary(table: DataFrame, raw: str = "raw", label: str = "label") -> DataFrame:
    """table's entries, normalised, each raw value once, written to the shared folder. A raw value with two labels is a SchemaError."""
    spark, path = table.sparkSession, new_path(table.sparkSession, "dictionary")
    keyed = table.where(F.col(raw).isNotNull()).groupBy(normalised(F.col(raw)).alias("raw"))
    keyed.agg(F.min(label).alias("label"), F.max(label).alias("other"), F.count_if(F.col(label).isNull()).alias("none")).write.parquet(path)
    made = spark.read.parquet(path)
    odd = made.where("label <> other or (none > 0 and label is not null)").orderBy("raw").limit(3).collect()
    if odd:
        raise SchemaError(f"Raw values with several labels: {', '.join(r['raw'] for r in odd)}")
    return made.select("raw", "label")


def apply_dictionary(df: DataFrame, value: Column, made: DataFrame, out: str) -> DataFrame:
    """df with the column out: the label of each value; null for null and for what has no entry."""
    key = F.coalesce(normalised(value), F.concat(F.lit("\x00"), (F.monotonically_increasing_id() % SALTS).cast("string")))
    asked = made.select(F.col("raw").alias("__raw"), F.col("label").alias(out))
    keyed = df.withColumn("__value", key)
    return keyed.join(asked, keyed["__value"] == asked["__raw"], "left").drop("__value", "__raw")
