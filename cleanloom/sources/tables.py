"""Tables of text cells with an ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ExtractorError
from ..plans.table import ROW
from ..staging import new_path


def with_ordinal(df: DataFrame, order: list[str] | None = None, name: str = ROW) -> DataFrame:
    """Gapless ordinals from 0: by the order of the scan, or by the columns given.

    No row moves for the scan's order: partitions count their rows in a first pass, and the counts (one number per partition)
    say where each partition starts. An order by columns sorts by range first, so no task holds all rows; the sorted rows are
    written to the shared folder, so that both passes, and a task that is run again, see the same ranges."""
    if order:
        spark = df.sparkSession
        n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_path(spark, "ordered")
        placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("__id"))
        placed.write.parquet(path)
        placed = spark.read.schema(placed.schema).parquet(path)
        marked = placed.select(*df.columns, F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
        return _numbered(marked, name)
    marked = df.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return _numbered(marked, name)


def _numbered(marked: DataFrame, name: str) -> DataFrame:
    counts = marked.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("__part").alias("__p"), before.alias("__start"))
    return marked.join(F.broadcast(starts), F.col("__part") == F.col("__p")).withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__p", "__start", "__n")


def as_text(df: DataFrame, keep: str = ROW) -> DataFrame:
    return df.select(*(df[c] if c == keep else df[c].cast("string").alias(c) for c in df.columns))


def read_csv(spark: SparkSession, path: str, header_row: int = 1, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """All cells as text. header_row 0: no header, columns are named 0, 1, ... multi_line: cells may hold line breaks within quotes; then a file is
    read by one task, otherwise in as many parts as it is long."""
    if header_row not in (0, 1):
        raise ExtractorError("CSV files have their header in the first row or none")
    df = spark.read.option("header", header_row == 1).option("inferSchema", False).option("sep", sep).option("multiLine", multi_line).option("escape", '"').csv(path)
    if not header_row:
        df = df.toDF(*map(str, range(len(df.columns))))
    return with_ordinal(df)


def read_parquet(spark: SparkSession, path: str, order: list[str] | None = None) -> DataFrame:
    return as_text(with_ordinal(spark.read.parquet(path), order))
