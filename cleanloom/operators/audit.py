"""Changes between columns, and counts of nulls."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("LOADED", "CLEANED", "TRANSFORMED", "VALIDATED")


def as_text(c: Column, kind: str) -> Column:
    """A value as it is compared and shown: whole numbers without a fraction, midnights as dates."""
    if kind == "double":
        return F.when((F.abs(c) < 1e15) & (c == F.floor(c)), c.try_cast("bigint").cast("string")).otherwise(c.cast("string"))
    if kind == "timestamp_ntz":
        return F.regexp_replace(c.cast("string"), " 00:00:00$", "")
    if kind == "binary":
        return F.hex(c)
    return c.cast("string")


def changes(df: DataFrame, pairs: Mapping[str, tuple[str, str]], row: Column, *, numeric: bool = True) -> DataFrame:
    """pairs: name -> (old column, new column). One row for each value that differs: column, row, old, new. Numbers are
    compared as numbers; null against a value counts as a change."""
    kinds = dict(df.dtypes)
    found = []
    for name, (old, new) in pairs.items():
        before, after = as_text(F.col(old), kinds[old]), as_text(F.col(new), kinds[new])
        differs = ~before.eqNullSafe(after)
        if numeric and kinds[new] in ("bigint", "double") and kinds[old] == "string":
            differs = differs & ~F.trim(F.col(old)).try_cast("double").eqNullSafe(F.col(new).cast("double")) | F.col(old).isNotNull() & F.col(new).isNull()
        found.append(F.when(differs, F.struct(F.lit(name).alias("column"), row.alias("row"), before.alias("old"), after.alias("new"))))
    return df.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("c")).select("c.*")


def null_counts(df: DataFrame, stages: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """stages: stage -> column name -> value. One pass over df gives one row per stage and column: col_name, stage, nulls."""
    asked = [(s, c, v) for s, cols in stages.items() for c, v in cols.items()]
    counts = df.agg(*(F.count_if(v.isNull()).alias(f"n{k}") for k, (_, _, v) in enumerate(asked)))
    rows = F.array(*(F.struct(F.lit(c).alias("col_name"), F.lit(s).alias("stage"), F.col(f"n{k}").alias("nulls")) for k, (s, c, _) in enumerate(asked)))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def null_pivot(stats: DataFrame) -> DataFrame:
    """A row per column, a column per stage."""
    return stats.groupBy("col_name").pivot("stage", list(STAGES)).sum("nulls")
