"""Where results go: CSV, Parquet, workbooks and databases."""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager, nullcontext
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ColumnConfig, Config
from ..errors import LoaderError
from ..staging import drop_path, new_path
from .database import load_table
from .spreadsheet import write_workbook

log = logging.getLogger(__name__)


def _printable(df: DataFrame) -> DataFrame:
    """Whole doubles without a fraction, midnights as dates, bytes as hex."""
    from ..operators.audit import as_text

    kinds = dict(df.dtypes)
    return df.select(*(as_text(F.col(f"`{c}`"), kinds[c]).alias(c) if kinds[c] in ("double", "timestamp_ntz", "binary") else F.col(f"`{c}`") for c in df.columns))


def write_csv(tables: Mapping[str, DataFrame], folder: str, *, one_file: bool = False) -> list[str]:
    """A folder per table, with header; a table that fails is logged and left out. Gives the tables written.
    one_file: in one part, for small tables."""
    done = []
    for name, df in tables.items():
        try:
            out = _printable(df)
            (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/{name}")
            done.append(name)
        except Exception as e:  # noqa: BLE001  one table's failure does not keep the others
            log.error("Table %s was not written: %s", name, str(e).splitlines()[0])
    return done


def write_parquet(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def cleaned_name(path: str) -> str:
    stem, suffix = os.path.splitext(os.path.basename(path))
    return f"{stem}_cleaned{suffix}"


def write_excel(tables: Mapping[str, DataFrame], folder: str, source_file: str) -> str:
    path = f"{folder.rstrip('/')}/{cleaned_name(source_file)}"
    write_workbook({k: _printable(df) for k, df in tables.items()}, path)
    return path


def ddl(table: str, columns: Mapping[str, ColumnConfig], schema: str = "dbo") -> str:
    """CREATE TABLE of the declared types and keys."""
    quote = lambda x: "[" + x.replace("]", "]]") + "]"
    lines = [f"{quote(c.name)} {c.type.name}{f'({c.type.length})' if c.type.length else ''} {'NOT NULL' if c.must_have_value else 'NULL'}" for c in columns.values()]
    if keys := [quote(c.name) for c in columns.values() if c.primary_key]:
        lines.append(f"PRIMARY KEY ({', '.join(keys)})")
    lines += [f"FOREIGN KEY ({quote(c.name)}) REFERENCES {quote(schema)}.{quote(c.foreign_key[0])} ({quote(c.foreign_key[1])})" for c in columns.values() if c.foreign_key]
    return f"CREATE TABLE {quote(schema)}.{quote(table)} (\n  " + ",\n  ".join(lines) + "\n)"


def write_jdbc(tables: Mapping[str, DataFrame], config: Config, url: str, properties: Mapping[str, str] | None = None, run: str | None = None) -> dict[str, int]:
    """Appends (or as if_exists says) to the target's tables, each row once however often tasks run; rows by table. run names the delivery (without one,
    every call is a delivery of its own): a delivery that is in the database is not loaded again. The driver class comes with the cluster."""
    mode, run = str(config.target.get("if_exists", "append")).lower(), run or uuid.uuid4().hex
    named = {name: f"{config.target['schema']}.{config.targets.get(name, name)}" for name in tables}
    return {name: load_table(df, url, named[name], run, mode, properties, int(config.target.get("batch_size", 1000))) for name, df in tables.items()}


@contextmanager
def _written(tables: Mapping[str, DataFrame]) -> Iterator[dict[str, DataFrame]]:
    """The tables, written to the shared folder and read again: worked out once, whatever reads them."""
    made: dict[str, tuple[SparkSession, str]] = {}
    out: dict[str, DataFrame] = {}
    try:
        for name, df in tables.items():
            spark = df.sparkSession
            made[name] = spark, new_path(spark, "sink")
            df.write.parquet(made[name][1])
            out[name] = spark.read.schema(df.schema).parquet(made[name][1])
        yield out
    finally:
        for spark, path in made.values():
            drop_path(spark, path)


def load(tables: Mapping[str, DataFrame], exports: Iterable[str], folder: str, config: Config, **options: Any) -> dict[str, Any]:
    """Every sink that is asked for: csv, parquet, excel, sql (which needs the option url; also run, properties). What several sinks read is worked out once;
    keep: for one sink too, so that every table has been worked out whole when this ends, whatever a sink leaves out."""
    kinds = [x.lower() for x in exports]
    if odd := set(kinds) - {"csv", "parquet", "excel", "xlsx", "sql"}:
        raise LoaderError(f"Unknown exports: {', '.join(sorted(odd))}")
    out: dict[str, Any] = {}
    with _written(tables) if len(kinds) > 1 or options.get("keep") else nullcontext(dict(tables)) as kept:
        for kind in kinds:
            if kind == "csv":
                out[kind] = write_csv(kept, f"{folder}/csv", one_file=options.get("one_file", False))
            elif kind == "parquet":
                write_parquet(kept, f"{folder}/parquet")
            elif kind in ("excel", "xlsx"):
                out[kind] = write_excel(kept, folder, str(config.source["file"]))
            elif "url" in options:
                out[kind] = write_jdbc(kept, config, options["url"], options.get("properties"), options.get("run"))
            else:
                log.warning("No database URL was given; nothing was written to %s", config.target["database"])
    return out
