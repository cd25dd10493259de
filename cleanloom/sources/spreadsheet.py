"""Sheets of XLSX workbooks as tables of text cells, and tables as workbooks.

Where pyarrow's file systems open a path, a sheet is read by the data source of `workbook_source`, in as many partitions as it is long. Other paths, of file
systems that only Spark knows, go through Spark's binaryFile source, a workbook in one task. Workbooks are written by that data source's tasks.
"""

from __future__ import annotations

import io
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession

from ..errors import ExtractorError, LoaderError
from ..shipping import ship
from ..staging import drop_path, hadoop, new_path
from . import workbook_source
from .workbook import MAX_NAME, ROW, Workbook, header

BATCH = 4096


def read_sheet(spark: SparkSession, path: str, sheet: str, header_row: int = 1, split_bytes: int = workbook_source.SPLIT) -> DataFrame:
    """A sheet's cells as text, with the ordinal of each row below the header (counting empty rows)."""
    ship(spark)
    try:
        with workbook_source.opened(workbook_source.first_book(path)) as book:
            schema = workbook_source.schema_of(header(book, sheet, header_row))
    except ValueError:
        return _read_whole(spark, path, sheet, header_row)
    except OSError as e:
        raise ExtractorError(f"{path}: {e}") from e
    workbook_source.register(spark)
    reader = spark.read.format(workbook_source.NAME).schema(schema).option("sheet", sheet).option("header_row", header_row)
    return reader.option("split_bytes", split_bytes).load(path)


def _read_whole(spark: SparkSession, path: str, sheet: str, header_row: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("content")

    def headers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([header(Workbook(io.BytesIO(x)), sheet, header_row) for x in b["content"].to_pylist()], pa.list_(pa.string()))], ["names"])

    try:
        found = files.mapInArrow(headers, "names array<string>").limit(2).collect()  # the names only; the workbook stays in the tasks
    except PythonException as e:
        raise ExtractorError(f"{path}: {_last_line(e)}") from e
    if len(found) != 1:
        raise ExtractorError(f"{path} is not one workbook")
    names = found[0][0]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b["content"].to_pylist():
                ordinals: list[int] = []
                cols: list[list[str | None]] = [[] for _ in names]
                for number, cells in Workbook(io.BytesIO(content)).rows(sheet):
                    if number <= header_row:
                        continue
                    ordinals.append(number - header_row - 1)
                    for k, col in enumerate(cols):
                        col.append(cells[k] if k < len(cells) else None)
                    if len(ordinals) == BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(ordinals, pa.int64()), *(pa.array(c, pa.string()) for c in cols)], [ROW, *names])
                        ordinals, cols = [], [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(ordinals, pa.int64()), *(pa.array(c, pa.string()) for c in cols)], [ROW, *names])

    kind = ", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in [(ROW, "long"), *((n, "string") for n in names)])
    return files.mapInArrow(rows, kind)


def _last_line(e: Exception) -> str:
    """What a task's own error said."""
    said = [x for x in str(e).splitlines() if "ExtractorError" in x]
    return said[-1].split("ExtractorError:")[-1].strip() if said else str(e).splitlines()[0]


def write_workbook(tables: dict[str, DataFrame], path: str) -> None:
    """One sheet per table, names cut to 31 characters. Tasks write fragments of sheets into the shared folder; the driver joins these, byte by byte,
    into a file beside it, which is then copied to path, on whatever file system that is. Nothing is left of a write that fails."""
    names = [name[:MAX_NAME] for name in tables]
    if again := {n for n in names if names.count(n) > 1}:
        raise LoaderError(f"Two sheets would be named {', '.join(sorted(again))}")
    spark = next(iter(tables.values())).sparkSession
    ship(spark)
    workbook_source.register(spark)
    folder = new_path(spark, "sheets")
    try:
        workbook_source.file_system(folder)
    except ValueError as e:
        raise LoaderError(f"Fragments of sheets cannot be written to the shared folder: {e}") from e
    try:
        made, disk = [], hadoop(spark, folder)
        disk[0].mkdirs(disk[1])
        for k, (name, df) in enumerate(tables.items()):
            manifest = f"{folder}/{k}.json"
            df.write.format(workbook_source.NAME).option("sheet", name).option("manifest", manifest).mode("overwrite").save(f"{folder}/{k}")
            made.append(workbook_source.sheet_of(manifest))
        with tempfile.TemporaryDirectory() as beside:
            with open(f"{beside}/workbook.xlsx", "wb") as out:
                workbook_source.join(made, out)
            files, to = hadoop(spark, path)
            files.copyFromLocalFile(True, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{beside}/workbook.xlsx"), to)
    finally:
        drop_path(spark, folder)
