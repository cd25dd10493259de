"""XLSX workbooks as a data source of Spark: spark.read.format("cleanloom_xlsx") and df.write.format("cleanloom_xlsx").

Reading. A sheet is one compressed stream of XML. A partition is a stretch of that stream's bytes, as it is when decompressed, and owns the rows whose tag
begins there: it decompresses what comes before only to count rows, parses its own stretch, and then looks up those shared strings that its rows use, in
one pass over the stream of all. No task holds a file, a sheet or the table of strings. Files are opened by pyarrow's file systems: local or mounted paths and
those of object stores.

Rows that are plain, as this source writes them, are made and read a batch at a time by Arrow's functions (`plain.py`); all others by an XML parser, a cell at a time.

Writing. Tasks write their rows as fragments of a sheet into a folder of this write; committing joins the fragments in the order of partitions into a workbook
that is moved into place when it is whole; aborting, and committing, removes the folder. Fragments of attempts that did not commit are never read, so a task that
fails or runs twice leaves nothing behind.

A sheet has 1,048,576 rows at most. With book_rows a table of any size is a folder of workbooks with one sheet each, of so many rows at most: tasks write these
whole, nothing passes through the driver but their names, and a list in the folder (`_books.json`), written when all have committed, says which make up the table,
in which order. Such a folder is read as one table, its rows numbered through.

Options: path, sheet; reading also header_row (1; 0 for none), split_bytes; writing also manifest, a file to name the fragments in, in place of the joining, or book_rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from itertools import chain
from typing import IO
from xml.etree import ElementTree as ET

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..errors import LoaderError, Where
from .plain import PLAIN_HEAD, ROW_END, plain_rows, row_xml
from .workbook import MAX_NAME, MAX_ROWS, ROW, Workbook, cell, column_of, header, plain_text, workbook_parts

NAME = "cleanloom_xlsx"
#: decompressed bytes of a partition; bytes of a stream that are looked at together; rows of a batch
SPLIT, CHUNK, BATCH = 16 << 20, 1 << 20, 4096
#: rows of a workbook in a folder of them, the list in that folder
BOOK_ROWS, LISTED = 1 << 16, "_books.json"
_ROW = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?row(?=[\s/>])[^>]*>")
_NUMBER = re.compile(rb'\sr="(\d+)"')
_DATA = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?sheetData(?:\s[^>]*)?>")
_DATA_END = re.compile(rb"</(?:[A-Za-z_][\w.-]*:)?sheetData\s*>")
_STRINGS = re.compile(rb"<((?:[A-Za-z_][\w.-]*:)?sst)(?:\s[^>]*)?>")
_STRING = re.compile(rb"<(?:[A-Za-z_][\w.-]*:)?si(?=[\s/>])")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """(pyarrow's file system of a path, the path in it); ValueError where pyarrow knows none."""
    local = re.match(r"file:/+", path)
    if local or "://" not in path:
        return fs.LocalFileSystem(), "/" + path[local.end() :] if local else os.path.abspath(path)
    try:
        return fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError) as e:
        raise ValueError(f"{path}: {e}") from e


@contextmanager
def opened(path: str) -> Iterator[Workbook]:
    system, at = file_system(path)
    with system.open_input_file(at) as f:
        yield Workbook(f)


def _whole_tags(stream, buffer: bytes) -> tuple[bytes, bytes, bool]:
    """(what is there with no tag cut in two, the rest, whether the stream has ended)"""
    more = stream.read(CHUNK)
    buffer += more
    if not more:
        return buffer, b"", True
    open_tag = buffer.rfind(b"<")
    cut = open_tag if open_tag > buffer.rfind(b">") else len(buffer)
    return buffer[:cut], buffer[cut:], False


def _unnumbered(part: bytes) -> int | None:
    """How many rows begin in part, where all their tags are plain; None where one may have a number or a prefix."""
    n = part.count(b"<row>")
    return n if part.count(b"<row") == n and b":row" not in part else None


def stretch(stream, start: int, end: int) -> Iterator[bytes | int]:
    """First the XML before a sheet's rows and the number of the row before the stretch, then the XML of the rows whose tag begins in it."""
    rest, at, head, number, inside, ended = b"", 0, None, 0, False, False
    while not ended:
        part, rest, ended = _whole_tags(stream, rest)
        here, at = at, at + len(part)
        if head is None:
            found = _DATA.search(part)
            if not found:
                if ended:
                    return
                rest, at = part + rest, here
                continue
            yield part[: found.end()]
            head, part, here = True, part[found.end() :], here + found.end()
            if found[0].endswith(b"/>"):
                yield 0
                return
        stop = _DATA_END.search(part) if b"sheetData" in part else None
        if stop:
            part = part[: stop.start()]
        past = here + len(part)
        if inside and past <= end:
            yield part
            if stop:
                break
            continue
        if (rows := _unnumbered(part)) is not None:
            begin = 0 if inside else part.find(b"<row>", max(0, start - here))
            close = part.find(b"<row>", max(0, end - here)) if past > end else -1
            if not inside:
                number += rows if begin < 0 else part.count(b"<row>", 0, begin)
                if begin == close >= 0:
                    yield number
                    return
                if begin >= 0:
                    yield number
                    inside = True
            if inside:
                yield part[begin:] if close < 0 else part[begin:close]
            if close >= 0:
                return
            if stop:
                break
            continue
        begin = 0 if inside else None
        for m in _ROW.finditer(part):
            place = here + m.start()
            if place >= end:
                if not inside and begin is None:
                    yield number
                elif begin is not None:
                    if not inside:
                        yield number
                    yield part[begin : m.start()]
                return
            if place >= start:
                if not inside and begin is None:
                    begin = m.start()
            else:
                own = _NUMBER.search(m[0])
                number = int(own[1]) if own else number + 1
        if begin is not None:
            if not inside:
                yield number
                inside = True
            yield part[begin:]
        if stop:
            break
    if head and not inside:
        yield number


def rows_between(book: Workbook, sheet: str, start: int, end: int) -> Iterator[tuple[int, list[str | int | None]]]:
    """(number of the row from 1, its cells) of a stretch; a shared string is its number."""
    with book.open(sheet) as stream:
        parts = stretch(stream, start, end)
        head = next(parts, b"<none>")
        yield from _parsed(book, head, next(parts, 0), parts)


def _parsed(book: Workbook, head: bytes, number: int, parts: Iterable[bytes]) -> Iterator[tuple[int, list[str | int | None]]]:
    """The rows of parts, which begin below head and below the row of this number."""
    parser = ET.XMLPullParser(["start", "end"])
    parser.feed(head)
    data = None
    for part in parts:
        parser.feed(part)
        for event, node in parser.read_events():
            kind = plain_text(node.tag)
            if event == "start":
                data = node if kind == "sheetData" else data
            elif kind == "row":
                number = int(node.get("r") or number + 1)
                cells: list[str | int | None] = []
                for c in node:
                    if plain_text(c.tag) == "c":
                        k = column_of(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (k + 1 - len(cells))
                        cells[k] = book.value(c)
                data.remove(node)
                yield number, cells


def strings(book: Workbook, wanted: set[int]) -> dict[int, str]:
    """The shared strings of these numbers, in one pass; only they are parsed."""
    found: dict[int, str] = {}
    if not wanted:
        return found
    with book.zip.open("xl/sharedStrings.xml") as stream:
        rest, root, n, most, ended = b"", None, 0, max(wanted), False
        while not ended and n <= most:
            more = stream.read(CHUNK)
            rest, ended = rest + more, not more
            if root is None:
                root = _STRINGS.search(rest)
                if not root:
                    continue
                rest = rest[root.end() :]
            starts = [m.start() for m in _STRING.finditer(rest)]
            if ended:
                last = rest.rfind(b"</" + root[1])
                starts.append(last if last >= 0 else len(rest))
            whole = list(zip(starts, starts[1:], strict=False))  # the last one goes on
            asked = [(n + k, rest[s:e]) for k, (s, e) in enumerate(whole) if n + k in wanted]
            if asked:
                parsed = ET.fromstring(root[0] + b"".join(x for _, x in asked) + b"</" + root[1] + b">")
                found.update((k, book.text(si)) for (k, _), si in zip(asked, parsed, strict=True))
            n, rest = n + len(whole), rest[starts[-1] if starts else 0 :]
    return found


@dataclass
class Book:
    """A workbook in a folder of them: its rows below the header, and the bytes of its sheet's XML."""

    name: str
    rows: int
    size: int


def books(path: str) -> list[Book] | None:
    """The workbooks of a folder; None where path is a workbook itself."""
    system, at = file_system(path)
    if system.get_file_info(at).type != fs.FileType.Directory:
        return None
    with system.open_input_file(f"{at}/{LISTED}") as f:
        return [Book(**b) for b in json.loads(f.read())]


def first_book(path: str) -> str:
    found = books(path)
    return f"{path.rstrip('/')}/{found[0].name}" if found else path


@dataclass
class Stretch(InputPartition):
    path: str
    before: int
    start: int
    end: int


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.sheet = options["path"], options["sheet"]
        self.header_row, self.split = int(options.get("header_row", 1)), int(options.get("split_bytes", SPLIT))
        self.names = [f.name for f in schema.fields]

    def partitions(self) -> list[Stretch]:
        found, out, before = books(self.path), [], 0
        if found is None:
            with opened(self.path) as book:
                return self._stretches(self.path, 0, book.size(self.sheet))
        for b in found:
            out += self._stretches(f"{self.path.rstrip('/')}/{b.name}", before, b.size)
            before += b.rows
        return out

    def _stretches(self, path: str, before: int, size: int) -> list[Stretch]:
        n = max(1, -(-size // self.split))
        return [Stretch(path, before, k * self.split, (k + 1) * self.split if k + 1 < n else 1 << 62) for k in range(n)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        with opened(partition.path) as book, book.open(self.sheet) as stream:
            parts = stretch(stream, partition.start, partition.end)
            head, number, rest = next(parts, b"<none>"), next(parts, 0), b""
            if head == PLAIN_HEAD and not book.dated:
                for part in parts:
                    rest += part
                    cut = rest.rfind(ROW_END) + len(ROW_END)
                    if cut < len(ROW_END):
                        continue
                    found = plain_rows(rest[:cut], len(self.names) - 1, self.header_row - number)
                    if found is None:
                        break
                    n, cols = found
                    first, number, rest = max(number, self.header_row), number + n, rest[cut:]
                    if number > first:
                        ordinals = pa.array(range(first, number), pa.int64())
                        yield pa.RecordBatch.from_arrays([pc.add(ordinals, partition.before - self.header_row), *cols], self.names)
            yield from self._cell_by_cell(book, partition, _parsed(book, head, number, chain([rest], parts)))

    def _cell_by_cell(self, book: Workbook, partition: Stretch, rows: Iterator[tuple[int, list[str | int | None]]]) -> Iterator[pa.RecordBatch]:
        ordinals: list[int] = []
        cols: list[list] = [[] for _ in self.names[1:]]
        wanted: set[int] = set()
        for number, cells in rows:
            if number <= self.header_row:
                continue
            ordinals.append(partition.before + number - self.header_row - 1)
            for k, col in enumerate(cols):
                value = cells[k] if k < len(cells) else None
                if isinstance(value, int):
                    wanted.add(value)
                col.append(value)
        known = strings(book, wanted)
        for s in range(0, len(ordinals), BATCH):
            texts = [pa.array([known[x] if isinstance(x, int) else x for x in col[s : s + BATCH]], pa.string()) for col in cols]
            yield pa.RecordBatch.from_arrays([pa.array(ordinals[s : s + BATCH], pa.int64()), *texts], self.names)


@dataclass
class Fragment(WriterCommitMessage):
    partition: int
    name: str
    rows: int


@dataclass
class Books(WriterCommitMessage):
    partition: int
    made: list[Book]


class WorkbookWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.sheet, self.manifest = options["path"], options.get("sheet", "Sheet1"), options.get("manifest")
        self.folder, self.overwrite, self.names = f"{self.path}.parts-{uuid.uuid4().hex}", overwrite, [f.name for f in schema.fields]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Fragment:
        context = TaskContext.get()
        partition, rows = context.partitionId() if context else 0, 0
        name = f"{partition:06d}-{uuid.uuid4().hex}.xml.z"
        system, folder = file_system(self.folder)
        system.create_dir(folder)
        packer = zlib.compressobj(1)
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for b in iterator:
                for s in range(0, b.num_rows, BATCH):
                    out.write(packer.compress(row_xml(b.slice(s, BATCH))))
                rows += b.num_rows
            out.write(packer.flush())
        return Fragment(partition, name, rows)

    def commit(self, messages: list[Fragment | None]) -> None:
        parts = sorted((m for m in messages if m), key=lambda m: m.partition)
        if 1 + sum(m.rows for m in parts) > MAX_ROWS:
            raise LoaderError(f"A sheet has {MAX_ROWS} rows at most", Where(self.sheet))
        made = Sheet(self.sheet, self.names, self.folder, [m.name for m in parts])
        if self.manifest:
            system, at = file_system(self.manifest)
            with system.open_output_stream(at, compression=None) as out:
                out.write(json.dumps(made.__dict__).encode())
            return
        system, at = file_system(self.path)
        if not self.overwrite and system.get_file_info(at).type != fs.FileType.NotFound:
            raise LoaderError(f"{self.path} is there already")
        new = f"{at}.new-{uuid.uuid4().hex}"
        with system.open_output_stream(new, compression=None) as out:
            join([made], out)
        system.move(new, at)
        self.abort([])

    def abort(self, messages: list[Fragment | None]) -> None:
        system, folder = file_system(self.folder)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


@dataclass
class Sheet:
    name: str
    columns: list[str]
    folder: str
    fragments: list[str]


def sheet_of(manifest: str) -> Sheet:
    system, at = file_system(manifest)
    with system.open_input_file(at) as f:
        return Sheet(**json.loads(f.read()))


_TAIL = b"</sheetData></worksheet>"


def _head(columns: list[str]) -> bytes:
    return PLAIN_HEAD + f"<row>{''.join(map(cell, columns))}</row>".encode()


def join(sheets: list[Sheet], out) -> None:
    """A workbook of the fragments of sheets, a chunk at a time."""
    names = [s.name[:MAX_NAME] for s in sheets]
    if len({n.lower() for n in names}) < len(names):
        raise LoaderError(f"Two sheets would have one name: {', '.join(names)}")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for path, text in workbook_parts(names).items():
            z.writestr(path, text)
        for k, s in enumerate(sheets, 1):
            system, folder = file_system(s.folder)
            with z.open(f"xl/worksheets/sheet{k}.xml", "w", force_zip64=True) as f:
                f.write(_head(s.columns))
                for name in s.fragments:
                    unpacker = zlib.decompressobj()
                    with system.open_input_stream(f"{folder}/{name}", compression=None) as part:
                        while chunk := part.read(CHUNK):
                            f.write(unpacker.decompress(chunk))
                        f.write(unpacker.flush())
                f.write(_TAIL)


@contextmanager
def sheet_in(out: IO[bytes], sheet: str, columns: list[str]) -> Iterator[IO[bytes]]:
    """A workbook of one sheet, whose rows are written to what this gives."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        for path, text in workbook_parts([sheet]).items():
            z.writestr(path, text)
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            f.write(_head(columns))
            yield f
            f.write(_TAIL)


class BooksWriter(DataSourceArrowWriter):
    """A folder of workbooks. Their names begin with this write's own mark: an abort removes them, a commit what else is there."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.sheet, self.rows = options["path"], options.get("sheet", "Sheet1")[:MAX_NAME], int(options["book_rows"])
        if not 0 < self.rows < MAX_ROWS:
            raise LoaderError(f"A workbook takes 1 to {MAX_ROWS - 1} rows", Where(self.sheet))
        self.mark, self.overwrite, self.names = uuid.uuid4().hex, overwrite, [f.name for f in schema.fields]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Books:
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        batches = (b.slice(s, BATCH) for b in iterator for s in range(0, b.num_rows, BATCH))
        made: list[Book] = []
        rest = next(batches, None)
        while rest is not None:
            book, rest = self._book(f"{partition:06d}-{len(made):06d}", rest, batches)
            made.append(book)
        return Books(partition, made)

    def _book(self, place: str, part: pa.RecordBatch | None, batches: Iterator[pa.RecordBatch]) -> tuple[Book, pa.RecordBatch | None]:
        """A workbook of part and of the rows that come, until it is full; and what comes after these."""
        system, folder = file_system(self.path)
        system.create_dir(folder)
        name, n, size = f"{self.mark}-{place}-{uuid.uuid4().hex}.xlsx", 0, len(_head(self.names)) + len(_TAIL)
        with system.open_output_stream(f"{folder}/{name}", compression=None) as out, sheet_in(out, self.sheet, self.names) as f:
            while part is not None and n < self.rows:
                here = part.slice(0, self.rows - n)
                n += here.num_rows
                size += f.write(row_xml(here))
                part = part.slice(here.num_rows) if here.num_rows < part.num_rows else next(batches, None)
        return Book(name, n, size), part

    def commit(self, messages: list[Books | None]) -> None:
        made = [b for m in sorted((m for m in messages if m), key=lambda m: m.partition) for b in m.made]
        system, folder = file_system(self.path)
        there = system.get_file_info(folder).type
        if not self.overwrite and (there == fs.FileType.File or system.get_file_info(f"{folder}/{LISTED}").type == fs.FileType.File):
            self.abort([])
            raise LoaderError(f"{self.path} is there already")
        made = made or [self._book("empty", None, iter(()))[0]]  # for its header
        with system.open_output_stream(f"{folder}/{self.mark}.json", compression=None) as out:
            out.write(json.dumps([asdict(b) for b in made]).encode())
        system.move(f"{folder}/{self.mark}.json", f"{folder}/{LISTED}")
        self._remove(lambda name: name != LISTED and name not in {b.name for b in made})

    def abort(self, messages: list[Books | None]) -> None:
        self._remove(lambda name: name.startswith(self.mark))

    def _remove(self, which: Callable[[str], bool]) -> None:
        system, folder = file_system(self.path)
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.type == fs.FileType.File and which(info.base_name):
                system.delete_file(info.path)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        with opened(first_book(self.options["path"])) as book:
            return schema_of(header(book, self.options["sheet"], int(self.options.get("header_row", 1))))

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter | BooksWriter:
        return (BooksWriter if "book_rows" in self.options else WorkbookWriter)(dict(self.options), schema, overwrite)


def schema_of(names: list[str]) -> StructType:
    return StructType([StructField(ROW, LongType()), *(StructField(n, StringType()) for n in names)])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)
