"""The format of XLSX workbooks, with the standard library: parts, cells and their text. Cells come out as text."""

from __future__ import annotations

import datetime as dt
import re
import zipfile
from collections.abc import Iterator
from functools import cached_property
from typing import IO
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from ..errors import ExtractorError, Where
from ..plans.table import ROW  # noqa: F401

MAX_ROWS, MAX_NAME = 1_048_576, 31
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: fixed values: built-in number formats that show dates or times
DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def plain_text(tag: str) -> str:
    """A tag without its namespace."""
    return tag.rpartition("}")[2]


class Workbook:
    def __init__(self, file: IO[bytes]):
        try:
            self.zip = zipfile.ZipFile(file)
            book = ET.fromstring(self.zip.read("xl/workbook.xml"))
            rels = ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
            raise ExtractorError(f"Not an XLSX workbook: {e}") from e
        target = {r.get("Id"): r.get("Target") for r in rels}
        self.sheets = {s.get("name"): target[s.get(f"{_REL}id")] for s in book.iter(f"{_MAIN}sheet")}
        flags = next(book.iter(f"{_MAIN}workbookPr"), None)
        self.epoch = dt.datetime(1904, 1, 1) if flags is not None and flags.get("date1904") in ("1", "true") else dt.datetime(1899, 12, 30)
        self.dated = self._dated() if "xl/styles.xml" in self.zip.namelist() else []

    @cached_property
    def strings(self) -> list[str]:
        """All shared strings, for who reads a sheet whole."""
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        return [self.text(si) for si in ET.fromstring(self.zip.read("xl/sharedStrings.xml"))]

    @staticmethod
    def text(si: ET.Element) -> str:
        """A string's text, of all its runs, without what tells how it is spoken."""
        runs = [x for x in si if plain_text(x.tag) in ("t", "r")]
        return "".join(t.text or "" for x in runs for t in x.iter() if plain_text(t.tag) == "t")

    def _dated(self) -> list[bool]:
        """For each cell style whether it shows a date."""
        root = ET.fromstring(self.zip.read("xl/styles.xml"))
        own = {int(f.get("numFmtId")): f.get("formatCode") or "" for f in root.iter(f"{_MAIN}numFmt")}
        plain = {k: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", v) for k, v in own.items()}
        xfs = root.find(f"{_MAIN}cellXfs")
        return [(n := int(x.get("numFmtId") or 0)) in DATE_FORMATS or bool(re.search("[ymdhs]", plain.get(n, ""), re.I)) for x in xfs] if xfs is not None else []

    def _part(self, sheet: str) -> str:
        if sheet not in self.sheets:
            raise ExtractorError(f"No sheet {sheet}", Where(details={"sheets": sorted(self.sheets)}))
        path = self.sheets[sheet].lstrip("/")
        return path if path.startswith("xl/") else f"xl/{path}"

    def size(self, sheet: str) -> int:
        """Bytes of a sheet's XML."""
        return self.zip.getinfo(self._part(sheet)).file_size

    def open(self, sheet: str) -> IO[bytes]:
        return self.zip.open(self._part(sheet))

    def rows(self, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
        """(number of the row from 1, its cells as text)"""
        with self.open(sheet) as f:
            number = 0
            for _, row in ET.iterparse(f):
                if plain_text(row.tag) != "row":
                    continue
                number = int(row.get("r") or number + 1)
                cells: list[str | None] = []
                for c in row:
                    if plain_text(c.tag) == "c":
                        at = column_of(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at + 1 - len(cells))
                        value = self.value(c)
                        cells[at] = self.strings[value] if isinstance(value, int) else value
                row.clear()
                yield number, cells

    def value(self, c: ET.Element) -> str | int | None:
        """A cell as text, or the number of its shared string."""
        kind, value = c.get("t"), c.find(f"{_MAIN}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        if value is None or value.text is None:
            return None
        if kind == "s":
            return int(value.text)
        if kind == "b":
            return "True" if value.text == "1" else "False"
        if kind in ("str", "e"):
            return value.text
        style = int(c.get("s") or 0)
        if style < len(self.dated) and self.dated[style]:
            at = self.epoch + dt.timedelta(seconds=round(float(value.text) * 86400))
            return str(at.time()) if float(value.text) < 1 else str(at)
        return number_text(value.text)


def number_text(text: str) -> str:
    number = float(text)
    return str(int(number)) if number == int(number) and abs(number) < 1e15 else repr(number)


def column_of(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def header(book: Workbook, sheet: str, header_row: int) -> list[str]:
    width = 0
    for number, cells in book.rows(sheet):
        if header_row and number == header_row:
            names: list[str] = []
            for k, c in enumerate(cells):
                name, again = c if c else f"Unnamed: {k}", 0
                while (f"{name}.{again}" if again else name) in names:
                    again += 1
                names.append(f"{name}.{again}" if again else name)
            return names
        width = max(width, len(cells))
    if header_row:
        raise ExtractorError(f"Sheet {sheet} has no row {header_row}")
    return list(map(str, range(width)))


def cell(value: object) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, int | float) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    if isinstance(value, bytes | bytearray):
        value = bytes(value).hex()
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def workbook_parts(names: list[str]) -> dict[str, str]:
    """path -> text of all parts of a workbook of these sheets but the sheets."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    pkg = "http://schemas.openxmlformats.org/package/2006"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    sheet_type = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    count = range(1, len(names) + 1)
    overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{sheet_type}.worksheet+xml"/>' for k in count)
    related = "".join(f'<Relationship Id="rId{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in count)
    sheets = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
    return {
        "[Content_Types].xml": f'<Types xmlns="{pkg}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{sheet_type}.sheet.main+xml"/>{overrides}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{pkg}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{pkg}/relationships">{related}</Relationships>',
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="{office}"><sheets>{sheets}</sheets></workbook>',
    }
