"""Rows of a sheet as the workbook source writes them, made and read a batch at a time by Arrow's functions.

A plain row has its cells one by one, without places, styles or shared strings. What is not plain, to the byte, is left to the XML parser.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv

from .workbook import cell, number_text

PLAIN_HEAD, ROW_END = b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>', b"</row>"
NUMBER, NUMBER_END, TEXT, TEXT_END = "<c><v>", "</v></c>", '<c t="inlineStr"><is><t xml:space="preserve">', "</t></is></c>"
TRUTH = '<c t="b"><v>'
#: characters that no XML has stand for what begins a cell and for a line's end in a text
_CELL, _LINE = b"\x01", b"\x02"
_FIELDS = [(TEXT.encode(), _CELL + b"s"), (NUMBER.encode(), _CELL + b"n"), (TRUTH.encode(), _CELL + b"b"), (b"<c/>", _CELL), (TEXT_END.encode(), b""), (NUMBER_END.encode(), b"")]
_ENDS = (TEXT_END.encode(), NUMBER_END.encode(), b"<c/>")
#: numbers whose text stays: whole ones below 10 ** 15, others of 15 digits at most
_WHOLE, _BROKEN = r"^(?:0|-?[1-9][0-9]{0,14})$", r"^-?(?:[1-9][0-9]*|0)\.(?:[0-9]*[1-9])$"


def row_xml(batch: pa.RecordBatch) -> bytes:
    """<row>...</row> of every row, as `cell` has its cells."""
    if batch.nbytes >= 1 << 27 and batch.num_rows > 1:  # the texts of one array have 2 GB at most
        half = batch.num_rows // 2
        return row_xml(batch.slice(0, half)) + row_xml(batch.slice(half))
    cells = [_cells(c) for c in batch.columns]
    rows = pc.binary_join_element_wise(pa.scalar("<row>"), *cells, pa.scalar("</row>"), pa.scalar("")) if cells else pa.array(["<row></row>"] * batch.num_rows)
    rows = rows if isinstance(rows, pa.Array) else rows.combine_chunks()
    first, last = (int(x) for x in np.frombuffer(rows.buffers()[1], np.int32)[[rows.offset, rows.offset + len(rows)]])
    return bytes(memoryview(rows.buffers()[2])[first:last]) if last > first else b""


def _cells(c: pa.Array) -> pa.Array:
    kind = c.type
    if pa.types.is_boolean(kind):
        made = pc.if_else(c, f"{TRUTH}1{NUMBER_END}", f"{TRUTH}0{NUMBER_END}")
    elif pa.types.is_integer(kind) or (pa.types.is_float64(kind) and pc.all(pc.is_finite(c), min_count=0).as_py()):
        made = pc.binary_join_element_wise(NUMBER, c.cast(pa.string()), NUMBER_END, "")
    elif pa.types.is_string(kind):
        text = pc.replace_substring_regex(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = pc.replace_substring(text, sign, name)
        made = pc.binary_join_element_wise(TEXT, text, TEXT_END, "")
    else:
        return pa.array([cell(x) for x in c.to_pylist()], pa.string())
    return pc.fill_null(made, "<c/>")


def plain_rows(xml: bytes, width: int, skip: int) -> tuple[int, list[pa.Array]] | None:
    """(number of these whole rows, their columns as text but for the first skip rows); None where they are not plain."""
    if not xml.startswith(b"<row>") or any(x in xml for x in (_CELL, _LINE, b"\r")):
        return None
    if any(xml.count(x) != xml.count(x + b"<c") + xml.count(x + ROW_END) for x in _ENDS):
        return None
    marks = xml.count(b"&")
    if marks and marks != sum(xml.count(x) for x in (b"&amp;", b"&lt;", b"&gt;")):
        return None
    fields = xml[len(b"<row>") : -len(ROW_END)].replace(b"\n", _LINE).replace(ROW_END + b"<row>", b"\n")
    for tag, mark in _FIELDS:
        fields = fields.replace(tag, mark)
    if b"<" in fields:
        return None
    names = [str(k) for k in range(width + 1)]
    reading = csv.ReadOptions(use_threads=False, block_size=len(fields) + 1, column_names=names)
    parsing = csv.ParseOptions(delimiter=_CELL.decode(), quote_char=False, double_quote=False, ignore_empty_lines=False)
    try:
        table = csv.read_csv(pa.BufferReader(fields + b"\n"), reading, parsing, csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False))
        n = table.num_rows
        if pc.any(pc.not_equal(table["0"], "")).as_py():
            return None
        table = table.slice(max(0, skip))
        return n, [_texts(table[k].combine_chunks() if table.num_rows else pa.array([], pa.string()), bool(marks)) for k in names[1:]]
    except (pa.ArrowInvalid, ValueError, OverflowError):
        return None


def _texts(fields: pa.Array, escaped: bool) -> pa.Array:
    """A column's texts; each field begins with its kind, and an empty one is null. ValueError where a kind is unknown."""
    kinds = pc.utf8_slice_codeunits(fields, 0, 1)
    found = set(pc.unique(kinds).to_pylist()) - {""}
    values = pc.utf8_slice_codeunits(fields, 1)
    if found <= {"n"}:
        out = _numbers(values, pc.equal(kinds, ""))
    elif found == {"s"}:
        out = _unescaped(values, escaped)
    else:
        of = {"n": number_text, "s": lambda x: _unescaped(pa.array([x]), escaped)[0].as_py(), "b": lambda x: "True" if x == "1" else "False"}
        if not found <= of.keys():
            raise ValueError(f"kinds {found}")
        return pa.array([of[x[0]](x[1:]) if x else None for x in fields.to_pylist()], pa.string())
    return pc.if_else(pc.equal(kinds, ""), pa.scalar(None, pa.string()), out)


def _unescaped(values: pa.Array, escaped: bool) -> pa.Array:
    values = pc.replace_substring(values, _LINE.decode(), "\n")
    if escaped:
        for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            values = pc.replace_substring(values, name, sign)
    return values


def _numbers(values: pa.Array, null: pa.Array) -> pa.Array:
    stays = pc.or_(null, pc.match_substring_regex(values, _WHOLE))
    if not pc.all(stays, min_count=0).as_py():
        small = pc.match_substring_regex(values, r"^-?0\.0000")
        stays = pc.or_(stays, pc.and_(pc.and_not(pc.match_substring_regex(values, _BROKEN), small), pc.less_equal(pc.binary_length(values), 16)))
    if pc.all(stays, min_count=0).as_py():
        return values
    return pc.replace_with_mask(values, pc.invert(stays), pa.array([number_text(x) for x in values.filter(pc.invert(stays)).to_pylist()], pa.string()))
