"""The workbook data source: stretches of a sheet, shared strings, and what is left of writes that fail."""

import io
import os
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cleanloom.errors import ExtractorError
from cleanloom.plans.table import ROW
from cleanloom.sources import workbook, workbook_source
from cleanloom.sources.spreadsheet import _read_whole, read_sheet, write_workbook
from cleanloom.sources.workbook_source import NAME

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def rows_of(prefix, numbered):
    """XML of rows with gaps between them, empty rows, shared, inline and plain cells; and the rows as they are read."""
    p, out, expected, n = prefix, [], [], 0
    for k in range(60):
        n += 3 if k % 10 == 9 and numbered else 1
        ref = (lambda c, n=n: f' r="{c}{n}"') if numbered else (lambda c: "")
        at = f' r="{n}"' if numbered else ""
        if k % 7 == 3:
            out.append(f"<{p}row{at}/>")
            expected.append((n, []))
            continue
        shared = (k * 5) % 23
        out.append(f'<{p}row{at} spans="1:3"><{p}c{ref("A")} t="s"><{p}v>{shared}</{p}v></{p}c><{p}c{ref("B")}><{p}v>{k / 2}</{p}v></{p}c><{p}c{ref("C")} t="inlineStr"><{p}is><{p}t>i &lt;row&gt; {k}</{p}t></{p}is></{p}c></{p}row>\n')
        expected.append((n, [shared, str(k // 2) if k % 2 == 0 else str(k / 2), f"i <row> {k}"]))
    return "".join(out), expected


def book(path, prefix="", numbered=True):
    xml, expected = rows_of(prefix, numbered)
    space = f'xmlns{":" + prefix[:-1] if prefix else ""}="{MAIN}"'
    p = prefix
    texts = [f"s{k}" if k % 4 else f"r{k} & é" for k in range(23)]
    items = [f"<{p}si><{p}t>{t.replace('&', '&amp;')}</{p}t></{p}si>" if k % 3 else f"<{p}si><{p}r><{p}t>{t[0]}</{p}t></{p}r><{p}r><{p}t>{t[1:].replace('&', '&amp;')}</{p}t></{p}r><{p}rPh><{p}t>spoken</{p}t></{p}rPh></{p}si>" for k, t in enumerate(texts)]
    with zipfile.ZipFile(path, "w") as z:
        for name, text in workbook.workbook_parts(["S"]).items():
            z.writestr(name, text)
        z.writestr("xl/sharedStrings.xml", f'<?xml version="1.0"?>\n<{p}sst {space} count="23">{"".join(items)}</{p}sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<?xml version="1.0" encoding="UTF-8"?>\n<{p}worksheet {space}><{p}dimension ref="A1:C70"/><{p}sheetData>{xml}</{p}sheetData><{p}rowBreaks/></{p}worksheet>')
    return expected, texts


@pytest.mark.parametrize(("prefix", "numbered"), [("", True), ("", False), ("x:", True), ("x:", False)])
@pytest.mark.parametrize("chunk", [7, 64, 1 << 20])
def test_every_row_is_in_one_stretch(tmp_path, monkeypatch, prefix, numbered, chunk):
    monkeypatch.setattr(workbook_source, "CHUNK", chunk)
    path = str(tmp_path / "b.xlsx")
    expected, texts = book(path, prefix, numbered)
    with workbook_source.opened(path) as b:
        size = b.size("S")
        for split in (1 << 20, 997, 300, 41):
            if split == 41 and chunk == 7:
                continue
            got = [r for s in range(0, size, split) for r in workbook_source.rows_between(b, "S", s, s + split)]
            assert got == expected
        assert workbook_source.strings(b, {0, 5, 22}) == {k: texts[k] for k in (0, 5, 22)} and workbook_source.strings(b, set()) == {}
        assert b.strings == texts
        assert list(b.rows("S")) == [(n, [texts[x] if isinstance(x, int) else x for x in cells]) for n, cells in expected]


def test_scan_in_partitions(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    expected, texts = book(path)
    df = read_sheet(spark, path, "S", 0, split_bytes=500)
    assert df.rdd.getNumPartitions() > 5
    got = [tuple(r) for r in df.orderBy(ROW).collect()]
    assert got == [(n - 1, *[texts[x] if isinstance(x, int) else x for x in (cells or [None] * 3)]) for n, cells in expected]
    whole = [tuple(r) for r in _read_whole(spark, path, "S", 0).orderBy(ROW).collect()]
    assert whole == got
    named = spark.read.format(NAME).option("sheet", "S").load(path)
    assert named.columns == [ROW, texts[0], "0", "i <row> 0"] and named.count() == len(expected) - 1


def test_an_empty_sheet(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    with zipfile.ZipFile(path, "w") as z:
        for name, text in workbook.workbook_parts(["S"]).items():
            z.writestr(name, text)
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
    assert read_sheet(spark, path, "S", 0).count() == 0
    with pytest.raises(ExtractorError, match="no row 1"):
        read_sheet(spark, path, "S")


def test_many_tasks_write_one_sheet_in_order(spark, tmp_path):
    path = str(tmp_path / "b.xlsx")
    df = spark.range(0, 60_000, 1, 7).select("id", F.concat(F.lit("text & "), F.col("id")).alias("t"))
    write_workbook({"S": df}, path)
    back = read_sheet(spark, path, "S", split_bytes=1 << 19)
    assert back.rdd.getNumPartitions() > 5
    assert back.where(F.col("id").cast("long") != F.col(ROW)).count() == 0 and back.where(F.col("t") != F.concat(F.lit("text & "), F.col("id"))).count() == 0 and back.count() == 60_000
    assert os.listdir(tmp_path) == ["b.xlsx"]


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    workbook_source.register(spark)
    path = str(tmp_path / "b.xlsx")
    good = spark.range(10).select("id", F.col("id").cast("string").alias("t"))
    good.write.format(NAME).option("sheet", "S").mode("overwrite").save(path)
    before = open(path, "rb").read()
    bad = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") == 3900, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("t"))
    with pytest.raises(PySparkException):
        bad.write.format(NAME).option("sheet", "S").mode("overwrite").save(path)
    assert os.listdir(tmp_path) == ["b.xlsx"] and open(path, "rb").read() == before
    with pytest.raises(PySparkException, match="there already"):
        good.write.format(NAME).option("sheet", "S").mode("append").save(path)
    assert os.listdir(tmp_path) == ["b.xlsx"]
    with pytest.raises(PySparkException):
        write_workbook({"a": good, "b": bad}, str(tmp_path / "c.xlsx"))
    assert os.listdir(tmp_path) == ["b.xlsx"]


def test_rows_beyond_a_sheet(monkeypatch, tmp_path):
    monkeypatch.setattr(workbook_source, "MAX_ROWS", 10)
    from pyspark.sql.types import LongType, StructField, StructType

    from cleanloom.errors import LoaderError

    w = workbook_source.WorkbookWriter({"path": str(tmp_path / "b.xlsx")}, StructType([StructField("a", LongType())]), True)
    import pyarrow as pa

    made = [w.write(iter([pa.RecordBatch.from_pydict({"a": list(range(5))})])) for _ in range(2)]
    with pytest.raises(LoaderError, match="rows at most"):
        w.commit(made)
    w.abort(made)
    assert os.listdir(tmp_path) == []


def test_an_attempt_that_did_not_commit_is_not_read(tmp_path):
    """A task that ran twice has two fragments; the workbook has the rows of one."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StructField, StructType

    path = str(tmp_path / "b.xlsx")
    w = workbook_source.WorkbookWriter({"path": path, "sheet": "S"}, StructType([StructField("a", LongType())]), True)
    batch = pa.RecordBatch.from_pydict({"a": list(range(5))})
    w.write(iter([batch]))
    w.commit([w.write(iter([batch])), None])
    with open(path, "rb") as f:
        assert [c for _, c in workbook.Workbook(io.BytesIO(f.read())).rows("S")] == [["a"], *([str(k)] for k in range(5))]
    assert os.listdir(tmp_path) == ["b.xlsx"]


def test_a_table_of_more_rows_than_a_sheet(spark, tmp_path, monkeypatch):
    """With book_rows a table goes to as many workbooks as it needs; what another write left is gone, and rows are numbered through."""
    path = str(tmp_path / "books")
    df = spark.range(0, 1000, 1, 3).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v "), "id")).alias("odd name"))
    for rows in (90, 70):
        df.write.format(NAME).option("sheet", "t").option("book_rows", rows).mode("overwrite").save(path)
    found = workbook_source.books(path)
    assert len(found) == 15 and sum(b.rows for b in found) == 1000 and max(b.rows for b in found) == 70
    assert sorted(os.listdir(path)) == sorted([workbook_source.LISTED, *(b.name for b in found)])
    for b in found:
        with workbook_source.opened(f"{path}/{b.name}") as one:
            assert one.size("t") == b.size
    back = spark.read.format(NAME).option("sheet", "t").option("split_bytes", 900).load(path)
    assert back.rdd.getNumPartitions() > 15 and read_sheet(spark, path, "t").count() == 1000
    assert [tuple(r) for r in back.orderBy(ROW).collect()] == [(k, str(k), f"v {k}" if k % 3 else None) for k in range(1000)]
    with pytest.raises(PySparkException, match="there already"):
        df.write.format(NAME).option("sheet", "t").option("book_rows", 90).mode("append").save(path)
    assert back.count() == 1000 and len(os.listdir(path)) == 16
    df.limit(0).write.format(NAME).option("sheet", "t").option("book_rows", 90).mode("overwrite").save(path)
    assert (empty := read_sheet(spark, path, "t")).columns == [ROW, "id", "odd name"] and empty.count() == 0


def _cells_of(path, split, names, monkeypatch, plain):
    from pyspark.sql.types import StringType, StructField, StructType

    with monkeypatch.context() as m:
        if not plain:
            m.setattr(workbook_source, "PLAIN_HEAD", b"none")
        reader = workbook_source.WorkbookReader({"path": path, "sheet": "S", "split_bytes": split}, StructType([StructField(n, StringType()) for n in [ROW, *names]]))
        return [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]


@pytest.mark.parametrize("odd", ["", "a\rb", "<!-- x -->"])
def test_plain_rows_are_read_as_the_parser_reads_them(tmp_path, monkeypatch, odd):
    """Every kind of cell, made by Arrow's functions and read by them, against `cell` and the XML parser."""
    import random

    import pyarrow as pa

    from cleanloom.sources.plain import PLAIN_HEAD, row_xml

    seed, nan = random.Random(7), float("nan")
    texts = ["", " ", "a<b>&amp;\"'", "x\ny\tz", "\x01n5\x1f", "é 漢 \U0001f600", "12", "<row>", "</row><row>", ":row", "sheetData", "n", "]]>", None]
    doubles = [0.0, -0.0, 12.0, 12.5, -3.25, 1e15, 1e16, 123456789012345.6, 0.1 + 0.2, 1e-4, 1e-5, 0.00012, -1.5e-7, 1e300, 5e-324, 99999999999999.9, None, *(seed.uniform(-1e6, 1e6) for _ in range(20)), *(round(seed.uniform(0, 1e5), 2) for _ in range(20))]
    whole = [0, -1, 7, 10**15, 10**15 - 1, -(10**15), (1 << 63) - 1, -(1 << 63), None]
    deal = lambda values: [seed.choice(values) for _ in range(700)]
    made = {
        "t": pa.array(deal(texts) if not odd else [*deal(texts)[:-300], odd, *deal(texts)[:299]]), "d": pa.array(deal(doubles)), "f": pa.array(deal([1.5, nan, float("inf"), None])), "w": pa.array(deal(whole), pa.int64()),
        "i": pa.array(deal([1, -2]), pa.int32()), "b": pa.array(deal([True, False, None])), "n": pa.array([None] * 700, pa.string()), "x": pa.array(deal([b"\x00\xff", None])), "r": pa.array(deal([0.1, None]), pa.float32()),
    }
    batch = pa.RecordBatch.from_pydict(made).slice(3)
    xml = "".join(f"<row>{''.join(map(workbook.cell, r.values()))}</row>" for r in batch.to_pylist()).encode()
    assert row_xml(batch.slice(0, 0)) == b""
    seen = []
    for name, rows in (("cells", xml), ("plain", row_xml(batch))):
        rows = rows if odd != "<!-- x -->" else rows.replace(b"</row><row>", b"</row><!-- x --><row>")
        path = str(tmp_path / f"{name}.xlsx")
        with zipfile.ZipFile(path, "w") as z:
            for part, text in workbook.workbook_parts(["S"]).items():
                z.writestr(part, text)
            z.writestr("xl/worksheets/sheet1.xml", PLAIN_HEAD + f"<row>{''.join(map(workbook.cell, made))}</row>".encode() + rows + b"</sheetData></worksheet>")
        for chunk in (1 << 20, 5000):
            monkeypatch.setattr(workbook_source, "CHUNK", chunk)
            seen += [_cells_of(path, split, made, monkeypatch, plain) for split in (1 << 24, 9000) for plain in (True, False)]
    assert len(seen[0]) == 697 and [r[0] for r in seen[0]] == list(range(697)) and all(x == seen[0] for x in seen)


def test_plain_rows_pass_the_parser_by(tmp_path, monkeypatch):
    """Rows of a folder of workbooks are neither made nor parsed a cell at a time, which took 10 times as long."""
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    path, names = str(tmp_path / "books"), ["k", "t", "d"]
    writer = workbook_source.BooksWriter({"path": path, "sheet": "S", "book_rows": 900}, StructType([StructField(n, StringType()) for n in names]), True)
    batch = pa.RecordBatch.from_pydict({"k": list(range(5000)), "t": [f"a & {k}" for k in range(5000)], "d": [k / 4 for k in range(5000)]})
    calls = []
    monkeypatch.setattr("cleanloom.sources.plain.cell", lambda x: calls.append(x))
    writer.commit([writer.write(iter([batch, batch.slice(0, 100)]))])
    monkeypatch.setattr(workbook.Workbook, "value", lambda self, c: calls.append(c))
    monkeypatch.setattr(workbook_source, "cell", lambda x: calls.append(x))
    assert [b.rows for b in workbook_source.books(path)] == [900] * 5 + [600]
    got = _cells_of(path, 20_000, names, monkeypatch, True)
    assert got == [(n, str(k), f"a & {k}", workbook.number_text(str(k / 4))) for n, k in enumerate([*range(5000), *range(100)])] and not calls
