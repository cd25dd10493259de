"""Workbooks, text tables, ordinals and sinks."""

import datetime as dt
import logging

import pytest

from cleanloom.errors import ExtractorError, LoaderError
from cleanloom.logs import get_logger, shutdown
from cleanloom.plans.table import ROW
from cleanloom.sources.sinks import load, write_csv
from cleanloom.sources.spreadsheet import read_sheet, write_workbook
from cleanloom.sources.tables import read_csv, with_ordinal

from .test_plan import config


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a <&> b", 1.5, True), (2, None, 2.0, False), (3, " é ", None, None)], "k int, `full name` string, x double, y boolean")
    path = str(tmp_path / "book.xlsx")
    write_workbook({"First": df.coalesce(1), "second sheet": df.limit(0)}, path)
    back = read_sheet(spark, path, "First")
    assert back.columns == [ROW, "k", "full name", "x", "y"]
    assert [tuple(r) for r in back.orderBy(ROW).collect()] == [(0, "1", "a <&> b", "1.5", "True"), (1, "2", None, "2", "False"), (2, "3", " é ", None, None)]
    assert read_sheet(spark, path, "second sheet").count() == 0
    assert read_sheet(spark, path, "First", 0).columns == [ROW, "0", "1", "2", "3"]
    with pytest.raises(ExtractorError, match="First"):
        read_sheet(spark, path, "none")
    (tmp_path / "no.xlsx").write_bytes(b"no")
    with pytest.raises(ExtractorError):
        read_sheet(spark, str(tmp_path / "no.xlsx"), "First")


def test_sheet_names_are_cut(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(LoaderError):
        write_workbook({"x" * 32: df, "x" * 33: df}, str(tmp_path / "b.xlsx"))


def test_ordinals_have_no_gaps(spark, tmp_path):
    df = spark.range(1000).repartition(7)
    assert sorted(r[ROW] for r in with_ordinal(df).collect()) == list(range(1000))
    ordered = with_ordinal(spark.range(1000, 0, -1).repartition(7), ["id"])
    assert all(r["id"] == r[ROW] + 1 for r in ordered.collect())
    assert with_ordinal(spark.range(0)).count() == 0


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,\n')
    got = read_csv(spark, str(tmp_path / "t.csv"), multi_line=True)
    assert [(r[ROW], r["a"], r["b"]) for r in got.orderBy(ROW).collect()] == [(0, "1", "x\ny"), (1, "2", None)]
    assert read_csv(spark, str(tmp_path / "t.csv"), 0, multi_line=True).drop(ROW).columns == ["0", "1"]


def test_sinks(spark, tmp_path, caplog):
    df = spark.createDataFrame([(1.0, dt.datetime(2020, 1, 2), b"\x01", None)], "x double, at timestamp_ntz, b binary, n string")
    out = load({"t": df}, ["csv", "parquet", "excel", "sql"], str(tmp_path), config(), one_file=True)
    assert out["csv"] == ["t"] and out["excel"].endswith("book_cleaned.xlsx")
    assert tuple(spark.read.option("header", True).csv(f"{tmp_path}/csv/t").first()) == ("1", "2020-01-02", "01", None)
    assert spark.read.parquet(f"{tmp_path}/parquet/t").count() == 1
    with pytest.raises(LoaderError):
        load({"t": df}, ["json"], str(tmp_path), config())
    bad = spark.createDataFrame([({"k": 1},)], "m map<string,int>")
    with caplog.at_level(logging.ERROR):
        assert write_csv({"bad": bad, "good": df}, f"{tmp_path}/two") == ["good"]


def test_logs_are_pruned(tmp_path):
    for _ in range(4):
        get_logger("x", tmp_path, most=2).info("said")
        shutdown()
    assert len(list(tmp_path.glob("x-*.log"))) == 2
