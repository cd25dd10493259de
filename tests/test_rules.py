"""Vectors of the validation rules and relations."""

import datetime as dt

import pytest

from cleanloom.operators import rules
from cleanloom.operators.relations import mark_duplicates, mark_orphans, orphans
from cleanloom.types import parse_type

RUN = dt.date(2026, 2, 1)


def test_null_and_empty(column):
    values = ["left", "\t", None, "0"]
    assert column(values, lambda c: rules.null_allowed(c, False)) == [True, True, False, True]
    assert column(values, lambda c: rules.empty_allowed(c, False)) == [True, False, None, True]
    assert column(values, rules.null_allowed) == column(values, rules.empty_allowed) == [True] * 4


@pytest.mark.parametrize(
    ("kind", "fits"),
    [("varchar(3)", {"sea": True, "seas": False, "né": True, "née": False, "": True, None: True}), ("nvarchar(3)", {"née": True, "seas": False}), ("nchar(1)", {"é": True, "": True}), ("varchar", {"x": False}), ("int", {"seas": True}), ("ntext", {"seas" * 99: True})],
)
def test_length(column, kind, fits):
    """Bytes count for varchar, characters for nvarchar."""
    assert dict(zip(fits, column(list(fits), lambda c: rules.fits_length(c, parse_type(kind))), strict=True)) == fits


@pytest.mark.parametrize(
    ("name", "passes", "fails"),
    [
        ("person_name", ["Zoë", "Anne-Marie O'Hara", "van Wyk"], ["R2 D2", "Zoë ", "a  b", "-x", "Dr.", "Zoë\n", "", None]),
        ("product_name", ["Zoë", "USB-C 3.1", "Bolt(s) 5+5 1/2", "A'B"], ["50%", "a  b", "x_y", "x\n", "", None]),
        ("E.164", ["+15550199", "+270215550199123"], ["15550199", "+1555019", "+2702155501991234", "+27 21 555 0199", "", None]),
        ("email", ["z@a.co", "first.last+tag@mail.example.org"], ["z@a", "@a.co", "z@@a.co", "z a@a.co", " z@a.co", "", None]),
    ],
)
def test_formats(column, name, passes, fails):
    assert column(passes, lambda c: rules.has_format(c, name)) == [True] * len(passes)
    assert column(fails, lambda c: rules.has_format(c, name)) == [False] * len(fails)
    assert column([None], lambda c: rules.has_format(c, name, null_passes=True)) == [True]


def test_strict_addresses(column):
    passes = ["z@a.co", "  z@a.co ", "o'hara@a.co", "q#1@sub.a.co", "é@a.co"]
    fails = ["z.@a.co", ".z@a.co", "z..y@a.co", "z@-a.co", "z@a", "z" * 65 + "@a.co", "", None]
    assert column(passes, lambda c: rules.is_email(c, strict=True)) == [True] * len(passes)
    assert column(fails, lambda c: rules.is_email(c, strict=True)) == [False] * len(fails)


def test_addresses_by_their_encoded_domain(column):
    passes = ["z@münchen.example.org", "z@пример.org", "é" * 32 + "@a.co", f"z@{'ü' * 40}.org", "z@xn--mnchen-3ya.org", "z@" + ".".join(["a" * 60] * 4) + ".co"]
    fails = [f"z@{'ü' * 60}.org", "é" * 33 + "@a.co", "z@a.test", "z@host.LOCAL", "z@a.invalid", "z@" + ".".join(["a" * 62] * 4) + ".co", '"z y"@a.co', "z@[10.0.0.1]", "z@a..co", "z@ü-.org"]
    assert column(passes, lambda c: rules.is_email(c, strict=True)) == [True] * len(passes)
    assert column(fails, lambda c: rules.is_email(c, strict=True)) == [False] * len(fails)


def test_ranges(column):
    inside = lambda values, low, high, null: column(values, lambda c: rules.in_range(c.try_cast("double"), low, high, null))
    assert inside(["2.9", "3", "7.5", "8", "8.01"], 3, 8, True) == [False, True, True, True, False]
    assert inside(["-1e9", "1e9"], None, None, True) == [True, True]
    assert inside(["-5", "5"], None, 0, True) == [True, False]
    assert inside([None, "4"], 3, 8, False) == [False, True] and inside([None], 3, 8, True) == [True]
    dated = lambda values, low, high, null: column(values, lambda c: rules.in_date_range(c.try_cast("timestamp_ntz"), low, high, null, RUN))
    assert dated(["2026-02-01", "2026-02-02", "1999-12-31", None], "2000-01-01", "today", True) == [True, False, False, True]
    assert dated(["2026-02-02", None], "today", None, False) == [True, False]


def test_duplicates_exempt_null(spark):
    df = spark.createDataFrame([(1, "k"), (2, None), (3, "k"), (4, "K"), (5, None), (6, "2"), (7, "2.0")], "i int, k string")
    assert {r["i"] for r in mark_duplicates(df, "k", "again").where("again").collect()} == {1, 3}


def test_orphans(spark):
    child = spark.createDataFrame([(1, "p"), (2, "q"), (3, None), (4, "\t"), (5, "p")], "i int, k string")
    parent = spark.createDataFrame([("p",), (None,), ("p",)], "p string")
    found = lambda nullable: {r["i"] for r in mark_orphans(child, "k", parent, "p", "orphan", nullable).where("orphan").collect()}
    assert found(True) == {2} and found(False) == {2, 3, 4}
    assert mark_orphans(child, "k", parent, "p", "orphan").count() == 5
    assert {r["i"] for r in orphans(child, "k", parent, "p").collect()} == {2}
    assert {r["i"] for r in mark_orphans(child, "i", spark.createDataFrame([(2,)], "p long"), "p", "orphan").where("orphan").collect()} == {1, 3, 4, 5}
