"""Dates and times from text in many shapes, as zone-less timestamps. JVM-side columns only.

Text is brought into one shape by a few replacements, one pattern cuts it into the three parts of a date and its time, and the parts are
read as numbers or month names; no formatter runs. Each step is a projection of its own over the columns of the step before it: what is
used often is computed once, and all of it is generated code. With day_first, a date of three numbers with the year first is read
as year-day-month where that is a date, as year-month-day otherwise.

Beside numbers, dates may have month names (whole, or their first three letters, with a dot or without), names of weekdays before them, ordinals (13th)
and "of"; times may be 10:30, 10:30:15.5, 10h30, 10h, 10 pm; names of zones after a time are passed over, offsets are taken off.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .strings import strip

#: fixed values: month names by language
MONTHS = {
    "en": "january february march april may june july august september october november december".split(),
    "af": "januarie februarie maart april mei junie julie augustus september oktober november desember".split(),
}
MARK = "\u0001"
DAY_NAME = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.? )?"
PART = r"([+]?\d{1,9}|[a-z]{3,10})(?:st|nd|rd|th)?\.?"
CLOCK = r"(\d{1,2}):(\d{1,2})(?::(\d{1,2})(\.\d+)?)? ?(am|pm)?"
ZONE = r"(?: ?(z|[a-z]{2,5}|[+-]\d{2}:?\d{2}))?"
DATE = rf"^{DAY_NAME}{PART}[/\- ]+(?:of )?{PART}[/\- ]+([+]?\d{{1,9}})(?:st|nd|rd|th)?(?: {CLOCK}{ZONE})?$"
#: what a date's parts are called, in the order of the pattern
PARTS = ("a", "b", "c", "hour", "minute", "second", "fraction", "half", "zone")


@dataclass(frozen=True)
class Dates:
    """How dates are read: which of two numbers is the day, the first year of dates that are all numbers, whose month names."""

    day_first: bool = True
    least_year: int = 1900
    languages: tuple[str, ...] = ("en", "af")

    def months(self) -> Column:
        known = {k: n for x in self.languages for n, name in enumerate(MONTHS[x], 1) for k in (name, name[:3])}
        known |= {"sept": 9} | ({"mrt": 3} if "af" in self.languages else {})
        return F.create_map(*(F.lit(x) for pair in known.items() for x in pair))


def normalise(c: Column) -> Column:
    """Lower case, single blanks; commas, and a T between digits, are blanks."""
    bare = F.translate(c, f",{MARK}", "  ")
    return F.lower(strip(F.regexp_replace(F.regexp_replace(bare, r"(?<=\d)T(?=\d)", " "), r"\s+", " ")))


def _plain_times(text: Column) -> Column:
    """10h30, 10h and 10 pm as 10:30, 10:00 and 10:00 pm; a year after the time goes before it."""
    for pattern, to in ((r"\b(\d{1,2})h(\d{2})\b", "$1:$2"), (r" (\d{1,2})h$", " $1:00"), (r" (\d{1,2}) ?(am|pm)$", " $1:00 $2"), (r"^(.*) (\d{1,2}:[\d:.]+)( [a-z]{2,5})? (\d{4})$", "$1 $4 $2")):
        text = F.regexp_replace(text, pattern, to)
    return text


class _Steps:
    """Columns of one text in the making: each step adds some, named after the result, to those of the steps before it."""

    def __init__(self, df: DataFrame, names: list[str]):
        self.df, self.names, self.added = df, names, []

    def add(self, made) -> None:
        """made: from a result's name to its new columns, by their short names."""
        new = {f"{n}\u0002{k}": c for n in self.names for k, c in made(n).items()}
        self.df = self.df.select("*", *(c.alias(k) for k, c in new.items()))
        self.added += new

    def of(self, name: str, *keys: str) -> list[Column]:
        return [F.col(f"`{name}\u0002{k}`") for k in keys]


def _clock(hour: Column, minute: Column, second: Column, half: Column) -> tuple[Column, Column]:
    """(whether it is a time, its hour of the day)"""
    plain = half == ""
    ok = (minute < 60) & (second < 60) & F.when(plain, hour < 24).otherwise(hour.between(1, 12))
    return F.coalesce(ok, F.lit(False)), F.when(plain, hour).otherwise(hour % 12 + F.when(half == "pm", 12).otherwise(0))


def _cut(text: Column, pattern: str, n: int) -> Column:
    return F.split(F.regexp_replace(text, pattern, MARK.join(f"${k + 1}" for k in range(n))), MARK, -1)


def _whole(part: Column, ok: Column) -> Column:
    """The number of a part that is digits; a part is digits or letters, and letters come after them."""
    return F.when(ok & (part < ":") & (part != ""), part.cast("int"))


def with_dates(df: DataFrame, wanted: Mapping[str, tuple[str, str]], dates: Dates = Dates(), *, closed: bool = False) -> DataFrame:  # noqa: B008
    """df with a column more for each of wanted: name -> (text column, kind). Kinds: date (midnight of it; a time beside it must be one),
    datetime (an offset is taken off, so it is in UTC), time (the time of day on 1900-01-01, without fractions of a second). What is
    none is null.

    closed: no later filter is moved in front of the steps. Spark would write a filter on a result out in terms of the first
    step's input, with every step repeated wherever a later one uses it."""
    kinds = {n: k for n, (_, k) in wanted.items()}
    steps = _Steps(df, list(wanted))
    steps.add(lambda n: {"text": normalise(F.col(f"`{wanted[n][0]}`").cast("string"))})

    def plain(n: str) -> dict[str, Column]:
        (text,) = steps.of(n, "text")
        return {"plain": F.when(text.rlike("[a-z]"), _plain_times(text)).otherwise(text) if kinds[n] != "time" else text}

    def cut(n: str) -> dict[str, Column]:
        (text,) = steps.of(n, "plain")
        return {"parts": _cut(text, f"^{CLOCK}$", 5) if kinds[n] == "time" else _cut(text, DATE, len(PARTS))}

    def named(n: str) -> dict[str, Column]:
        (parts,) = steps.of(n, "parts")
        names = PARTS[3:8] if kinds[n] == "time" else PARTS
        ok = F.size(parts) == len(names)
        part = {k: F.get(parts, F.lit(i)) for i, k in enumerate(names)}
        out = {k: _whole(part[k], ok) for k in ("hour", "minute")} | {"second": F.coalesce(_whole(part["second"], ok), F.lit(0)), "half": F.when(ok, part["half"])}
        out |= {"fraction": F.when(ok & (part["fraction"] != ""), part["fraction"].cast("double")).otherwise(0.0)} if kinds[n] == "datetime" else {"fraction": F.lit(0.0)}
        if kinds[n] == "time":
            return out
        years = {"long_a": F.length(part["a"]) == 4, "len_c": F.length(part["c"])}
        month = {f"month_{k}": F.when(ok & (part[k] > ":"), F.try_element_at(dates.months(), part[k])) for k in ("a", "b")}
        return out | years | month | {k: _whole(part[k], ok) for k in ("a", "b", "c")} | {"timed": ok & (part["hour"] != ""), "zone": F.when(ok, part["zone"])}

    def chosen(n: str) -> dict[str, Column]:
        """One year, month and day, which may still be no date of the calendar."""
        if kinds[n] == "time":
            return {}
        a, b, c, ma, mb, timed, long_a, len_c = steps.of(n, "a", "b", "c", "month_a", "month_b", "timed", "long_a", "len_c")
        year_last = F.when(len_c == 4, c).when(len_c == 2, c + F.when(c < 69, 2000).otherwise(1900))
        named = ma.isNotNull() | mb.isNotNull()
        last = (b, a) if dates.day_first else (a, b)
        # of two numbers the preferred month and the preferred day; they change places where the month would be over 12
        month, day = (F.when(long_a, x).otherwise(y) for x, y in zip((c, b) if dates.day_first else (b, c), last, strict=True))
        # without a time, dates of numbers only must have a month where it is written, and a year that is late enough
        where, year = F.when(long_a, b).otherwise(last[0]), F.when(long_a, a).otherwise(c)
        ok = timed | ((where <= 12) & (year >= dates.least_year))
        return {
            "y": F.when(long_a & ma.isNull(), a).otherwise(year_last),
            "m": F.when(named, F.coalesce(mb, ma)).when(ok, F.when(month > 12, day).otherwise(month)),
            "d": F.when(named, F.when(mb.isNull(), b).when(long_a, c).otherwise(a)).when(month > 12, month).otherwise(day),
        }

    for step in (plain, cut, named, chosen):
        steps.add(step)

    def result(n: str) -> Column:
        hour, minute, second, fraction, half = steps.of(n, "hour", "minute", "second", "fraction", "half")
        ok, of_day = _clock(hour, minute, second, half)
        if kinds[n] == "time":
            return F.when(ok, F.make_timestamp_ntz(F.lit(1900), F.lit(1), F.lit(1), of_day, minute, second.cast("double")))
        y, m, d, timed, zone = steps.of(n, "y", "m", "d", "timed", "zone")
        # what is out of range is seen first, for a failing constructor costs an exception; what is left fails for the ends of short months only
        likely = (m <= 12) & (d <= 31) & (m > 0) & (d > 0) & (y > 0) & (~timed | ok)
        if kinds[n] == "date":
            return F.when(likely, F.try_make_timestamp_ntz(y, m, d, F.lit(0), F.lit(0), F.lit(0.0)))
        zero = lambda c, none: F.when(timed, c).otherwise(F.lit(none))
        at = F.try_make_timestamp_ntz(y, m, d, zero(of_day, 0), zero(minute, 0), zero(second + fraction, 0.0))
        # an offset is of 14 hours at most; what is written like a longer one is none, nor a date
        likely = likely & ~F.coalesce(F.abs(_offset(zone)) > 14 * 60, F.lit(False)) & ~F.coalesce(zone.rlike(r"^[+-].*[6-9]\d$"), F.lit(False))
        return F.when(likely, F.when(zone.rlike(r"^[+-]"), at - F.make_dt_interval(mins=_offset(zone))).otherwise(at))

    # a filter does not pass a projection with an indeterminate expression, as the number of the partition is one
    last = (lambda c: F.when(F.spark_partition_id() >= 0, c)) if closed else (lambda c: c)
    return steps.df.select(*(f"`{c}`" for c in df.columns), *(last(result(n)).alias(n) for n in wanted))


def _offset(zone: Column) -> Column:
    minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, -2, 2).try_cast("int")
    return F.when(zone.startswith("-"), -minutes).when(zone.startswith("+"), minutes)
