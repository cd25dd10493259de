"""Casts from text, by declared type: a bad value becomes null. JVM-side columns only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import cased, strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITY = r"(?i)^[+-]?inf(inity)?$"
#: fixed values: how the picture formats JPEG, PNG, GIF and BMP begin, in hex
PICTURES = ("FFD8FF", "89504E470D0A1A0A", "47494638", "424D")


def to_str(c: Column, case: str | None = None) -> Column:
    text = cased(strip(c), case)
    return F.when(~text.isin("", "nan"), text)


def to_numeric(c: Column) -> Column:
    text = strip(c)
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))  # a cast that fails costs an exception
    # beyond the range of a double is bad, not infinite
    return F.when(F.abs(value) != float("inf"), value).when(text.rlike(INFINITY), F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))


def to_int(c: Column) -> Column:
    """Whole numbers in full precision; fractions are cut towards zero; what is beyond 64 bits is bad."""
    text = strip(c)
    value = text.try_cast("double")
    rough = F.when(F.abs(value) < 2.0**63, value.try_cast("bigint"))  # 2**63 itself, as a double, would become the largest number
    return F.when(text.rlike(NUMBER), F.coalesce(F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")), rough))


def to_money(c: Column, symbol: str = "") -> Column:
    """A number after one currency symbol, a literal prefix."""
    text = strip(c)
    if symbol:
        text = F.when(text.startswith(symbol), F.substr(text, F.lit(len(symbol) + 1))).otherwise(text)
    return to_numeric(text)


def to_bit(c: Column) -> Column:
    return F.lower(strip(c)).isin("true", "yes", "1")


def _hex(c: Column) -> Column:
    """Bytes of hex text; white space may stand between bytes only."""
    return F.when(c.rlike(r"^\s*([0-9A-Fa-f]{2}\s*)*$"), F.try_to_binary(F.regexp_replace(c, r"\s", ""), F.lit("hex")))


def to_binary(c: Column) -> Column:
    return F.when(~strip(c).isin("", "nan"), _hex(c))


def to_image(c: Column) -> Column:
    """Bytes of hex or base64 text that begin as a picture does; what is hex is not tried as base64."""
    base64 = F.when(c.rlike(r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"), F.try_to_binary(c, F.lit("base64")))
    data = F.coalesce(to_binary(c), F.when(~strip(c).isin("", "nan"), base64))
    start = F.hex(F.substring(data, 1, 8))
    is_picture = start.startswith(PICTURES[0])
    for magic in PICTURES[1:]:
        is_picture = is_picture | start.startswith(magic)
    return F.when(is_picture, data)
