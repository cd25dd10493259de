"""String expressions: JVM-side columns only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: what a spreadsheet reader takes for a missing cell, and what cleaning takes for null
NA_CELLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
NULL_WORDS = ("NA", "N/A", "NULL", "None")

#: fixed values: white space of any script
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.btrim(c, F.lit(SPACES))


def null_if(c: Column, values: Iterable[str]) -> Column:
    return F.when(~c.isin(*values), c)


def title(c: Column) -> Column:
    """Every letter after a non-letter in upper case, all others in lower case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def cased(c: Column, case: str | None) -> Column:
    return {"lower": F.lower, "upper": F.upper, "title": title}.get(case or "asis", lambda x: x)(c)


def blank(c: Column) -> Column:
    return strip(c) == ""


def map_values(c: Column, mapping: Mapping[str, Iterable[str]]) -> Column:
    """mapping: canonical label -> raw values. What no label names, and null, becomes null."""
    pairs = {str(raw).strip().lower(): label for label, raws in mapping.items() for raw in raws}
    if not pairs:
        return F.lit(None).cast("string")
    lookup = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return F.try_element_at(lookup, F.lower(strip(c)))


def phone_e164(c: Column, allow_local: bool = False, dialling_code: str = "") -> Column:
    """Digits and a leading +; 00 counts as +; local numbers lose a leading 0 and gain the dialling code."""
    digits = F.regexp_replace(c, r"(?!^\+)[^\d]", "")
    digits = F.regexp_replace(digits, r"^00", "+")
    if not allow_local:
        return digits
    return F.when(digits.startswith("+"), digits).otherwise(F.concat(F.lit(dialling_code), F.regexp_replace(digits, r"^0", "")))
