"""Declared SQL types: their family, length and Spark type."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: fixed values: the declared types of each database and the cleaner that each goes to
FAMILIES = {
    "mssql": {
        "string": ("char", "varchar", "text", "nchar", "nvarchar", "ntext"),
        "int": ("tinyint", "smallint", "int", "bigint"),
        "numeric": ("numeric", "decimal", "float", "real"),
        "money": ("money", "smallmoney"),
        "bit": ("bit",),
        "date": ("date",),
        "datetime": ("datetime",),
        "time": ("time",),
        "binary": ("binary", "varbinary"),
        "image": ("image",),
    }
}
SPARK = {"string": "string", "int": "bigint", "numeric": "double", "money": "double", "bit": "boolean", "date": "timestamp_ntz", "datetime": "timestamp_ntz", "time": "timestamp_ntz", "binary": "binary", "image": "binary"}


@dataclass(frozen=True)
class SqlType:
    name: str
    family: str | None
    length: int | None

    @property
    def spark(self) -> str:
        return SPARK[self.family or "string"]

    @property
    def numeric(self) -> bool:
        return self.family in ("int", "numeric", "money")

    @property
    def temporal(self) -> bool:
        return self.family in ("date", "datetime")

    @property
    def needs_length(self) -> bool:
        return self.name in ("char", "varchar", "nchar", "nvarchar")

    @property
    def in_bytes(self) -> bool:
        return self.name in ("char", "varchar")


def parse_type(text: str, database: str = "mssql") -> SqlType:
    """`name` or `name(args)`; family is None for a name the database does not have."""
    name, _, args = text.strip().lower().partition("(")
    name = name.strip()
    found = re.match(r"\s*(\d+)", args)
    family = next((k for k, names in FAMILIES.get(database, {}).items() if name in names), None)
    return SqlType(name, family, int(found[1]) if found else None)
