"""The declarative configuration: loading, checking, and the frozen settings of a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from .errors import ConfigError, SchemaError
from .types import FAMILIES, SqlType, parse_type

#: fixed values: the sections that a configuration must have, and the fields of each
SECTIONS = ("runtime", "source", "target", "cleaning", "mappings", "columns")
FIELDS = {
    "source": ("type", "file", "header_row"),
    "target": ("db_type", "driver", "server", "database", "authentication", "schema"),
    "authentication": ("type",),
    "cleaning": ("trim_whitespace", "standardise_nulls", "remove_blank_rows"),
    "mapping": ("sheet_name", "target_table"),
    "column": ("source_column", "data_type", "allow_null"),
}


def truthy(value: Any) -> bool:
    return value.strip().lower() in ("true", "yes", "1") if isinstance(value, str) else bool(value)


def lower_keys(value: Any) -> Any:
    """Keys in lower case at every depth of mappings; lists are left as they are."""
    return {str(k).lower(): lower_keys(v) for k, v in value.items()} if isinstance(value, Mapping) else value


@dataclass(frozen=True)
class Validation:
    on_error: str = "fail"
    format: str | None = None
    min_value: Any = None
    max_value: Any = None
    allow_local: bool = False
    dialling_prefix: str = ""
    formula: str | None = None
    depends_on: tuple[str, ...] = ()
    check_deliverability: bool = False


@dataclass(frozen=True)
class ColumnConfig:
    name: str
    sources: tuple[str, ...]
    type: SqlType
    allow_null: bool = True
    required: bool = False
    primary_key: bool = False
    case: str | None = None
    foreign_key: tuple[str, str] | None = None
    value_mapping: Mapping[str, list] | None = None
    validation: Validation | None = None

    @property
    def must_have_value(self) -> bool:
        return self.primary_key or not self.allow_null


@dataclass(frozen=True)
class Settings:
    """What a run is given beside its tables."""

    project: str = ""
    currency: str = ""
    strict: bool = True
    day_first: bool = True
    least_year: int = 1900
    languages: tuple[str, ...] = ("en", "af")
    header_row: int = 1
    trim: bool = True
    standardise_nulls: bool = True
    remove_blank_rows: bool = True
    run_date: dt.date = field(default_factory=dt.date.today)
    suffix: str = "_cleaned"
    check_all: bool = False
    null_passes_format: bool = False

    @property
    def row_offset(self) -> int:
        return 1 + self.header_row


@dataclass(frozen=True)
class Config:
    settings: Settings
    tables: Mapping[str, Mapping[str, ColumnConfig]]
    sheets: Mapping[str, str]
    targets: Mapping[str, str]
    source: Mapping[str, Any]
    target: Mapping[str, Any]


def read_yaml(path: str | Path) -> dict[str, Any]:
    try:
        with open(path, encoding="utf-8") as f:
            data = yaml.safe_load(f)
    except OSError as e:
        raise ConfigError(f"Cannot read the configuration {path}: {e.strerror}") from e
    except yaml.YAMLError as e:
        raise ConfigError(f"The configuration {path} is not YAML: {e}") from e
    if not isinstance(data, Mapping):
        raise ConfigError(f"The configuration {path} is empty or no mapping")
    return dict(data)


def load_project_config(path: str | Path) -> dict[str, Any]:
    return read_yaml(path)


def load_config(path: str | Path, **options: Any) -> Config:
    return parse_config(read_yaml(path), **options)


def problems(raw: Mapping[str, Any]) -> list[str]:
    """All that is wrong with a configuration whose keys are in lower case."""
    found: list[str] = []

    def lacks(section: Mapping[str, Any] | None, kind: str, at: str) -> None:
        found.extend(f"{at}: {f} is missing" for f in FIELDS[kind] if (section or {}).get(f) is None)

    for name in SECTIONS:
        if raw.get(name) is None:
            found.append(f"Section {name} is missing")
    if source := raw.get("source"):
        lacks(source, "source", "source")
        row = source.get("header_row")
        if row is not None and (not isinstance(row, int) or row < 0):
            found.append("source: header_row must be 0 (no header) or positive")
    database = None
    if target := raw.get("target"):
        lacks(target, "target", "target")
        if target.get("authentication") is not None:
            lacks(target["authentication"], "authentication", "target.authentication")
        database = target.get("db_type")
        if database is not None and database not in FAMILIES:
            found.append(f"target: db_type {database} is unknown")
    if raw.get("cleaning"):
        lacks(raw["cleaning"], "cleaning", "cleaning")
    columns, mappings = raw.get("columns") or {}, raw.get("mappings") or {}
    for name, mapping in mappings.items():
        lacks(mapping, "mapping", f"mappings.{name}")
        if columns and name not in columns:
            found.append(f"mappings.{name}: the table has no columns")
    for table, cols in columns.items():
        if mappings and table not in mappings and any((c or {}).get("foreign_key") for c in cols.values()):
            found.append(f"columns.{table}: the table has a foreign key but no mapping")
        for name, c in cols.items():
            found.extend(_column_problems(f"{table}.{name}", c or {}, cols, columns, database))
            lacks(c, "column", f"{table}.{name}")
        if not any(truthy((c or {}).get("primary_key", False)) for c in cols.values()):
            found.append(f"{table}: no primary key")
    return found


def _column_problems(at: str, c: Mapping[str, Any], siblings: Mapping, columns: Mapping, database: str | None) -> list[str]:
    found = []
    kind = parse_type(c["data_type"], database) if c.get("data_type") and database in FAMILIES else None
    if kind and kind.family is None:
        found.append(f"{at}: {database} has no data type {c['data_type']}")
    if kind and kind.needs_length and not kind.length:
        found.append(f"{at}: {c['data_type']} needs a length above 0")
    for label, raws in (c.get("value_mapping") or {}).items():
        if raws is None:
            found.append(f"{at}: value mapping {label} has no values")
    v = c.get("validation") or {}
    if v.get("format") == "E.164" and truthy(v.get("allow_local", False)):
        prefix = v.get("dialling_prefix")
        if prefix is None or not str(prefix).startswith("+"):
            found.append(f"{at}: local numbers need a dialling prefix that starts with +")
    if (d := v.get("derived_from")) is not None:
        if d.get("formula") is None or d.get("depends_on") is None:
            found.append(f"{at}: a derived column needs formula and depends_on")
        found.extend(f"{at}: {x}, which its formula depends on, is missing" for x in d.get("depends_on") or () if x.lower() not in siblings)
    if (key := c.get("foreign_key")) is not None:
        table, dot, column = str(key).strip().lower().partition(".")
        if not dot:
            found.append(f"{at}: the foreign key {key} is not table.column")
        elif table not in columns:
            found.append(f"{at}: the foreign key's table {table} does not exist")
        elif column not in columns[table]:
            found.append(f"{at}: the foreign key's column {column} does not exist in {table}")
    return found


def warnings(config: Config) -> list[str]:
    """What is allowed but odd: dates without both bounds, addresses whose delivery is asked for, which needs a network and is not checked."""
    undelivered = [f"{t}.{c.name}: check_deliverability is not done; addresses are checked by their form" for t, cols in config.tables.items() for c in cols.values() if c.validation and c.validation.check_deliverability]
    return undelivered + [f"{t}.{c.name}: {c.type.name} without both min_value and max_value" for t, cols in config.tables.items() for c in cols.values() if c.type.temporal and c.validation and (c.validation.min_value is None or c.validation.max_value is None)]


def parse_config(raw: Mapping[str, Any], **options: Any) -> Config:
    """Checks everything, then raises one SchemaError that lists all problems. options override settings."""
    raw = lower_keys(raw)
    if found := problems(raw):
        raise SchemaError("The configuration has problems:\n" + "\n".join(f"- {x}" for x in found))
    runtime, cleaning = raw["runtime"], raw["cleaning"]
    settings = Settings(
        project=str(runtime.get("project_name", "")),
        currency=str(runtime.get("currency_symbol") or ""),
        strict=truthy(runtime.get("strict_validation", True)),
        day_first=truthy(runtime.get("day_first_format", True)),
        header_row=raw["source"]["header_row"],
        trim=truthy(cleaning["trim_whitespace"]),
        standardise_nulls=truthy(cleaning["standardise_nulls"]),
        remove_blank_rows=truthy(cleaning["remove_blank_rows"]),
    )
    settings = Settings(**(vars(settings) | options))
    tables = {t: {n: _column(n, c, raw["target"]["db_type"]) for n, c in cols.items()} for t, cols in raw["columns"].items()}
    return Config(settings, tables, {k: m["sheet_name"] for k, m in raw["mappings"].items()}, {k: m["target_table"] for k, m in raw["mappings"].items()}, raw["source"], raw["target"])


def _column(name: str, c: Mapping[str, Any], database: str) -> ColumnConfig:
    sources, v, key = c["source_column"], c.get("validation"), c.get("foreign_key")
    validation = None
    if v is not None:
        d = v.get("derived_from") or {}
        depends = tuple(x.lower() for x in d.get("depends_on") or ())
        validation = Validation(str(v.get("on_error", "fail")).lower(), v.get("format"), v.get("min_value"), v.get("max_value"), truthy(v.get("allow_local", False)), str(v.get("dialling_prefix") or ""), d.get("formula"), depends, truthy(v.get("check_deliverability", False)))
    parent = str(key).strip().lower().partition(".") if key is not None else None
    return ColumnConfig(
        name,
        tuple(map(str, sources)) if isinstance(sources, list) else (str(sources),),
        parse_type(c["data_type"], database),
        truthy(c["allow_null"]),
        truthy(c.get("required", False)),
        truthy(c.get("primary_key", False)),
        c.get("case"),
        (parent[0], parent[2]) if parent else None,
        c.get("value_mapping"),
        validation,
    )


def config_date(value: Any, run_date: dt.date) -> dt.datetime | None:
    """A date of the configuration: a date, a text, `today`, or none."""
    if value is None or isinstance(value, str) and not value.strip():
        return None
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    if text.lower() == "today":
        return dt.datetime(run_date.year, run_date.month, run_date.day)
    try:
        return dt.datetime.fromisoformat(text)
    except ValueError as e:
        raise SchemaError(f"{value!r} is not a date") from e
