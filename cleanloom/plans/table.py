"""The plan of one table: from text cells to cleaned, transformed and validated columns.

Everything is one lazy plan. Beside the raw and cleaned columns it carries, until the end, what each stage held
(hidden columns that Catalyst prunes where nobody asks for them), so null counts of all stages take one pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..config import ColumnConfig, Settings
from ..errors import CleanerError, ExtractorError, ValidatorError, Where
from ..functions import cleaners
from ..functions.datetimes import Dates, with_dates
from ..functions.formula import FAMILY_KINDS, derived
from ..functions.strings import NA_CELLS, NULL_WORDS, map_values, null_if, phone_e164, strip
from ..operators import dictionary
from ..operators.audit import changes, null_counts, null_pivot
from ..operators.dictionary import apply_dictionary, entries
from ..operators.relations import mark_duplicates, orphans
from ..operators.row_runs import KEYS, first_rows, row_runs
from ..operators.rules import Rule, column_rules, severity

ROW = "__row"


def cast(c: Column, config: ColumnConfig, s: Settings) -> Column:
    match config.type.family:
        case "int":
            return cleaners.to_int(c)
        case "numeric":
            return cleaners.to_numeric(c)
        case "money":
            return cleaners.to_money(c, s.currency)
        case "bit":
            return cleaners.to_bit(c)
        case "binary":
            return cleaners.to_binary(c)
        case "image":
            return cleaners.to_image(c)
    return cleaners.to_str(c, config.case)


def extract(df: DataFrame, table: str, columns: Mapping[str, ColumnConfig], s: Settings, row: str = ROW) -> DataFrame:
    """Text columns under their SQL names; cells that mean missing are null; columns that are not there are null.
    Columns that nobody declared raise in strict mode, and stay otherwise."""
    data = [c for c in df.columns if c != row]
    names, taken = {}, set()
    for name, c in columns.items():
        if found := next((x for x in c.sources if x in data), None):
            names[found] = name
            taken.add(found)
    extra = [c for c in data if c not in taken]
    if extra and s.strict:
        raise ExtractorError("Unexpected columns", Where(table, details={"columns": extra}))
    missing = [c for c in columns if c not in names.values()]
    cell = lambda c: null_if(df[c].cast("string"), NA_CELLS).alias(names.get(c, c))
    return df.select(F.col(row).alias(ROW), *map(cell, data), *(F.lit(None).cast("string").alias(c) for c in missing))


@dataclass
class Observed:
    """Counts of a table's plan that came with its first action. They can be asked for when that has ended."""

    plan: TablePlan
    asked: list[tuple[str, str]]
    observation: Observation = field(default_factory=Observation)

    @property
    def counts(self) -> dict[str, int]:
        return self.observation.get

    def null_stats(self) -> list[tuple[str, str, int]]:
        """(column, stage, nulls), as TablePlan.null_stats has them."""
        return [(c, s, self.counts[f"n{k}"]) for k, (s, c) in enumerate(self.asked)]

    def severities(self) -> dict[str, int]:
        """As TablePlan.severity_counts has them: cells for warn and fail, rows for drop; columns that are missing count as a cell, without a row."""
        out = {k: self.counts[k] for k in ("warn", "fail", "drop")}
        for c in self.plan.missing_severities():
            out[c] = out[c] + 1 if c != "drop" else out[c]
        return {k: n for k, n in out.items() if n}


@dataclass
class TablePlan:
    name: str
    columns: Mapping[str, ColumnConfig]
    settings: Settings
    #: all rows and columns, hidden ones too
    df: DataFrame
    raw: list[str]
    rules: list[Rule]
    missing: list[str]

    def cleaned(self, name: str) -> str:
        return f"{name}{self.settings.suffix}"

    @property
    def row_number(self) -> Column:
        return F.col(ROW) + self.settings.row_offset

    def rows(self) -> DataFrame:
        """The rows that stay."""
        return self.df.where("not __blank and not __dropped")

    def final(self, mode: str = "both") -> DataFrame:
        """both: raw and cleaned columns; clean: cleaned ones under the plain names (others as they were)."""
        if mode == "both":
            return self.rows().select(*self.raw, *(self.cleaned(c) for c in self.columns))
        return self.rows().select(*(F.col(self.cleaned(c)).alias(c) if c in self.columns else F.col(c) for c in self.raw))

    def issues(self) -> DataFrame:
        """table, column, row, severity, rule, message: a row for each cell that breaks a rule."""
        found = self.df.where("not __blank").select(F.explode("__issues").alias("i"))
        out = found.select(F.lit(self.name).alias("table"), "i.column", "i.row", "i.severity", "i.rule", "i.message")
        spark = self.df.sparkSession
        for c, level in self._missing().items():
            out = out.union(spark.createDataFrame([(self.name, c, None, level, "required", "no source column has this name")], out.schema))
        return out

    def _missing(self) -> dict[str, str]:
        """Columns that must be there and are not, with the severity of that."""
        lacking = [self.columns[c] for c in self.missing if self.columns[c].required or self.columns[c].primary_key]
        return {c.name: "fail" if c.must_have_value else severity(c.validation.on_error if c.validation else None) for c in lacking}

    def missing_severities(self) -> list[str]:
        return list(self._missing().values())

    def severity_counts(self) -> DataFrame:
        """severity, n: cells for warn and fail, rows for drop."""
        cells = self.issues().groupBy("severity").agg(F.count("*").alias("cells"), F.count_distinct("row").alias("rows"))
        return cells.select("severity", F.when(F.col("severity") == "drop", F.col("rows")).otherwise(F.col("cells")).alias("n"))

    def rows_to_drop(self) -> DataFrame:
        """row: numbers of the rows that a drop rule takes out, whichever rules they break."""
        return self.df.where("__dropped and not __blank").select(self.row_number.alias("row"))

    def duplicate_keys(self, most: int = 20) -> DataFrame:
        """column, value, n, first_rows: values of key columns that occur more than once, with their first rows."""
        out = None
        for c in self.columns.values():
            if c.primary_key:
                live = self.df.where(f"not __blank and `{c.name}` is not null").select(F.col(c.name).alias("value"), self.row_number.alias("row"))
                ranked = live.withColumn("rank", F.row_number().over(Window.partitionBy("value").orderBy("row"))).where(F.col("rank") <= most)
                first = ranked.groupBy("value").agg(F.array_sort(F.collect_list("row")).alias("first_rows"))
                counts = live.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
                found = counts.join(first, "value").select(F.lit(c.name).alias("column"), "value", "n", "first_rows")
                out = found if out is None else out.unionByName(found)
        return out

    def blank_rows(self) -> DataFrame:
        """How many rows had no value at all."""
        return self.df.agg(F.count_if("__blank").alias("blank_rows"), F.count("*").alias("all_rows"))

    def audit(self, base: str = "raw", stage: str = "final") -> DataFrame:
        """Changed values. base: raw (tidied, as it is in the output) or source (as it was read); stage: cleaned or final."""
        old = "{}" if base == "raw" else "__source_{}"
        new = "__pre_{}" if stage == "cleaned" else self.cleaned("{}")
        found = changes(self.df.where("not __blank"), {c: (old.format(c), new.format(c)) for c in self.columns}, self.row_number)
        return found.select(F.lit(self.name).alias("table"), "column", "row", "old", "new")

    def _stages(self) -> dict[str, dict[str, Column]]:
        """What each stage held, by column."""
        stays, kept = ~F.col("__blank"), ~F.col("__blank") & ~F.col("__dropped")
        of = lambda where, c: F.when(where, c.isNull()).otherwise(False)
        as_null = lambda flag: F.when(~flag, True)  # noqa: E731  count_if counts nulls, so a counted row must be null
        return {
            "LOADED": {c: F.col(f"__source_{c}") for c in self.raw},
            "CLEANED": {c: as_null(of(stays, F.col(f"__pre_{c}"))) for c in self.columns},
            "TRANSFORMED": {c: as_null(of(stays, F.col(self.cleaned(c)))) for c in self.columns},
            "VALIDATED": {c: as_null(of(kept, F.col(self.cleaned(c)))) for c in self.columns},
        }

    def null_stats(self) -> DataFrame:
        return null_counts(self.df, self._stages())

    def observed(self, mode: str = "both") -> tuple[DataFrame, Observed]:
        """final(mode), and what is counted on the way by whoever writes it (or runs any first action on it): no pass of its own."""
        seen = Observed(self, [(s, c) for s, columns in self._stages().items() for c in columns])
        nulls = [F.count_if(v.isNull()).alias(f"n{k}") for k, v in enumerate(v for columns in self._stages().values() for v in columns.values())]
        of = lambda level: F.size(F.filter("__issues", lambda i: i["severity"] == level))
        live = ~F.col("__blank")
        cells = [F.coalesce(F.sum(F.when(live, of(k))), F.lit(0)).alias(k) for k in ("warn", "fail")]
        counts = [F.count_if(live & (of("drop") > 0)).alias("drop"), F.count_if("__blank").alias("blank"), F.count(F.lit(1)).alias("all")]
        df = self.df.observe(seen.observation, *nulls, *cells, *counts)
        return replace(self, df=df).final(mode), seen

    def null_summary(self) -> DataFrame:
        return null_pivot(self.null_stats())

    def not_computable(self) -> DataFrame:
        """Rows whose derived columns lack a value they depend on: column, row."""
        found = []
        for c in self.columns.values():
            if c.validation and c.validation.formula:
                lacks = F.lit(False)
                for d in c.validation.depends_on:
                    lacks = lacks | F.col(f"__pre_{d}").isNull()
                found.append(F.when(lacks, F.struct(F.lit(c.name).alias("column"), self.row_number.alias("row"))))
        live = self.df.where("not __blank")
        return live.select(F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("c")).select("c.*") if found else live.select(F.lit("").alias("column"), self.row_number.alias("row")).limit(0)

    def check_casts(self) -> None:
        """Raises CleanerError with the first row whose value did not become its type."""
        bad = [F.min(F.when(F.col(c).isNotNull() & (F.trim(F.col(c)) != "") & F.col(f"__pre_{c}").isNull(), F.struct(ROW, c))).alias(c) for c in self.columns if self.columns[c].type.family not in ("string", "bit")]
        first = self.df.where("not __blank").agg(*bad).first() if bad else None
        for c in self.columns:
            if first is not None and c in first.asDict() and first[c] is not None:
                raise CleanerError(f"Not a valid {self.columns[c].type.name}", Where(self.name, c, (first[c][0] + self.settings.row_offset,), {"value": first[c][1]}))

    def check_issues(self) -> None:
        """Raises ValidatorError if a rule of severity fail is broken, with the counts."""
        counts = {r["severity"]: r["count"] for r in self.issues().groupBy("severity").count().collect()}
        if counts.get("fail"):
            raise ValidatorError("Validation failed", Where(self.name, details=counts))


def plan_table(df: DataFrame, name: str, columns: Mapping[str, ColumnConfig], s: Settings, row: str = ROW) -> TablePlan:
    given = [c for c in df.columns if c != row]
    missing = [n for n, c in columns.items() if not any(x in given for x in c.sources)]
    source = extract(df, name, columns, s, row)
    raw = [c for c in source.columns if c != ROW]

    def tidy(c: str) -> Column:
        value = F.col(c)
        if s.trim:
            value = strip(value)
        if s.standardise_nulls:
            value = null_if(value, NULL_WORDS)
        return value

    out = source.select(ROW, *(tidy(c).alias(c) for c in raw), *(F.col(c).alias(f"__source_{c}") for c in raw))
    empty = F.lit(s.remove_blank_rows)
    for c in raw:
        empty = empty & F.col(c).isNull()
    dated = {c: (c, k.type.family) for c, k in columns.items() if k.type.family in ("date", "datetime", "time")}
    out = with_dates(out, {f"__pre_{c}": v for c, v in dated.items()}, Dates(s.day_first, s.least_year, s.languages), closed=True)
    out = out.select("*", empty.alias("__blank"), *(cast(F.col(c), columns[c], s).alias(f"__pre_{c}") for c in columns if c not in dated))
    for c in columns.values():
        if is_large(c.value_mapping):
            out = apply_dictionary(out, F.col(f"__pre_{c.name}").cast("string"), entries(df.sparkSession, c.value_mapping), f"__map_{c.name}")
    out = out.select("*", *(_transformed(c, columns, raw).alias(f"{c.name}{s.suffix}") for c in columns.values()))

    unique: dict[str, Column] = {}
    for c in columns.values():
        if c.primary_key and (c.validation is not None or s.check_all):
            mark = f"__again_{c.name}"
            out = mark_duplicates(out, c.name, mark)
            unique[c.name] = ~F.col(mark)
    rules = [r for c in columns.values() if c.name not in missing for r in column_rules(c, F.col(c.name), F.col(f"{c.name}{s.suffix}"), s, unique.get(c.name))]
    number = F.col(ROW) + s.row_offset
    broken = [F.when(~r.valid, F.struct(F.lit(r.column).alias("column"), number.alias("row"), F.lit(r.severity).alias("severity"), F.lit(r.name).alias("rule"), F.lit(r.message).alias("message"))) for r in rules]
    none = F.expr("cast(array() as array<struct<column:string,row:bigint,severity:string,rule:string,message:string>>)")
    out = out.withColumn("__issues", F.filter(F.array(*broken), lambda x: x.isNotNull()) if broken else none)
    drops = F.exists("__issues", lambda i: i["severity"] == "drop") if not s.strict else F.lit(False)
    return TablePlan(name, columns, s, out.withColumn("__dropped", drops), raw, rules, missing)


def is_large(mapping: Mapping[str, list] | None) -> bool:
    """Whether a value mapping is joined as a table, rather than written into the plan."""
    return sum(len(v or ()) for v in (mapping or {}).values()) > dictionary.LITERAL


def _transformed(c: ColumnConfig, columns: Mapping[str, ColumnConfig], raw: list[str]) -> Column:
    """Value map, then phone, then formula; formulas see values as they were cleaned, before any transform."""
    value = F.col(f"__pre_{c.name}")
    if is_large(c.value_mapping):
        value = F.col(f"__map_{c.name}")
    elif c.value_mapping:
        value = map_values(value, {k: v or [] for k, v in c.value_mapping.items()})
    v = c.validation
    if v and v.format == "E.164" and c.type.family == "string":
        value = phone_e164(value, v.allow_local, v.dialling_prefix)
    if v and v.formula:
        names = {x: F.col(x) for x in raw} | {d: F.col(f"__pre_{d}") for d in v.depends_on if d in columns}
        kinds = dict.fromkeys(raw, "str") | {d: FAMILY_KINDS.get(columns[d].type.family, "bytes") for d in v.depends_on if d in columns}
        formula = v.formula.lower() if not any(x in v.formula for x in names) else v.formula
        value = derived(formula, list(v.depends_on), names, kinds).try_cast(c.type.spark)
    return value


def foreign_key_issues(plans: Mapping[str, TablePlan]) -> DataFrame | None:
    """Issues of all foreign keys, over the rows that stay."""
    out = None
    for plan in plans.values():
        for c in plan.columns.values():
            if c.foreign_key is None:
                continue
            table, column = c.foreign_key
            level = severity(c.validation.on_error if c.validation else None)
            fields = "table string, column string, row bigint, severity string, rule string, message string"
            if table not in plans or column not in plans[table].raw:
                what = f"there is no table {table} to refer to" if table not in plans else f"table {table} has no column {column} to refer to"
                found = plan.df.sparkSession.createDataFrame([(plan.name, c.name, None, level, "foreign_key", what)], fields)
            else:
                parent = plans[table]
                child = plan.rows().select(ROW, plan.cleaned(c.name))
                found = orphans(child, plan.cleaned(c.name), parent.rows(), parent.cleaned(column), c.allow_null).select(F.lit(plan.name).alias("table"), F.lit(c.name).alias("column"), plan.row_number.alias("row"), F.lit(level).alias("severity"), F.lit("foreign_key").alias("rule"), F.lit("no row of the other table has this key").alias("message"))
            out = found if out is None else out.unionByName(found)
    return out


def summary(issues: DataFrame, most_rows: int = 20) -> DataFrame:
    """Issues by column and rule: how many, and the first of their rows in order. All their rows are in `row_runs`, of which this is a view."""
    top = first_rows(row_runs(issues), most=most_rows)
    counts = issues.groupBy(*KEYS).agg(F.count("*").alias("n"))
    return counts.join(top, list(KEYS))
