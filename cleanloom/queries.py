"""Queries over the synthetic tables, one or more per operator, and the same in DuckDB's SQL.

The tables are clean, so queries spoil them first, by rules on the key. The rules are SQL that both engines read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config, parse_config, problems
from .errors import PipelineError
from .functions import cleaners, strings
from .functions.datetimes import with_dates
from .functions.formula import compile_formula, derived, kinds_of
from .operators import rules
from .operators.audit import null_pivot
from .operators.dictionary import apply_dictionary, dictionary
from .operators.kept_keys import KeptKeys, add_keys, keep_keys, mark_missing
from .operators.relations import mark_duplicates, mark_orphans, orphans
from .operators.row_runs import row_runs, run_lists
from .plans.engine import RunResult, run
from .plans.table import ROW, TablePlan, plan_table, summary
from .shipping import ship
from .sources import sinks
from .sources.database import embedded_url, export_table, load_table
from .sources.spreadsheet import read_sheet
from .sources.tables import read_csv, with_ordinal
from .sources.workbook_source import BOOK_ROWS, register
from .sources.workbook_source import NAME as XLSX
from .staging import is_local, new_path
from .types import parse_type

RUN_DATE = dt.date(2026, 1, 31)

#: table -> (key, spoiled text columns)
SPOILED: dict[str, tuple[str, dict[str, str]]] = {
    "customer": ("c_custkey", {
        "name": "CASE WHEN c_custkey % 7 = 0 THEN '  ' || c_name || ' ' WHEN c_custkey % 11 = 0 THEN 'N/A' WHEN c_custkey % 13 = 0 THEN 'NULL' WHEN c_custkey % 17 = 0 THEN '   ' WHEN c_custkey % 19 = 0 THEN 'n/a' ELSE c_name END",
        "phone": "CASE c_custkey % 5 WHEN 0 THEN '0' || CAST(821234567 + c_custkey AS STRING) WHEN 1 THEN '00' || CAST(27821234567 + c_custkey AS STRING) WHEN 2 THEN '+27 82 ' || CAST(1000000 + c_custkey AS STRING) WHEN 3 THEN '082-' || CAST(1000000 + c_custkey AS STRING) ELSE NULL END",
        "email": "CASE WHEN c_custkey % 5 = 0 THEN 'no.address' WHEN c_custkey % 7 = 0 THEN 'a b@x.org' WHEN c_custkey % 11 = 0 THEN NULL ELSE 'c' || CAST(c_custkey AS STRING) || '@mail.example.org' END",
        "segment": "c_mktsegment",
        "balance": "CASE WHEN c_custkey % 9 = 0 THEN 'R ' || CAST(c_acctbal AS STRING) WHEN c_custkey % 10 = 0 THEN 'none' ELSE CAST(c_acctbal AS STRING) END",
    }),
    "orders": ("o_orderkey", {
        "customer": "CASE WHEN o_orderkey % 23 = 0 THEN CAST(-o_custkey AS STRING) WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
        "status": "CASE WHEN o_orderkey % 5 = 0 THEN ' ' || lower(o_orderstatus) WHEN o_orderkey % 37 = 0 THEN '?' ELSE o_orderstatus END",
        "total": "CASE WHEN o_orderkey % 7 = 0 THEN 'R' || CAST(o_totalprice AS STRING) WHEN o_orderkey % 11 = 0 THEN 'R ' || CAST(o_totalprice AS STRING) WHEN o_orderkey % 13 = 0 THEN 'ZAR6' WHEN o_orderkey % 17 = 0 THEN '3,0' ELSE CAST(o_totalprice AS STRING) END",
        "date": "CASE WHEN o_orderkey % 41 = 0 THEN 'apple' WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN '31/02/2026' ELSE CASE o_orderkey % 6"
        " WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)"
        " WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 9, 2) || '/' || substr(CAST(o_orderdate AS STRING), 6, 2) || '/' || substr(CAST(o_orderdate AS STRING), 1, 4)"
        " WHEN 2 THEN substr(CAST(o_orderdate AS STRING), 9, 2) || '-' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) - 2, 3) || '-' || substr(CAST(o_orderdate AS STRING), 1, 4)"
        " WHEN 3 THEN substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(substr(CAST(o_orderdate AS STRING), 6, 2) AS INT) - 2, 3) || ' ' || substr(CAST(o_orderdate AS STRING), 9, 2) || ', ' || substr(CAST(o_orderdate AS STRING), 1, 4)"
        " WHEN 4 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00'"
        " ELSE substr(CAST(o_orderdate AS STRING), 6, 2) || '-' || substr(CAST(o_orderdate AS STRING), 9, 2) || '-' || substr(CAST(o_orderdate AS STRING), 1, 4) END END",
    }),
    "events": ("event_id", {
        "stamp": "CASE event_id % 6 WHEN 0 THEN substr(CAST(ts AS STRING), 1, 19) WHEN 1 THEN substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8) WHEN 2 THEN substr(CAST(ts AS STRING), 1, 16)"
        " WHEN 3 THEN substr(CAST(ts AS STRING), 1, 10) || ' 25:25' WHEN 4 THEN substr(CAST(ts AS STRING), 1, 10) || ' 9:45 PM' ELSE substr(CAST(ts AS STRING), 1, 10) END",
        "time": "CASE event_id % 7 WHEN 0 THEN substr(CAST(ts AS STRING), 12, 5) WHEN 1 THEN substr(CAST(ts AS STRING), 12, 8) WHEN 2 THEN '9:45 pm' WHEN 3 THEN '12:05AM' WHEN 4 THEN '09:45:99' WHEN 5 THEN 'banana' ELSE NULL END",
    }),
    "lineitem": ("l_orderkey", {
        "amount": "CASE l_orderkey % 9 WHEN 0 THEN CAST(l_quantity AS STRING) WHEN 1 THEN ' ' || CAST(l_extendedprice AS STRING) || ' ' WHEN 2 THEN '-' || CAST(l_discount AS STRING) WHEN 3 THEN '1_000' WHEN 4 THEN '5d' WHEN 5 THEN '1e3' WHEN 6 THEN '.5' WHEN 7 THEN CAST(l_partkey AS STRING) ELSE NULL END",
    }),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spoiled(spark: SparkSession, sf_dir: str, name: str, *more: str) -> DataFrame:
    key, cells = SPOILED[name]
    return table(spark, sf_dir, name).select(key, *more, *(F.expr(e).alias(c) for c, e in cells.items()))


def spoiled_sql(name: str, *more: str) -> str:
    key, cells = SPOILED[name]
    return f"(SELECT {', '.join([key, *more, *(f'{e} AS {c}' for c, e in cells.items())])} FROM {name})"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def keep(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


STRIP = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
TITLE = r"array_to_string(list_transform(regexp_extract_all(lower({}), '(\p{{L}}+|[^\p{{L}}]+)', 1), lambda w: upper(w[1]) || w[2:]), '')"
DATE = "coalesce(try_strptime({0}, '%Y-%d-%m'), try_strptime({0}, '%Y-%m-%d'), try_strptime({0}, '%d/%m/%Y'), try_strptime({0}, '%d-%m-%Y'), try_strptime({0}, '%d-%b-%Y'), try_strptime({0}, '%b %d, %Y'))"
ORDER_DATE = f"CAST({DATE.format("regexp_replace(date, ' 00:00:00$', '')")} AS DATE)"
MONEY = f"CASE WHEN regexp_matches(trim(regexp_replace({{0}}, '^R', '')), '{NUMBER}') THEN try_cast(trim(regexp_replace({{0}}, '^R', '')) AS DOUBLE) END"
STATUS = "CASE lower(trim({})) WHEN 'f' THEN 'completed' WHEN 'o' THEN 'pending' WHEN 'p' THEN 'cancelled' END"


@query(f"SELECT c_custkey, {STRIP.format('name')} AS trimmed, CASE WHEN {STRIP.format('name')} NOT IN ('NA', 'N/A', 'NULL', 'None') THEN {STRIP.format('name')} END AS standardised, CASE WHEN {STRIP.format('name')} NOT IN ('', 'nan') THEN {STRIP.format('name')} END AS cleaned FROM {spoiled_sql('customer')}")
def trim_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = strings.strip(F.col("name"))
    return spoiled(spark, sf_dir, "customer").select("c_custkey", trimmed.alias("trimmed"), strings.null_if(trimmed, strings.NULL_WORDS).alias("standardised"), cleaners.to_str(F.col("name")).alias("cleaned"))


@query(f"SELECT c_custkey, name FROM {spoiled_sql('customer')} WHERE name IS NULL OR name NOT IN ('{"', '".join(strings.NA_CELLS)}')")
def na_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spoiled(spark, sf_dir, "customer").withColumn("kept", strings.null_if(F.col("name"), strings.NA_CELLS))
    return df.where("name is null or kept is not null").select("c_custkey", F.col("kept").alias("name"))


BLANK = "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS name, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE CAST(s_acctbal AS STRING) END AS balance"


@query(f"SELECT s_suppkey, name, balance FROM (SELECT s_suppkey, {BLANK} FROM supplier) WHERE name IS NOT NULL OR balance IS NOT NULL")
def blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = {"name": "varchar(50)", "balance": "money"}
    config = configured({"t": {n: {"source_column": n, "data_type": t, "allow_null": True, "primary_key": n == "name"} for n, t in cols.items()}})
    df = table(spark, sf_dir, "supplier").selectExpr(f"s_suppkey as {ROW}", *BLANK.split(", CASE")[:1], "CASE" + BLANK.split(", CASE")[1])
    return plan_table(df, "t", config.tables["t"], config.settings).rows().select(F.col(ROW).alias("s_suppkey"), "name", "balance")


@query(f"SELECT p_partkey, lower(p_type) AS low, upper(p_type) AS up, {TITLE.format("p_name || ' o''brien 3rd école'")} AS titled FROM part")
def case_lower_upper_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" o'brien 3rd école"))
    return table(spark, sf_dir, "part").select("p_partkey", strings.cased(F.col("p_type"), "lower").alias("low"), strings.cased(F.col("p_type"), "upper").alias("up"), strings.cased(name, "title").alias("titled"))


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(trim(amount), '{NUMBER}') THEN CAST(trunc(try_cast(trim(amount) AS DOUBLE)) AS BIGINT) END AS value FROM {spoiled_sql('lineitem', 'l_linenumber')}")
def cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "lineitem", "l_linenumber").select("l_orderkey", "l_linenumber", cleaners.to_int(F.col("amount")).alias("value"))


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN regexp_matches(trim(amount), '{NUMBER}') THEN try_cast(trim(amount) AS DOUBLE) END AS value FROM {spoiled_sql('lineitem', 'l_linenumber')}")
def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "lineitem", "l_linenumber").select("l_orderkey", "l_linenumber", cleaners.to_numeric(F.col("amount")).alias("value"))


@query(f"SELECT o_orderkey, {MONEY.format('total')} AS value FROM {spoiled_sql('orders')}")
def cast_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "orders").select("o_orderkey", cleaners.to_money(F.col("total"), "R").alias("value"))


BIT = "CASE doc_id % 5 WHEN 0 THEN 'Yes ' WHEN 1 THEN CAST(quality AS STRING) WHEN 2 THEN 'TRUE' WHEN 3 THEN 'off' ELSE NULL END"


@query(f"SELECT doc_id, lower(trim({BIT})) IN ('true', 'yes', '1') AS value FROM labels")
def cast_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", cleaners.to_bit(F.expr(BIT)).alias("value"))


HEX = "CASE doc_id % 4 WHEN 0 THEN hex(lang) WHEN 1 THEN hex(lang) || ' 0a' WHEN 2 THEN 'abc' ELSE source END"


@query(f"SELECT doc_id, CASE WHEN regexp_matches(h, '^([0-9A-Fa-f]{{2}} ?)+$') THEN upper(replace(h, ' ', '')) END AS value FROM (SELECT doc_id, {HEX} AS h FROM documents)")
def cast_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.hex(cleaners.to_binary(F.expr(HEX))).alias("value"))


PICTURE = "CASE doc_id % 5 WHEN 0 THEN 'FFD8FF' || hex(lang) WHEN 1 THEN '89504E470D0A1A0A' WHEN 2 THEN 'R0lGODlh' WHEN 3 THEN hex(lang) ELSE 'Qk0=' END"


@query(f"SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN p WHEN 1 THEN p WHEN 2 THEN hex(from_base64(p)) WHEN 4 THEN '424D' END AS value FROM (SELECT doc_id, {PICTURE} AS p FROM documents)")
def cast_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.hex(cleaners.to_image(F.expr(PICTURE))).alias("value"))


@query(f"SELECT o_orderkey, {ORDER_DATE} AS value FROM {spoiled_sql('orders')}")
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "orders").transform(with_dates, {"value": ("date", "date")}).select("o_orderkey", F.col("value").cast("date"))


EVENT_AT = "coalesce(try_strptime({0}, '%Y-%d-%m %H:%M:%S'), try_strptime({0}, '%Y-%m-%d %H:%M:%S'), try_strptime({0}, '%Y-%d-%m %H:%M'), try_strptime({0}, '%Y-%m-%d %H:%M'), try_strptime({0}, '%Y-%d-%m %I:%M %p'), try_strptime({0}, '%Y-%m-%d %I:%M %p'), try_strptime({0}, '%Y-%d-%m'), try_strptime({0}, '%Y-%m-%d'))"


@query(f"SELECT event_id, strftime({EVENT_AT.format("replace(stamp, 'T', ' ')")}, '%Y-%m-%d %H:%M:%S') AS value FROM {spoiled_sql('events')}")
def parse_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "events").transform(with_dates, {"value": ("stamp", "datetime")}).select("event_id", F.col("value").cast("string"))


EVENT_TIME = "coalesce(try_strptime({0}, '%H:%M:%S'), try_strptime({0}, '%H:%M'), try_strptime({0}, '%I:%M %p'), try_strptime({0}, '%I:%M%p'))"


@query(f"SELECT event_id, '1900-01-01 ' || strftime({EVENT_TIME.format('time')}, '%H:%M:%S') AS value FROM {spoiled_sql('events')}")
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "events").transform(with_dates, {"value": ("time", "time")}).select("event_id", F.col("value").cast("string"))


STATUSES = {"completed": ["F"], "pending": ["O"], "cancelled": ["P"]}


@query(f"SELECT o_orderkey, {STATUS.format('status')} AS value FROM {spoiled_sql('orders')}")
def value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "orders").select("o_orderkey", strings.map_values(F.col("status"), STATUSES).alias("value"))


PHONE = "regexp_replace(CASE WHEN phone LIKE '+%' THEN '+' ELSE '' END || regexp_replace(phone, '[^0-9]', '', 'g'), '^00', '+')"
PHONE_SQL = f"CASE WHEN {PHONE} LIKE '+%' THEN {PHONE} ELSE '+27' || regexp_replace({PHONE}, '^0', '') END"


@query(f"SELECT c_custkey, CASE WHEN phone IS NOT NULL THEN {PHONE_SQL} END AS value FROM {spoiled_sql('customer')}")
def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "customer").select("c_custkey", strings.phone_e164(F.col("phone"), True, "+27").alias("value"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice * (1 - l_discount) END AS total, l_quantity - 7 * floor(l_quantity / 7) AS rest, floor(l_quantity / 7) AS whole, CASE WHEN l_discount = 0 THEN (CASE WHEN l_tax = 0 THEN -1.0 ELSE -2.0 END) ELSE l_tax / l_discount END AS ratio FROM lineitem")
def derived_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem").withColumn("d", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_discount")))
    names = {c: F.col(c) for c in df.columns}
    one = lambda f, *d: derived(f, list(d), names)
    ratio = one("l_tax / l_discount", "l_tax")
    ratio = F.when(F.isnan(ratio), -1.0).when(ratio == float("inf"), -2.0).otherwise(ratio)  # not a number and infinity, in a form that both engines print alike
    return df.select("l_orderkey", "l_linenumber", one("l_extendedprice * (1 - d)", "l_extendedprice", "d").alias("total"), one("l_quantity % 7", "l_quantity").alias("rest"), one("l_quantity // 7", "l_quantity").cast("double").alias("whole"), ratio.alias("ratio"))


@query("SELECT doc_id, text IS NOT NULL AND count(*) OVER (PARTITION BY text) > 1 AS duplicate FROM documents")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(table(spark, sf_dir, "documents"), "text", "duplicate").select("doc_id", "duplicate")


@query("SELECT doc_id, strlen(substr(text, 1, 40)) <= 40 AS in_bytes, length(text) <= 500 AS in_chars, strlen(text) <= 1000 AS short FROM documents")
def str_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    fits = lambda c, kind: rules.fits_length(c, parse_type(kind))
    return table(spark, sf_dir, "documents").select("doc_id", fits(F.substring(text, 1, 40), "varchar(40)").alias("in_bytes"), fits(text, "nvarchar(500)").alias("in_chars"), fits(text, "char(1000)").alias("short"))


@query(f"SELECT c_custkey, coalesce(regexp_full_match(name, '\\p{{L}}+(?:[ ''-]\\p{{L}}+)*'), false) AS person, coalesce(regexp_full_match(name, '[\\p{{L}}\\p{{N}}./()+]+(?:[ ''-][\\p{{L}}\\p{{N}}./()+]+)*'), false) AS product, coalesce(regexp_full_match({PHONE_SQL}, '\\+\\d{{8,15}}') AND phone IS NOT NULL, false) AS phone FROM {spoiled_sql('customer')}")
def str_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone = strings.phone_e164(F.col("phone"), True, "+27")
    name = F.col("name")
    return spoiled(spark, sf_dir, "customer").select("c_custkey", rules.has_format(name, "person_name").alias("person"), rules.has_format(name, "product_name").alias("product"), rules.has_format(phone, "E.164").alias("phone"))


@query(f"SELECT c_custkey, coalesce(regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}'), false) AS valid FROM {spoiled_sql('customer')}")
def email_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoiled(spark, sf_dir, "customer").select("c_custkey", rules.is_email(F.col("email")).alias("valid"))


@query(f"SELECT o_orderkey, v IS NULL OR (v >= DATE '1996-03-01' AND v <= DATE '1998-06-30') AS nullable, coalesce(v >= DATE '1996-03-01', false) AS required FROM (SELECT o_orderkey, {ORDER_DATE} AS v FROM {spoiled_sql('orders')})")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return spoiled(spark, sf_dir, "orders").transform(with_dates, {"value": ("date", "date")}).select("o_orderkey", rules.in_date_range(v, "1996-03-01", "1998-06-30", True, RUN_DATE).alias("nullable"), rules.in_date_range(v, "1996-03-01", None, False, RUN_DATE).alias("required"))


@query(f"SELECT o_orderkey, v IS NULL OR (v >= 1000 AND v <= 200000) AS nullable, coalesce(v >= 1000, false) AS required FROM (SELECT o_orderkey, {MONEY.format('total')} AS v FROM {spoiled_sql('orders')})")
def numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = cleaners.to_money(F.col("total"), "R")
    return spoiled(spark, sf_dir, "orders").select("o_orderkey", rules.in_range(v, 1000, 200000, True).alias("nullable"), rules.in_range(v, 1000, None, False).alias("required"))


@query(f"SELECT o_orderkey, customer IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE CAST(c.c_custkey AS VARCHAR) = o.customer) AS nullable, NOT EXISTS (SELECT 1 FROM customer c WHERE CAST(c.c_custkey AS VARCHAR) = o.customer) AS required FROM {spoiled_sql('orders')} o")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"))
    marked = mark_orphans(spoiled(spark, sf_dir, "orders"), "customer", parent, "c_custkey", "nullable", True)
    return mark_orphans(marked, "customer", parent, "c_custkey", "required", False).select("o_orderkey", "nullable", "required")


SHIPPED = SPOILED["orders"][1]["date"].replace("o_orderkey", "l_orderkey").replace("o_orderdate", "l_shipdate")


@query(f"SELECT l_orderkey, l_linenumber, {ORDER_DATE} AS value FROM (SELECT l_orderkey, l_linenumber, {SHIPPED} AS date FROM lineitem)")
def parse_date_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(SHIPPED).alias("date"))
    return with_dates(lines, {"value": ("date", "date")}).select("l_orderkey", "l_linenumber", F.col("value").cast("date"))


DAY, MONTH, YEAR = (f"substr(CAST(o_orderdate AS STRING), {a}, {n})" for a, n in ((9, 2), (6, 2), (1, 4)))
SHORT = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST({MONTH} AS INT) - 2, 3)"
LONG = f"trim(substr('January  February March    April    May      June     July     August   SeptemberOctober  November December ', 9 * CAST({MONTH} AS INT) - 8, 9))"
WORDS = (
    f"CASE o_orderkey % 12 WHEN 0 THEN 'Fri ' || {DAY} || ' ' || {SHORT} || ' ' || {YEAR} WHEN 1 THEN {DAY} || 'th ' || {LONG} || ' ' || {YEAR}"
    f" WHEN 2 THEN {LONG} || ' ' || {DAY} || 'th, ' || {YEAR} WHEN 3 THEN {DAY} || ' ' || {SHORT} || '. ' || {YEAR}"
    f" WHEN 4 THEN {DAY} || ' ' || {SHORT} || ' ' || {YEAR} || ' 10h30' WHEN 5 THEN {DAY} || ' ' || {LONG} || ' ' || {YEAR} || ' 10:00 EST'"
    f" WHEN 6 THEN 'Tuesday, ' || {DAY} || ' ' || {LONG} || ' ' || {YEAR} WHEN 7 THEN {SHORT} || ' ' || {DAY} || ' ' || {YEAR} || ' 10:30 pm'"
    f" WHEN 8 THEN '32nd ' || {SHORT} || ' ' || {YEAR} WHEN 9 THEN {DAY} || ' of ' || {LONG} || ' ' || {YEAR} || ' 10 pm'"
    f" WHEN 10 THEN {YEAR} || ' ' || {SHORT} || ' ' || {DAY} || ' 10:00 +02:00' ELSE 'Thu ' || {SHORT} || ' ' || {DAY} || ' 10:30:15 ' || {YEAR} END"
)
AT = "CASE o_orderkey % 12 WHEN 4 THEN ' 10:30:00' WHEN 5 THEN ' 10:00:00' WHEN 7 THEN ' 22:30:00' WHEN 8 THEN NULL WHEN 9 THEN ' 22:00:00' WHEN 10 THEN ' 08:00:00' WHEN 11 THEN ' 10:30:15' ELSE ' 00:00:00' END"


@query(f"SELECT o_orderkey, {YEAR} || '-' || {MONTH} || '-' || {DAY} || {AT} AS value FROM orders")
def parse_date_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(WORDS).alias("words"))
    return with_dates(words, {"value": ("words", "datetime")}).select("o_orderkey", F.col("value").cast("string"))


STRAY = "CASE WHEN l_linenumber = 3 AND l_orderkey % 50 = 0 THEN -l_orderkey ELSE l_orderkey END"


@query(f"SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, {STRAY} AS key FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.key)")
def fk_orphans_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(STRAY).alias("key"))
    return orphans(lines, "key", table(spark, sf_dir, "orders"), "o_orderkey", False).select("l_orderkey", "l_linenumber")


# -- whole plans --------------------------------------------------------------------------------------------------------


def configured(columns: dict, **options) -> Config:
    raw = {
        "runtime": {"project_name": "queries", "currency_symbol": "R", "strict_validation": False, "day_first_format": True},
        "source": {"type": "parquet", "file": "-", "header_row": 1},
        "target": {"db_type": "mssql", "driver": "-", "server": "-", "database": "-", "schema": "dbo", "authentication": {"type": "windows"}},
        "cleaning": {"trim_whitespace": True, "standardise_nulls": True, "remove_blank_rows": True},
        "mappings": {t: {"sheet_name": t, "target_table": t} for t in columns},
        "columns": columns,
    }
    return parse_config(raw, run_date=RUN_DATE, **options)


def column(kind: str, nullable: bool = True, source: str | None = None, **more) -> dict:
    return {"source_column": source, "data_type": kind, "allow_null": nullable} | more


CUSTOMERS = {
    "customer_id": column("int", False, "c_custkey", primary_key=True, validation={"min_value": 1}),
    "customer_name": column("varchar(15)", True, "name", case="title", validation={"format": "product_name", "on_error": "warn"}),
    "email": column("varchar(255)", False, "email", case="lower", validation={"format": "email", "on_error": "warn"}),
    "mobile": column("varchar(20)", True, "phone", validation={"format": "E.164", "allow_local": True, "dialling_prefix": "+27", "on_error": "warn"}),
    "segment": column("varchar(30)", True, "segment", case="title"),
    "balance": column("money", True, "balance", validation={"min_value": 0, "on_error": "drop"}),
}
ORDERS = {
    "order_id": column("int", False, "o_orderkey", primary_key=True, validation={"min_value": 100}),
    "customer_id": column("int", False, "customer", foreign_key="customers.customer_id"),
    "order_date": column("date", True, "date", validation={"min_value": "1996-03-01", "max_value": "today", "on_error": "drop"}),
    "order_status": column("varchar(10)", True, "status", value_mapping=STATUSES, validation={"on_error": "warn"}),
    "total": column("money", False, "total", validation={"min_value": 1000, "max_value": 400000}),
    "net": column("money", True, "net", validation={"derived_from": {"formula": "total / 2", "depends_on": ["total"]}}),
}


def _read(sf_dir: str) -> Callable[[SparkSession, str], DataFrame]:
    def read(spark: SparkSession, sheet: str) -> DataFrame:
        if sheet == "customers":
            return spoiled(spark, sf_dir, "customer").withColumn(ROW, F.col("c_custkey"))
        return spoiled(spark, sf_dir, "orders").withColumn("net", F.lit("0")).withColumn(ROW, F.col("o_orderkey"))

    return read


def _run(spark: SparkSession, sf_dir: str) -> RunResult:
    return run(spark, configured({"customers": CUSTOMERS, "orders": ORDERS}), _read(sf_dir))


def _orders(spark: SparkSession, sf_dir: str) -> TablePlan:
    return _run(spark, sf_dir).plans["orders"]


ORDER_PLAN = f"""(SELECT o_orderkey, customer, try_cast(customer AS BIGINT) AS customer_id, date, {ORDER_DATE} AS order_date,
  trim(status) AS status, {STATUS.format('status')} AS order_status, total, {MONEY.format('total')} AS amount FROM {spoiled_sql('orders')})"""
DATE_BROKEN = "order_date IS NOT NULL AND (order_date < DATE '1996-03-01' OR order_date > DATE '2026-01-31')"
AMOUNT_BROKEN = "amount IS NULL OR amount < 1000 OR amount > 400000"
ISSUES = f"""(
  SELECT 'order_id' AS col, o_orderkey + 2 AS rownum, 'fail' AS severity, 'numeric_range' AS rulename, 'not between 100 and None' AS message FROM {ORDER_PLAN} WHERE o_orderkey < 100
  UNION ALL SELECT 'order_date', o_orderkey + 2, 'drop', 'date_range', 'not between 1996-03-01 and today' FROM {ORDER_PLAN} WHERE {DATE_BROKEN}
  UNION ALL SELECT 'total', o_orderkey + 2, 'fail', 'numeric_range', 'not between 1000 and 400000' FROM {ORDER_PLAN} WHERE {AMOUNT_BROKEN})"""


@query(f"SELECT o_orderkey FROM {ORDER_PLAN} WHERE NOT coalesce({DATE_BROKEN}, false)")
def drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).rows().select(F.col(ROW).alias("o_orderkey"))


@query(f"SELECT * FROM {ISSUES}")
def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).issues().select(F.col("column").alias("col"), F.col("row").alias("rownum"), "severity", F.col("rule").alias("rulename"), "message")


@query(f"SELECT col, rulename, severity, count(*) AS n, array_to_string((array_agg(rownum ORDER BY rownum))[1:20], ',') AS first_rows FROM {ISSUES} GROUP BY ALL")
def issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summary(_orders(spark, sf_dir).issues())
    return found.select(F.col("column").alias("col"), F.col("rule").alias("rulename"), "severity", "n", F.array_join(F.col("first_rows").cast("array<string>"), ",").alias("first_rows"))


ISLANDS = f"""(SELECT *, rownum - dense_rank() OVER (PARTITION BY col, rulename, severity ORDER BY rownum) AS island FROM {ISSUES})"""


@query(f"""SELECT col, rulename, severity, min(rownum) AS first_row, max(rownum) AS last_row
FROM {ISLANDS} GROUP BY col, rulename, severity, island""")
def issue_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of every issue, as runs of consecutive rows; blocks are small here, so that runs are stitched."""
    runs = row_runs(_orders(spark, sf_dir).issues(), block=100)
    return runs.select(F.col("column").alias("col"), F.col("rule").alias("rulename"), "severity", F.col("first").alias("first_row"), F.col("last").alias("last_row"))


@query(f"""SELECT col, rulename, severity, first_row // 1000 * 1000 AS chunk, CAST(sum(last_row - first_row + 1) AS BIGINT) AS n,
string_agg(CASE WHEN first_row = last_row THEN CAST(first_row AS VARCHAR) ELSE first_row || '-' || last_row END, ', ' ORDER BY first_row) AS row_list
FROM (SELECT col, rulename, severity, min(rownum) AS first_row, max(rownum) AS last_row FROM {ISLANDS} GROUP BY col, rulename, severity, island) GROUP BY ALL""")
def issue_row_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as text, a thousand row numbers a line."""
    lists = run_lists(row_runs(_orders(spark, sf_dir).issues()), span=1000)
    return lists.select(F.col("column").alias("col"), F.col("rule").alias("rulename"), "severity", "chunk", "n", F.col("rows").alias("row_list"))


_KEPT = f"NOT coalesce({DATE_BROKEN}, false)"
_NULLS = {
    "order_id": ("0 * count(*)",) * 4,
    "customer_id": ("count(*) FILTER (customer IS NULL)",) * 3 + (f"count(*) FILTER (customer_id IS NULL AND {_KEPT})",),
    "order_date": ("count(*) FILTER (date IS NULL)", "count(*) FILTER (order_date IS NULL)", "count(*) FILTER (order_date IS NULL)", f"count(*) FILTER (order_date IS NULL AND {_KEPT})"),
    "order_status": ("0 * count(*)", "0 * count(*)", "count(*) FILTER (order_status IS NULL)", f"count(*) FILTER (order_status IS NULL AND {_KEPT})"),
    "total": ("count(*) FILTER (total IS NULL)", "count(*) FILTER (amount IS NULL)", "count(*) FILTER (amount IS NULL)", f"count(*) FILTER (amount IS NULL AND {_KEPT})"),
    "net": ("0 * count(*)", "0 * count(*)", "count(*) FILTER (amount IS NULL)", f"count(*) FILTER (amount IS NULL AND {_KEPT})"),
}


@query(" UNION ALL ".join(f"SELECT '{c}' AS col_name, '{s}' AS stage, CAST({n} AS BIGINT) AS nulls FROM {ORDER_PLAN}" for c, counts in _NULLS.items() for s, n in zip(("LOADED", "CLEANED", "TRANSFORMED", "VALIDATED"), counts, strict=True)))
def null_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).null_stats()


@query(" UNION ALL ".join(f"SELECT '{c}' AS col_name, {', '.join(f'CAST({n} AS BIGINT) AS "{s}"' for s, n in zip(('LOADED', 'CLEANED', 'TRANSFORMED', 'VALIDATED'), counts, strict=True))} FROM {ORDER_PLAN}" for c, counts in _NULLS.items()))
def null_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_pivot(_orders(spark, sf_dir).null_stats())


_STAGES = ("LOADED", "CLEANED", "TRANSFORMED", "VALIDATED")


@query(" UNION ALL ".join(f"SELECT '{c}' AS what, '{s}' AS stage, CAST({n} AS BIGINT) AS n FROM {ORDER_PLAN}" for c, counts in _NULLS.items() for s, n in zip(_STAGES, counts, strict=True))
       + f" UNION ALL SELECT severity, 'ISSUES', CAST(CASE WHEN severity = 'drop' THEN count(DISTINCT rownum) ELSE count(*) END AS BIGINT) FROM {ISSUES} GROUP BY severity"
       + f" UNION ALL SELECT 'rows', 'WRITTEN', count(*) FROM {ORDER_PLAN} WHERE {_KEPT}")
def observed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, written; null counts and severities as they came with the writing."""
    df, seen = _orders(spark, sf_dir).observed()
    path = new_path(spark, "observed")
    df.write.parquet(path)
    counted = [*seen.null_stats(), *((k, "ISSUES", n) for k, n in seen.severities().items())]
    written = spark.read.parquet(path).agg(F.lit("rows").alias("what"), F.lit("WRITTEN").alias("stage"), F.count("*").alias("n"))
    return spark.createDataFrame(counted, "what string, stage string, n long").unionByName(written)


def _audit_sql(name: str, old: str, new: str) -> str:
    """Changes of a number: old text and new value differ as numbers, or there is no new value."""
    text = f"CASE WHEN {new} = floor({new}) THEN CAST(CAST({new} AS BIGINT) AS VARCHAR) ELSE CAST({new} AS VARCHAR) END"
    differs = f"({old} IS DISTINCT FROM {text} AND TRY_CAST(trim({old}) AS DOUBLE) IS DISTINCT FROM CAST({new} AS DOUBLE)) OR ({old} IS NOT NULL AND {new} IS NULL)"
    return f"SELECT '{name}' AS col, o_orderkey + 2 AS rownum, {old} AS old, {text} AS new FROM {ORDER_PLAN} p WHERE {differs}"


AUDIT_DATE = f"SELECT 'order_date' AS col, o_orderkey + 2 AS rownum, date AS old, CAST(order_date AS VARCHAR) AS new FROM {ORDER_PLAN} WHERE date IS DISTINCT FROM CAST(order_date AS VARCHAR)"
AUDIT_NUMBERS = [_audit_sql("order_id", "CAST(o_orderkey AS VARCHAR)", "o_orderkey"), _audit_sql("customer_id", "p.customer", "p.customer_id"), _audit_sql("total", "p.total", "p.amount")]
AUDIT_STATUS = f"SELECT 'order_status', o_orderkey + 2, status, order_status FROM {ORDER_PLAN} WHERE status IS DISTINCT FROM order_status"


@query(" UNION ALL ".join([AUDIT_DATE, AUDIT_STATUS, *AUDIT_NUMBERS, _audit_sql("net", "'0'", "(p.amount / 2)")]))
def audit_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).audit().select(F.col("column").alias("col"), F.col("row").alias("rownum"), "old", "new")


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id, customer AS customer_id, status AS order_status, total, date AS order_date, '0' AS net, o_orderkey AS order_id_cleaned, p.customer_id AS customer_id_cleaned, p.order_date AS order_date_cleaned, p.order_status AS order_status_cleaned, amount AS total_cleaned, amount / 2 AS net_cleaned FROM {ORDER_PLAN} p WHERE NOT coalesce(p.order_date IS NOT NULL AND (p.order_date < DATE '1996-03-01' OR p.order_date > DATE '2026-01-31'), false)")
def finalise_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _orders(spark, sf_dir).final("both")
    return out.withColumn("order_date_cleaned", F.col("order_date_cleaned").cast("date"))


@query(f"SELECT o_orderkey AS order_id, p.customer_id, p.order_date, p.order_status, amount AS total, amount / 2 AS net FROM {ORDER_PLAN} p WHERE NOT coalesce(p.order_date IS NOT NULL AND (p.order_date < DATE '1996-03-01' OR p.order_date > DATE '2026-01-31'), false)")
def finalise_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _orders(spark, sf_dir).final("clean")
    return out.withColumn("order_date", F.col("order_date").cast("date"))


@query(f"""SELECT o_orderkey AS order_id, p.customer_id, p.order_date, p.order_status, amount AS total, amount / 2 AS net,
  NOT EXISTS (SELECT 1 FROM {spoiled_sql('customer')} c WHERE c.c_custkey = p.customer_id AND coalesce(c.balance IS NULL OR {MONEY.format('c.balance')} IS NULL OR {MONEY.format('c.balance')} >= 0, true)) AS orphan
FROM {ORDER_PLAN} p WHERE NOT coalesce(p.order_date IS NOT NULL AND (p.order_date < DATE '1996-03-01' OR p.order_date > DATE '2026-01-31'), false)""")
def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables cleaned, transformed and validated; orders with the verdict of their foreign key."""
    plans = _run(spark, sf_dir).plans
    orders, customers = plans["orders"], plans["customers"]
    marked = mark_orphans(orders.final("clean"), "customer_id", customers.final("clean"), "customer_id", "orphan", False)
    return marked.withColumn("order_date", F.col("order_date").cast("date"))


@query(f"SELECT o_orderkey + 2 AS rownum FROM {ORDER_PLAN} p WHERE amount IS NULL")
def not_computable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).not_computable().select(F.col("row").alias("rownum"))


@query(f"""SELECT p.o_orderkey + 2 AS rownum, 'orders' AS tbl, 'customer_id' AS col, 'fail' AS severity, 'foreign_key' AS rulename, 'no row of the other table has this key' AS message FROM {ORDER_PLAN} p
WHERE NOT coalesce(p.order_date IS NOT NULL AND (p.order_date < DATE '1996-03-01' OR p.order_date > DATE '2026-01-31'), false)
AND NOT EXISTS (SELECT 1 FROM {spoiled_sql('customer')} c WHERE c.c_custkey = p.customer_id AND coalesce(c.balance IS NULL OR {MONEY.format('c.balance')} IS NULL OR {MONEY.format('c.balance')} >= 0, true))""")
def fk_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _run(spark, sf_dir).foreign_keys
    return found.select(F.col("row").alias("rownum"), F.col("table").alias("tbl"), F.col("column").alias("col"), "severity", F.col("rule").alias("rulename"), "message")


@query(f"SELECT severity, CAST(CASE WHEN severity = 'drop' THEN count(DISTINCT rownum) ELSE count(*) END AS BIGINT) AS n FROM {ISSUES} GROUP BY severity")
def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).severity_counts()


@query(f"SELECT DISTINCT rownum FROM {ISSUES} WHERE severity = 'drop'")
def rows_to_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).rows_to_drop().withColumnRenamed("row", "rownum")


LINES = {"order_id": column("int", False, "l_orderkey", primary_key=True, validation={}), "n": column("int", True, "l_linenumber")}


@query("SELECT 'order_id' AS col, CAST(l_orderkey AS VARCHAR) AS value, count(*) AS n, array_to_string((array_agg(10 * l_orderkey + l_linenumber + 2 ORDER BY l_linenumber))[1:3], ',') AS first_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(ROW), "l_orderkey", "l_linenumber")
    config = configured({"lines": LINES})
    found = plan_table(lines, "lines", config.tables["lines"], config.settings).duplicate_keys(3)
    return found.select(F.col("column").alias("col"), "value", "n", F.array_join(F.col("first_rows").cast("array<string>"), ",").alias("first_rows"))


@query(f"SELECT count(*) FILTER (name IS NULL AND balance IS NULL) AS blank_rows, count(*) AS all_rows FROM (SELECT {BLANK} FROM supplier)")
def blank_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = {"name": column("varchar(50)", True, "name", primary_key=True), "balance": column("money", True, "balance")}
    config = configured({"t": cols})
    df = table(spark, sf_dir, "supplier").selectExpr(f"s_suppkey as {ROW}", *BLANK.split(", CASE")[:1], "CASE" + BLANK.split(", CASE")[1])
    return plan_table(df, "t", config.tables["t"], config.settings).blank_rows()


@query("SELECT n_nationkey + 2 AS rownum, n_name AS country, CAST(n_regionkey AS VARCHAR) AS n_regionkey, CAST(NULL AS VARCHAR) AS continent FROM nation")
def source_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of source names, an undeclared column that rides along, and a declared one that is missing."""
    cols = {"country": column("varchar(25)", False, ["nation", "n_name"], primary_key=True), "continent": column("varchar(9)", True, "continent")}
    config = configured({"t": cols})
    plan = plan_table(table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", ROW), "t", config.tables["t"], config.settings)
    return plan.df.select(plan.row_number.alias("rownum"), "country", "n_regionkey", "continent")


AUDIT_TRIM = f"SELECT 'order_status', o_orderkey + 2, raw, trim(raw) FROM (SELECT o_orderkey, status AS raw FROM {spoiled_sql('orders')}) WHERE raw <> trim(raw)"


@query(" UNION ALL ".join([AUDIT_DATE, AUDIT_TRIM, *AUDIT_NUMBERS]))
def audit_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What casts alone changed, against the cells as they were read."""
    return _orders(spark, sf_dir).audit("source", "cleaned").select(F.col("column").alias("col"), F.col("row").alias("rownum"), "old", "new")


@query(rf"SELECT c_custkey, name IS NOT NULL AS not_null, CASE WHEN name IS NOT NULL THEN trim(name) <> '' END AS not_empty, coalesce(regexp_full_match(trim(email), '[A-Za-z0-9!#$%&''*+/=?^_`{{|}}~-]+(\.[A-Za-z0-9!#$%&''*+/=?^_`{{|}}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]{{0,61}}[A-Za-z0-9])?\.)+[A-Za-z]{{2,63}}'), false) AS strict_email FROM {spoiled_sql('customer')}")
def null_empty_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("name")
    return spoiled(spark, sf_dir, "customer").select("c_custkey", rules.null_allowed(name, False).alias("not_null"), rules.empty_allowed(name, False).alias("not_empty"), rules.is_email(F.col("email"), strict=True).alias("strict_email"))


@query(f"SELECT c_custkey, name, 'fail' AS severity FROM {spoiled_sql('customer')} WHERE name IS NULL OR trim(name) = ''")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = configured({"t": {"name": column("varchar(50)", False, "name", validation={"on_error": "warn"}), "key": column("int", False, "c_custkey", primary_key=True)}})
    rule = next(r for r in rules.column_rules(config.tables["t"]["name"], F.col("name"), F.col("name"), config.settings) if r.name == "not_null")
    return spoiled(spark, sf_dir, "customer").where(~rule.valid).select("c_custkey", "name", F.lit(rule.severity).alias("severity"))


def _values(columns: str, rows: list[tuple]) -> str:
    """SQL for some rows of text, numbers and nulls."""
    cell = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({columns})"


AWKWARD = "CASE s_suppkey % 4 WHEN 0 THEN 'a,\"b\"; c' WHEN 1 THEN 'two' || chr(10) || 'lines' WHEN 2 THEN NULL ELSE s_name END"


@query(f"SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, {AWKWARD} AS name, CASE WHEN s_acctbal = floor(s_acctbal) THEN CAST(CAST(s_acctbal AS BIGINT) AS VARCHAR) ELSE CAST(s_acctbal AS VARCHAR) END AS balance FROM supplier")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV, with quotes, line breaks and nulls, and read again as text."""
    folder = new_path(spark, "csv")
    sinks.write_csv({"t": table(spark, sf_dir, "supplier").select("s_suppkey", F.expr(AWKWARD).alias("name"), F.col("s_acctbal").alias("balance"))}, folder)
    return read_csv(spark, f"{folder}/t", multi_line=True).drop(ROW)


@query("""SELECT 'nation' AS sheet, n_nationkey AS rownum, CAST(n_nationkey AS VARCHAR) AS a, n_name AS b FROM nation
UNION ALL SELECT 'regions under a name that is cut', r_regionkey + 1, CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT 'regions under a name that is cut', 0, 'r_regionkey', 'r_name'""")
def workbook_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables written as sheets of a workbook, and read again: one with its header, one without."""
    long = "regions under a name that is cut off at 31 characters"
    nation, region = (table(spark, sf_dir, t).select(f"{t[0]}_{t}key", f"{t[0]}_name").orderBy(f"{t[0]}_{t}key") for t in ("nation", "region"))
    path = sinks.write_excel({"nation": nation, long: region}, new_path(spark, "workbook"), "book.xlsx")
    first = read_sheet(spark, path, "nation").select(F.lit("nation").alias("sheet"), F.col(ROW).alias("rownum"), F.col("n_nationkey").alias("a"), F.col("n_name").alias("b"))
    second = read_sheet(spark, path, long[:31], 0).select(F.lit(long[:32]).alias("sheet"), F.col(ROW).alias("rownum"), F.col("0").alias("a"), F.col("1").alias("b"))
    return first.unionByName(second)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, CAST(l_shipdate AS VARCHAR) AS shipped FROM lineitem""")
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as sheets of a folder of workbooks, for one sheet ends at 1,048,576 rows; written by several tasks and scanned by several others."""
    path = new_path(spark, "scan")
    ship(spark)
    register(spark)
    kept = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    lines = table(spark, sf_dir, "lineitem").select(*kept).repartition(max(8, spark.sparkContext.defaultParallelism), "l_orderkey")
    lines.withColumn("l_shipdate", F.col("l_shipdate").cast("string")).write.format(XLSX).option("sheet", "lines").option("book_rows", BOOK_ROWS).mode("overwrite").save(path)
    back = spark.read.format(XLSX).option("sheet", "lines").option("split_bytes", 2 << 20).load(path)
    numbers = {"l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_returnflag": "string"}
    return back.select(*(F.col(c).cast(k).alias(c) for c, k in numbers.items()), F.col("l_shipdate").alias("shipped"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 13 > 0 AND p_partkey * 7919 % 60000 < 50000 THEN 'label ' || (p_partkey * 7919 % 60000) % 97 END AS label FROM part""")
def large_value_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of 50,000 entries over parts whose names are spelt in their own ways; some have no entry, some no name."""
    known = dictionary(spark.range(50_000).select(F.concat(F.lit("Part "), "id").alias("raw"), F.concat(F.lit("label "), F.col("id") % 97).alias("label")))
    spelt = F.concat(F.lit("  pART "), (F.col("p_partkey") * 7919 % 60_000).cast("string"), F.lit(" "))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 13 > 0, spelt).alias("name"))
    return apply_dictionary(parts, F.col("name"), known, "label").select("p_partkey", "label")


@query("SELECT c_custkey, c_custkey % 8 IN (0, 4, 5) AS valid FROM customer")
def strict_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of every customer in eight forms: domains beyond ASCII, too long by themselves or once encoded, of special use; local parts too long in bytes."""
    key = F.col("c_custkey").cast("string")
    forms = [
        F.concat(key, F.lit("@münchen.example.org")), F.concat(key, F.lit("x" * 64 + "@mail.org")), F.concat(key, F.lit(f"@{'ü' * 60}.org")), F.concat(key, F.lit("@mail.test")),
        F.concat(F.lit("first.last+"), key, F.lit("@sub.mail.org")), F.concat(F.lit("ü" * 20), key, F.lit("@почта.org")), F.concat(F.lit("é" * 40), key, F.lit("@mail.org")), F.lit(None).cast("string"),
    ]
    address = F.element_at(F.array(*forms), (F.col("c_custkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", rules.is_email(address, strict=True).alias("valid"))


@query("""SELECT delivery, l_orderkey, l_linenumber, l_partkey, o_orderkey IS NULL AS orphan
FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'second' ELSE 'first' END AS delivery FROM lineitem)
LEFT JOIN orders ON l_orderkey = o_orderkey AND (o_orderkey % 5 > 0 OR delivery = 'second' AND o_orderkey % 10 = 5)""")
def kept_keys_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders kept in buckets, and two deliveries of lines against them; between these, a further delivery of orders."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    kept = keep_keys(orders.where("o_orderkey % 5 > 0"), "o_orderkey", f"kept_orders_{uuid.uuid4().hex}", 16, new_path(spark, "kept"))
    first = _delivered(lines.where("l_linenumber % 2 <> 0"), kept, "first")
    add_keys(orders.where("o_orderkey % 10 = 5 or o_orderkey % 3 = 0 and o_orderkey % 5 > 0"), "o_orderkey", kept)
    return first.unionByName(_delivered(lines.where("l_linenumber % 2 = 0"), kept, "second"))


def _delivered(lines: DataFrame, kept: KeptKeys, name: str) -> DataFrame:
    return mark_missing(lines, "l_orderkey", kept, "orphan").withColumn("delivery", F.lit(name))


@query("""SELECT run, o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS ordered, o_orderpriority
FROM orders CROSS JOIN (VALUES ('first'), ('third')) AS r(run) WHERE run = 'first' OR o_orderkey % 3 = 0""")
def jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders into a database (one that lives in this JVM) and back: a first delivery, the same once more, which changes nothing, and a third of other rows.
    On a cluster executors cannot reach it, so it imports and exports files by itself."""
    url, bulk = embedded_url(), not is_local(spark.sparkContext.master)
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string")).repartition(4, "o_orderkey")
    for run, rows in (("first", orders), ("first", orders), ("third", orders.where("o_orderkey % 3 = 0"))):
        load_table(rows.withColumn("run", F.lit(run)), url, "APP.ORDERS", run, bulk=bulk)
    bounds = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    range_of = ("o_orderkey", bounds[0] or 0, (bounds[1] or 0) + 1, 4)
    back = export_table(spark, url, "APP.ORDERS", *range_of) if bulk else spark.read.jdbc(url, "APP.ORDERS", *range_of)
    return back.select("run", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("ordered"), "o_orderpriority")


@query("SELECT kind, CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name FROM region CROSS JOIN (VALUES ('csv'), ('excel'), ('parquet')) AS k(kind)")
def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table through three sinks at once, each read again."""
    folder, config = new_path(spark, "load"), configured({"t": {"k": column("int", False, "k", primary_key=True)}})
    out = sinks.load({"t": table(spark, sf_dir, "region").select("r_regionkey", "r_name")}, ["csv", "parquet", "excel"], folder, config)
    back = {"csv": read_csv(spark, f"{folder}/csv/t"), "parquet": spark.read.parquet(f"{folder}/parquet/t"), "excel": read_sheet(spark, out["excel"], "t")}
    return reduce(DataFrame.unionByName, (df.select(F.lit(k).alias("kind"), F.col("r_regionkey").cast("string"), "r_name") for k, df in back.items()))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS rownum FROM lineitem")
def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return with_ordinal(table(spark, sf_dir, "lineitem").select(*keys), keys, "rownum").select("l_orderkey", "l_linenumber", "rownum")


TYPES = [
    ("varchar(50)", "string", 50, "needs length, bytes"), ("NVARCHAR(5)", "string", 5, "needs length"), ("text", "string", None, ""), ("ntext", "string", None, ""), ("tinyint", "int", None, "number"), ("bigint", "int", None, "number"),
    ("decimal(10, 2)", "numeric", 10, "number"), ("real", "numeric", None, "number"), ("smallmoney", "money", None, "number"), ("bit", "bit", None, ""), ("date", "date", None, "date"), ("datetime", "datetime", None, "date"),
    ("time", "time", None, ""), ("varbinary", "binary", None, ""), ("image", "image", None, ""), ("json", None, None, ""),
]


@query(f"""SELECT declared, family, length, traits, CASE WHEN traits LIKE '%needs length%'
  THEN (SELECT count(*) FROM {spoiled_sql('customer')} WHERE length(coalesce(name, '')) <= t.length) ELSE (SELECT count(*) FROM customer) END AS fitting
FROM ({_values("declared, family, length, traits", TYPES)}) t""")
def type_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each declared type is taken for, and how many of the customers' names fit it: all types in one pass."""

    def traits(name: str) -> str:
        t = parse_type(name)
        return ", ".join(k for k, v in (("number", t.numeric), ("date", t.temporal), ("needs length", t.needs_length), ("bytes", t.in_bytes)) if v)

    kinds = {n: parse_type(n) for n, *_ in TYPES}
    counts = spoiled(spark, sf_dir, "customer").agg(*(F.count_if(rules.fits_length(F.col("name"), t)).alias(f"n{k}") for k, t in enumerate(kinds.values())))
    rows = F.array(*(
        F.struct(F.lit(n).alias("declared"), F.lit(t.family).cast("string").alias("family"), F.lit(t.length).cast("int").alias("length"), F.lit(traits(n)).alias("traits"), F.col(f"n{k}").alias("fitting"))
        for k, (n, t) in enumerate(kinds.items())
    ))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


BROKEN_CONFIG = {
    "source": {"type": "excel", "file": "book.xlsx", "header_row": -1},
    "target": {"db_type": "mssql", "driver": "-", "server": "-", "database": "-", "schema": "dbo", "authentication": {}},
    "cleaning": {"trim_whitespace": True, "standardise_nulls": True},
    "mappings": {"a": {"sheet_name": "A", "target_table": "a"}, "c": {"sheet_name": "C"}},
    "columns": {
        "a": {
            "k": {"source_column": "k", "data_type": "varchar", "allow_null": False, "primary_key": "yes", "foreign_key": "b.other"},
            "x": {"source_column": "x", "data_type": "json", "allow_null": True, "foreign_key": "plain", "value_mapping": {"yes": None}},
            "y": {"source_column": "y", "data_type": "money", "validation": {"derived_from": {"formula": "k + z", "depends_on": ["k", "z"]}}},
        },
        "b": {"p": {"source_column": "p", "data_type": "varchar(9)", "allow_null": True, "foreign_key": "d.k", "validation": {"format": "E.164", "allow_local": "true"}}},
    },
}
PROBLEMS = [
    "Section runtime is missing", "source: header_row must be 0 (no header) or positive", "target.authentication: type is missing", "cleaning: remove_blank_rows is missing", "mappings.c: target_table is missing", "mappings.c: the table has no columns",
    "columns.b: the table has a foreign key but no mapping", "a.k: varchar needs a length above 0", "a.k: the foreign key's column other does not exist in b", "a.x: mssql has no data type json", "a.x: value mapping yes has no values",
    "a.x: the foreign key plain is not table.column", "a.y: z, which its formula depends on, is missing", "a.y: allow_null is missing", "b.p: local numbers need a dialling prefix that starts with +", "b.p: the foreign key's table d does not exist", "b: no primary key",
]


@query(_values("problem", [(x,) for x in PROBLEMS]))
def config_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is wrong with a configuration, in one go."""
    return spark.createDataFrame([(x,) for x in problems(BROKEN_CONFIG)], "problem string")


STRICT = {"order_id": column("int", False, "o_orderkey", primary_key=True), "order_date": column("date", True, "date", validation={"min_value": "1996-03-01"}), "total": column("money", True, "total", validation={"min_value": 1000})}


@query(f"""SELECT 'columns' AS kind, 'ExtractorError' AS error, 'extract' AS stage, CAST(NULL AS VARCHAR) AS col, CAST(NULL AS BIGINT) AS rownum
UNION ALL SELECT 'casts', 'CleanerError', 'clean', 'order_date', min(o_orderkey) + 2 FROM {ORDER_PLAN} WHERE trim(date) <> '' AND order_date IS NULL
UNION ALL SELECT 'rules', 'ValidatorError', 'validate', NULL, NULL
UNION ALL SELECT 'keys', 'SchemaError', 'schema', NULL, NULL""")
def strict_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What strict mode raises: at an undeclared column, a value that is not of its type (with its first row), a broken rule of
    severity fail, a configuration with problems."""
    config = configured({"t": STRICT}, strict=True)
    cells = spoiled(spark, sf_dir, "orders").withColumn(ROW, F.col("o_orderkey")).select(ROW, "o_orderkey", "date", "total")
    plan = plan_table(cells, "t", config.tables["t"], config.settings)
    tries = {"columns": lambda: plan_table(cells.withColumn("more", F.lit(1)), "t", config.tables["t"], config.settings), "casts": plan.check_casts, "rules": plan.check_issues, "keys": lambda: parse_config(BROKEN_CONFIG)}
    rows = []
    for kind, attempt in tries.items():
        try:
            attempt()
        except PipelineError as e:
            rows.append((kind, type(e).__name__, str(e.stage), e.where.column, e.where.rows[0] if e.where.rows else None))
    return spark.createDataFrame(rows, "kind string, error string, stage string, col string, rownum long")


@query("SELECT 'continent' AS col, 'fail' AS severity, 'required' AS rulename, 'no source column has this name' AS message, CAST(count(*) AS BIGINT) AS nulls FROM nation")
def required_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required column that no source has: an issue, and null in every row."""
    cols = {"k": column("int", False, "n_nationkey", primary_key=True), "country": column("varchar(25)", False, "n_name"), "continent": column("varchar(9)", False, "continent", required=True, validation={})}
    config = configured({"t": cols})
    plan = plan_table(table(spark, sf_dir, "nation").withColumn(ROW, F.col("n_nationkey").cast("long")), "t", config.tables["t"], config.settings)
    nulls = plan.rows().agg(F.count_if(F.col("continent").isNull()).alias("nulls"))
    return plan.issues().where("rule = 'required'").select(F.col("column").alias("col"), "severity", F.col("rule").alias("rulename"), "message").crossJoin(F.broadcast(nulls))  # one row


DDL = """CREATE TABLE [dbo].[orders] (
  [order_id] int NOT NULL,
  [customer_id] int NOT NULL,
  [order_date] date NULL,
  [order_status] varchar(10) NULL,
  [total] money NOT NULL,
  [net] money NULL,
  PRIMARY KEY ([order_id]),
  FOREIGN KEY ([customer_id]) REFERENCES [dbo].[customers] ([customer_id])
)"""


@query(f"SELECT * FROM ({_values('tbl, statement', [('orders', DDL)])}), (SELECT count(*) AS n_rows FROM {ORDER_PLAN} WHERE {_KEPT})")
def sql_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement that makes a table of a plan's declared columns, and how many rows it is to take."""
    plan = _orders(spark, sf_dir)
    config = configured({"customers": CUSTOMERS, "orders": ORDERS})
    return plan.rows().agg(F.count("*").alias("n_rows")).select(F.lit("orders").alias("tbl"), F.lit(sinks.ddl("orders", config.tables["orders"])).alias("statement"), "n_rows")


DEPTH = "(l_discount - 0.05)"
FORMULAS = {"angle": f"arctan2({DEPTH}, l_tax + 1)", "hyper": f"tanh({DEPTH}) + sinh({DEPTH}) * cosh(l_tax)", "arc": f"arcsin({DEPTH}) + arccos(l_tax) + arctan(l_quantity)"}


@query(f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({f.replace("arc", "a")}, 9) AS {n}' for n, f in FORMULAS.items())} FROM lineitem")
def formula_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    names = {c: F.col(c) for c in df.columns}
    return df.select("l_orderkey", "l_linenumber", *(F.round(compile_formula(f, names, kinds_of(df)), 9).alias(n) for n, f in FORMULAS.items()))


#: formulas over whole numbers a, b (b often zero) and big ones, c near 64 bits, doubles x, y; what no double holds is null in SQL's own way
CORNERS = {
    "by": ("a // b", "CASE WHEN b = 0 THEN CASE WHEN a > 0 THEN 'inf'::DOUBLE WHEN a < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END ELSE CAST(a // b - CASE WHEN a % b <> 0 AND (a < 0) <> (b < 0) THEN 1 ELSE 0 END AS DOUBLE) END"),
    "rest": ("a % b", "CASE WHEN b = 0 THEN 'nan'::DOUBLE WHEN a % b <> 0 AND (a % b < 0) <> (b < 0) THEN CAST(a % b + b AS DOUBLE) ELSE CAST(a % b AS DOUBLE) END"),
    "ratio": ("a / b", "CASE WHEN b = 0 THEN CASE WHEN a > 0 THEN 'inf'::DOUBLE WHEN a < 0 THEN '-inf'::DOUBLE ELSE 'nan'::DOUBLE END ELSE CAST(a AS DOUBLE) / CAST(b AS DOUBLE) END"),
    "twice": ("c + c", "TRY_CAST(CAST(c AS HUGEINT) + c AS BIGINT)"),
    "product": ("c * a", "TRY_CAST(CAST(c AS HUGEINT) * a AS BIGINT)"),
    "less": ("-c - a", "TRY_CAST(-CAST(c AS HUGEINT) - a AS BIGINT)"),
    "power": ("x ** 2 + abs(a)", "x * x + abs(a)"),
    "curve": ("log(x)", "CASE WHEN x = 0 THEN '-inf'::DOUBLE WHEN x < 0 THEN 'nan'::DOUBLE ELSE round(ln(x), 9) END"),
    "holds": ("a > b and not (a in [1, 2]) or c == 0", "a > b AND NOT (a IN (1, 2)) OR c = 0"),
}
CORNER_ROWS = """SELECT l_orderkey, l_linenumber, CAST(l_partkey % 7 - 3 AS BIGINT) AS a, CAST(l_suppkey % 3 - 1 AS BIGINT) AS b,
(9223372036854775807 - l_orderkey) * CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END AS c, CAST(l_suppkey % 5 - 2 AS DOUBLE) AS x FROM lineitem"""


@query(f"SELECT l_orderkey, l_linenumber, {', '.join(f'{sql} AS {n}' for n, (_, sql) in CORNERS.items())} FROM ({CORNER_ROWS})")
def formula_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formulas divided by zero, beyond 64 bits and out of a function's range, over every line."""
    df = table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_partkey") % 2 == 0, 1).otherwise(-1)
    a, b = (F.col("l_partkey") % 7 - 3).cast("bigint"), (F.col("l_suppkey") % 3 - 1).cast("bigint")
    df = df.select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"), ((F.lit((1 << 63) - 1) - F.col("l_orderkey")) * sign).alias("c"), (F.col("l_suppkey") % 5 - 2).cast("double").alias("x"))
    names, kinds = {c: F.col(c) for c in df.columns}, kinds_of(df)
    made = {n: compile_formula(f, names, kinds) for n, (f, _) in CORNERS.items()}
    return df.select("l_orderkey", "l_linenumber", *((F.round(c, 9) if n == "curve" else c).alias(n) for n, c in made.items()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
