"""Whole tables and runs."""

import copy
import datetime as dt

import pytest
import yaml
from pyspark.sql import functions as F

from cleanloom.config import config_date, load_config, parse_config, warnings
from cleanloom.errors import CleanerError, ConfigError, ExtractorError, SchemaError, ValidatorError
from cleanloom.operators.relations import mark_duplicates
from cleanloom.plans.engine import run
from cleanloom.plans.table import ROW, plan_table, summary
from cleanloom.sources.sinks import ddl

RAW = {
    "runtime": {"project_name": "p", "currency_symbol": "R", "strict_validation": False, "day_first_format": True},
    "source": {"type": "excel", "file": "book.xlsx", "header_row": 1},
    "target": {"db_type": "mssql", "driver": "d", "server": "s", "database": "b", "schema": "dbo", "authentication": {"type": "windows"}},
    "cleaning": {"trim_whitespace": True, "standardise_nulls": True, "remove_blank_rows": True},
    "mappings": {"People": {"sheet_name": "People", "target_table": "people"}, "buys": {"sheet_name": "Buys", "target_table": "buys"}},
    "columns": {
        "People": {
            "ID": {"source_column": "id", "data_type": "int", "allow_null": False, "primary_key": True, "validation": {"min_value": 1}},
            "name": {"source_column": ["full name", "name"], "data_type": "varchar(12)", "allow_null": True, "case": "title", "validation": {"format": "person_name", "on_error": "warn"}},
            "joined": {"source_column": "joined", "data_type": "date", "allow_null": True, "validation": {"min_value": "1900-01-01", "max_value": "today", "on_error": "drop"}},
        },
        "buys": {
            "buy": {"source_column": "buy", "data_type": "int", "allow_null": False, "primary_key": True},
            "who": {"source_column": "who", "data_type": "int", "allow_null": False, "foreign_key": "people.id"},
            "n": {"source_column": "n", "data_type": "int", "allow_null": True},
            "price": {"source_column": "price", "data_type": "money", "allow_null": True},
            "total": {"source_column": "total", "data_type": "money", "allow_null": True, "validation": {"derived_from": {"formula": "n * price", "depends_on": ["n", "price"]}}},
            "state": {"source_column": "state", "data_type": "varchar(9)", "allow_null": True, "value_mapping": {"Done": ["d", "DONE"]}, "validation": {}},
        },
    },
}
PEOPLE = [(0, "1", " ann lee ", "13/01/2020"), (1, "2", "BOB", "2022-09-05"), (2, "2", "x9", "apple"), (3, None, " ", None), (4, "NA", "eve", "31/12/2099"), (5, None, None, None), (6, "x", "Ann Marie Longname", "1 Jan 2020")]
BUYS = [(0, "10", "1", "2", "R 3.50", "0", "D", "note"), (1, "11", "9", "2", "bad", "7", "?", None), (2, "12", None, None, "1", None, None, None)]
RUN = dt.date(2026, 1, 31)


def config(change=None, **options):
    raw = copy.deepcopy(RAW)
    if change:
        change(raw)
    return parse_config(raw, run_date=RUN, **options)


@pytest.fixture(scope="module")
def read(spark):
    tables = {
        "People": spark.createDataFrame(PEOPLE, f"{ROW} long, id string, `full name` string, joined string"),
        "Buys": spark.createDataFrame(BUYS, f"{ROW} long, buy string, who string, n string, price string, total string, state string, extra string"),
    }
    return lambda _, sheet: tables[sheet]


@pytest.fixture(scope="module")
def result(spark, read):
    return run(spark, config(), read)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_cleaned_columns_stand_beside_raw_ones(result):
    people = result.tables()["people"].orderBy(F.col("name"))
    assert people.columns == ["id", "name", "joined", "id_cleaned", "name_cleaned", "joined_cleaned"]
    got = {r["name"]: (r["id_cleaned"], r["name_cleaned"], r["joined_cleaned"]) for r in people.collect()}
    assert got["ann lee"] == (1, "Ann Lee", dt.datetime(2020, 1, 13))
    assert got["BOB"] == (2, "Bob", dt.datetime(2022, 5, 9))
    assert got["x9"] == (2, "X9", None)
    # the blank row goes, the row with a space stays, the future date drops its row
    assert set(got) == {"ann lee", "BOB", "x9", "", "Ann Marie Longname"}


def test_clean_form_has_plain_names(result):
    assert result.tables("clean")["people"].dtypes == [("id", "bigint"), ("name", "string"), ("joined", "timestamp_ntz")]


def test_derived_mapped_and_extra(result):
    buys = {r["buy"]: r for r in result.tables()["buys"].collect()}
    assert [buys[k]["total_cleaned"] for k in ("10", "11", "12")] == [7.0, None, None]
    assert [buys[k]["state_cleaned"] for k in ("10", "11", "12")] == ["done", None, None]
    assert buys["10"]["extra"] == "note"
    assert {r["row"] for r in result.plans["buys"].not_computable().collect()} == {3, 4}


def test_issues(result):
    found = {(r["table"], r["column"], r["row"], r["severity"], r["rule"]) for r in result.issues().collect()}
    assert found == {
        ("people", "id", 3, "fail", "unique"), ("people", "id", 4, "fail", "unique"),
        ("people", "id", 5, "fail", "not_null"), ("people", "id", 6, "fail", "not_null"),
        ("people", "id", 5, "fail", "numeric_range"), ("people", "id", 6, "fail", "numeric_range"), ("people", "id", 8, "fail", "numeric_range"),
        ("people", "name", 4, "warn", "format"), ("people", "name", 5, "warn", "format"), ("people", "name", 8, "warn", "length"),
        ("people", "joined", 6, "drop", "date_range"),
        ("buys", "who", 3, "fail", "foreign_key"), ("buys", "who", 4, "fail", "foreign_key"),
    }
    top = {(r["column"], r["rule"]): (r["n"], r["first_rows"]) for r in summary(result.issues(), 2).collect()}
    assert top["id", "numeric_range"] == (3, [5, 6])


def test_null_stats(result):
    got = {r["col_name"]: tuple(r)[1:] for r in result.plans["people"].null_summary().collect()}
    assert got["id"] == (3, 3, 3, 2)
    assert got["joined"] == (2, 2, 2, 2)


def test_audit(result):
    found = {(r["table"], r["column"], r["row"]): (r["old"], r["new"]) for r in result.audit().collect()}
    assert found["people", "name", 2] == ("ann lee", "Ann Lee")
    assert found["people", "joined", 4] == ("apple", None)
    assert found["people", "id", 8] == ("x", None)
    assert ("people", "id", 2) not in found
    assert found["buys", "price", 2] == ("R 3.50", "3.5")
    assert found["buys", "total", 2] == ("0", "7")
    source = {(r["table"], r["column"], r["row"]): r["old"] for r in result.audit("source").collect()}
    assert source["people", "name", 2] == " ann lee "


def test_missing_column_and_reader(spark, read):
    plan = plan_table(read(spark, "People").drop("id"), "people", config().tables["people"], config().settings)
    assert ("id", None, "fail", "required") in {(r["column"], r["row"], r["severity"], r["rule"]) for r in plan.issues().collect()}
    with pytest.raises(ExtractorError, match="ordinal"):
        run(spark, config(), lambda s, sheet: read(s, sheet).drop(ROW))


def test_strict_mode_raises(spark, read):
    strict = lambda raw: raw["runtime"].update(strict_validation=True)
    with pytest.raises(ExtractorError, match="extra"):
        run(spark, config(strict), read)
    with pytest.raises(CleanerError, match="row 8") as e:
        run(spark, config(strict), lambda s, sheet: read(s, sheet).drop("extra"))
    assert e.value.to_dict()["column"] == "id"
    good = spark.createDataFrame([(0, "1", "a", None), (1, "1", "b", None)], f"{ROW} long, id string, name string, joined string")
    only = lambda raw: (strict(raw), raw["mappings"].pop("buys"), raw["columns"].pop("buys"))
    with pytest.raises(ValidatorError, match="fail: 2"):
        run(spark, config(only), lambda s, sheet: good)


def test_all_problems_come_at_once(tmp_path):
    def spoil(raw):
        raw.pop("cleaning")
        raw["source"]["header_row"] = -1
        raw["columns"]["People"]["ID"].pop("data_type")
        raw["columns"]["People"]["name"]["data_type"] = "varchar"
        raw["columns"]["buys"]["who"]["foreign_key"] = "nobody.id"
        raw["columns"]["buys"]["state"]["data_type"] = "uuid"
        raw["columns"]["buys"]["total"]["validation"]["derived_from"]["depends_on"] = ["gone"]
        raw["columns"]["buys"]["buy"]["primary_key"] = False

    with pytest.raises(SchemaError) as e:
        config(spoil)
    for part in ("Section cleaning", "header_row", "people.id: data_type", "needs a length", "nobody does not exist", "no data type uuid", "gone", "buys: no primary key"):
        assert part in str(e.value), part
    with pytest.raises(SchemaError, match="db_type oracle is unknown"):
        config(lambda raw: raw["target"].update(db_type="oracle"))
    with pytest.raises(ConfigError):
        load_config(tmp_path / "none.yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(RAW))
    loaded = load_config(tmp_path / "c.yaml")
    assert loaded.settings.row_offset == 2 and loaded.tables["people"]["name"].sources == ("full name", "name")
    assert warnings(config(lambda raw: raw["columns"]["People"]["joined"]["validation"].pop("max_value"))) == ["people.joined: date without both min_value and max_value"]


def test_config_dates_and_ddl():
    assert config_date("today", RUN) == dt.datetime(2026, 1, 31) and config_date(" ", RUN) is None and config_date(RUN, RUN) == dt.datetime(2026, 1, 31)
    with pytest.raises(SchemaError):
        config_date("soon", RUN)
    text = ddl("buys", config().tables["buys"])
    assert "[buy] int NOT NULL" in text and "PRIMARY KEY ([buy])" in text and "REFERENCES [dbo].[people] ([id])" in text


def test_no_python_in_the_plans(result):
    for plan in result.plans.values():
        text = plan.final()._jdf.queryExecution().toString()
        assert "Python" not in text and "ArrowEval" not in text and "MapInArrow" not in text


def test_rows_are_not_sorted_to_meet_the_keys_that_repeat(spark):
    """Many keys, few of them twice: the join becomes a broadcast once these are known, whatever the keys' own size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        df = spark.range(200_000).select(F.when(F.col("id") % 50_000 == 0, F.lit("twice")).otherwise(F.concat(F.lit("key "), "id")).alias("k"), "id")
        marked = mark_duplicates(df, "k", "again")
        assert sorted(r["id"] for r in marked.where("again").collect()) == [0, 50_000, 100_000, 150_000]
        counted = marked.groupBy("again").count()
        assert dict(counted.collect()) == {True: 4, False: 199_996}
        final = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
