"""Counts that come with a write: one job, one scan, the same as the passes of their own."""

import copy

import pytest
from pyspark.sql import functions as F

from cleanloom.config import parse_config
from cleanloom.plans.engine import run
from cleanloom.plans.table import ROW, plan_table

from .test_plan import BUYS, PEOPLE, RAW, RUN


def same(plan, seen):
    stats = {(r["col_name"], r["stage"], r["nulls"]) for r in plan.null_stats().collect()}
    counts = {r["severity"]: r["n"] for r in plan.severity_counts().collect()}
    assert set(seen.null_stats()) == stats and seen.severities() == counts
    assert seen.counts["blank"] == plan.blank_rows().first()["blank_rows"] and seen.counts["all"] == plan.df.count()


@pytest.fixture
def plans(spark):
    tables = {
        "People": spark.createDataFrame(PEOPLE, f"{ROW} long, id string, `full name` string, joined string"),
        "Buys": spark.createDataFrame(BUYS, f"{ROW} long, buy string, who string, n string, price string, total string, state string, extra string").drop("state"),
    }
    raw = copy.deepcopy(RAW)
    raw["columns"]["buys"]["state"].update(allow_null=False, required=True)
    return run(spark, parse_config(raw, run_date=RUN), lambda _, sheet: tables[sheet])


def test_observed_counts_equal_their_own_passes(plans, tmp_path):
    tables, observed = plans.observed()
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        assert df.columns == plans.plans[name].final().columns
        same(plans.plans[name], observed[name])
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, plans.plans[name].final().collect()), key=repr)
    assert observed["buys"].severities()["fail"] >= 1  # the column state is missing


def test_one_job_scans_the_source_once(spark, tmp_path):
    source = str(tmp_path / "source")
    data = [(k, str(k) if k % 5 else None, " x " if k % 3 else "N/A", "5" if k % 2 else "much") for k in range(3000)] + [(3000, None, " ", None)]
    spark.createDataFrame(data, f"{ROW} long, a string, b string, c string").coalesce(1).write.parquet(source)
    raw = copy.deepcopy(RAW)
    raw["columns"]["People"] = {
        "a": {"source_column": "a", "data_type": "varchar(9)", "allow_null": False, "primary_key": True},  # without rules, so its repeats are not looked for
        "b": {"source_column": "b", "data_type": "varchar(2)", "allow_null": False, "validation": {"on_error": "warn"}},
        "c": {"source_column": "c", "data_type": "int", "allow_null": True, "validation": {"on_error": "drop", "min_value": 9}},
    }
    raw["columns"]["buys"]["who"].pop("foreign_key")
    config = parse_config(raw, run_date=RUN)
    plan = plan_table(spark.read.parquet(source), "people", config.tables["people"], config.settings)
    df, seen = plan.observed()
    group = "observed-write"
    spark.sparkContext.setJobGroup(group, group)
    df.write.parquet(str(tmp_path / "out"))
    spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getJobIdsForGroup(group)
    assert len(jobs) == 1
    stages = tracker.getJobInfo(jobs[0]).stageIds
    store = spark.sparkContext._jsc.sc().statusStore()
    assert sum(store.lastStageAttempt(s).inputRecords() for s in stages) == len(data)
    same(plan, seen)
    assert spark.read.parquet(str(tmp_path / "out")).count() == plan.final().count() == plan.df.where(~F.col("__blank") & ~F.col("__dropped")).count()
