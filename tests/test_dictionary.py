"""Dictionaries as tables against the literal map."""

import pytest
from pyspark.sql import functions as F

from cleanloom.errors import SchemaError
from cleanloom.functions.strings import map_values
from cleanloom.operators import dictionary
from cleanloom.operators.dictionary import apply_dictionary, entries
from cleanloom.plans.engine import run

from . import test_plan
from .test_plan import config, read  # noqa: F401

VALUES = [" a ", "A", "b", "\tB\n", "", None, "none", "é", "É ", "x" * 500, None, "a"]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_the_same_rows_as_the_literal_map(spark, broadcast):
    mapping = {"first": ["A ", "é"], "second": ["b", "x" * 500], "empty": [""], "again": ["A"]}
    df = spark.createDataFrame(list(enumerate(VALUES)), "i int, v string").repartition(3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = apply_dictionary(df, F.col("v"), entries(spark, mapping), "out")
        assert got.columns == ["i", "v", "out"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.withColumn("out", map_values(F.col("v"), mapping)).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_raw_values_with_several_labels_are_refused(spark):
    table = spark.createDataFrame([("a", "x"), ("A ", "x"), ("b", "y"), (" B", "z"), (None, "n")], "raw string, label string")
    with pytest.raises(SchemaError, match="several labels: b"):
        dictionary.dictionary(table)
    assert sorted(map(tuple, dictionary.dictionary(table.where("label <> 'z'")).collect())) == [("a", "x"), ("b", "y")]
    with pytest.raises(SchemaError, match="several labels"):
        dictionary.dictionary(spark.createDataFrame([("a", "x"), ("a", None)], "raw string, label string"))


def test_large_mappings_of_a_configuration_are_joined(spark, read, monkeypatch):  # noqa: F811
    plain = test_plan.rows(run(spark, config(), read).plans["buys"].final().orderBy("buy"))
    monkeypatch.setattr(dictionary, "LITERAL", 0)
    joined = run(spark, config(), read).plans["buys"]
    assert "Join" in joined.df._jdf.queryExecution().optimizedPlan().toString() and test_plan.rows(joined.final().orderBy("buy")) == plain
