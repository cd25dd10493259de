"""Kept keys: no exchange on their side, further deliveries, nulls and hot keys."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from cleanloom.operators.kept_keys import add_keys, keep_keys, mark_missing, missing_keys


@pytest.fixture
def kept(spark, tmp_path):
    parent = spark.createDataFrame([(k % 50 if k % 7 else None,) for k in range(300)], "id long")
    name = f"kept_{uuid.uuid4().hex}"
    yield keep_keys(parent, "id", name, 8, str(tmp_path / "keys"))
    spark.sql(f"DROP TABLE {name}")


def test_keys_are_kept_once(spark, kept):
    assert sorted(r[0] for r in kept.frame(spark).collect()) == list(range(50))
    add_keys(spark.range(40, 60).withColumnRenamed("id", "k"), "k", kept)
    add_keys(spark.range(40, 60).withColumnRenamed("id", "k"), "k", kept)
    assert sorted(r[0] for r in kept.frame(spark).collect()) == list(range(60))
    assert missing_keys(spark.range(55, 63).withColumnRenamed("id", "k"), "k", kept).count() == 3


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_the_parent_does_not_move(spark, kept, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = missing_keys(spark.range(0, 100, 1, 3).withColumnRenamed("id", "k"), "k", kept)
        assert sorted(r[0] for r in found.collect()) == list(range(50, 100))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        after = plan[plan.index("SortMergeJoin") :]
        parent = after[: after.index(kept.table)] if kept.table in after else after
        scans = [m.start() for m in re.finditer("FileScan parquet", after)]
        assert "Bucketed: true" in after and scans
        last_exchange = after.rfind("Exchange", 0, scans[-1])
        assert "Range" in after[last_exchange : scans[-1]] and parent  # the exchange above belongs to the child
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_marks(spark, kept):
    rows = [("1",), ("1",), ("99",), (" ",), (None,), ("x",), *[("77",)] * 50]
    child = spark.createDataFrame(rows, "k string")
    kept_text = keep_keys(spark.createDataFrame([("1",), ("2",)], "id string"), "id", f"{kept.table}_text", 4)
    for allow in (True, False):
        got = mark_missing(child, "k", kept_text, "m", allow)
        assert got.columns == ["k", "m"] and sorted(map(tuple, got.collect()), key=repr) == sorted(((k, (not allow) if k is None or not k.strip() else k != "1") for (k,) in rows), key=repr)
    spark.sql(f"DROP TABLE {kept_text.table}")
    assert mark_missing(spark.range(48, 53).select(F.col("id").alias("k")), "k", kept, "m").where("m").count() == 3
