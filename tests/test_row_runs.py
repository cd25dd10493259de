"""Runs of rows against Python, with runs over block edges, repeats and rows without a number."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cleanloom.operators.row_runs import first_rows, row_runs, run_lists

SCHEMA = "table string, column string, row long, severity string, rule string, message string"


def islands(rows):
    out = []
    for r in sorted(set(rows)):
        if out and out[-1][1] == r - 1:
            out[-1][1] = r
        else:
            out.append([r, r])
    return [tuple(x) for x in out]


@pytest.fixture(scope="module")
def found(spark):
    rng, rows = random.Random(5), defaultdict(list)
    rows["a", "hot"] = list(range(2, 900)) + list(range(950, 1003)) + [5000, 5001, 5001, 5001]
    rows["b", "few"] = [7, 8, 64, 63, 127, 128, 129, 255, 256]
    rows["b", "mixed"] = [rng.randrange(600) for _ in range(500)]
    rows["c", "edge"] = [*range(64, 128), *range(192, 256), 0]
    rows["d", "missing"] = [None]
    data = [("t", c, r, "fail", rule, "m") for (c, rule), v in rows.items() for r in v]
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA).repartition(3), rows


@pytest.mark.parametrize("block", [1, 2, 64, 1 << 16])
def test_runs(found, block):
    df, rows = found
    got = defaultdict(list)
    for r in row_runs(df, block=block).collect():
        got[r["column"], r["rule"]].append((r["first"], r["last"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: islands(v) if v != [None] else [(None, None)] for k, v in rows.items()}


def test_lists_and_first_rows(found):
    df, rows = found
    runs = row_runs(df, block=64)
    lists, n = defaultdict(list), defaultdict(int)
    for r in run_lists(runs, span=100).orderBy("chunk").collect():
        n[r["column"], r["rule"]] += r["n"]
        for part in r["rows"].split(", "):
            lists[r["column"], r["rule"]].append(tuple(map(int, (part.split("-") * 2)[:2])))
            assert r["chunk"] <= lists[r["column"], r["rule"]][-1][0] < r["chunk"] + 100
    assert lists == {k: islands(v) for k, v in rows.items() if v != [None]} and n == {k: len(set(v)) for k, v in rows.items() if v != [None]}
    top = {(r["column"], r["rule"]): r["first_rows"] for r in first_rows(runs, most=5).collect()}
    assert top == {k: sorted(set(v))[:5] if v != [None] else [] for k, v in rows.items()}


def test_no_issues(spark):
    assert row_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_hot_rule_is_spread_over_blocks(found):
    """Rows move by key and block; what moves by the key alone are runs at the edges of blocks."""
    df, _ = found
    plan = row_runs(df, block=64)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(table" in line]
    assert any("__block" in line for line in moved)
    one = row_runs(df.where(F.col("rule") == "hot"), block=64)
    assert one.count() == 3
