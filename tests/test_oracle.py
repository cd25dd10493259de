"""Every query of the table engine against its SQL in DuckDB, over the smallest tables."""

import math
import os

import duckdb
import pytest

from cleanloom import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(x):
    return ("nan" if math.isnan(x) else round(x, 6)) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(value(r[c]) for c in names) for r in df.collect()), key=repr)
    sql = queries.oracle_sql()[name]
    expected = sorted((tuple(map(value, r)) for r in duck.execute(f"SELECT {', '.join(f'"{c}"' for c in names)} FROM ({sql})").fetchall()), key=repr)
    assert got == expected
    assert got or name in ("not_null",)


def test_formula_corners_of_null_keys(spark, tmp_path):
    from itertools import product

    keys = list(product([None, 0, 5], [None, *range(7)], [None, *range(5), 7]))
    spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    df = queries.queries()["formula_corners"](spark, str(tmp_path)).orderBy("l_linenumber")
    expected = con.execute(f"SELECT {', '.join(f'"{c}"' for c in df.columns)} FROM ({queries.oracle_sql()['formula_corners']}) ORDER BY l_linenumber").fetchall()
    assert [tuple(map(value, r)) for r in df.collect()] == [tuple(map(value, r)) for r in expected]


def test_every_query_has_sql():
    assert set(queries.queries()) == set(queries.oracle_sql())
