"""The database sink over Derby, in this JVM: each row once, whatever fails on the way."""

import os
import subprocess
import sys
import textwrap
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cleanloom.errors import LoaderError
from cleanloom.sources import database
from cleanloom.sources.database import embedded_url, export_table, load_table
from cleanloom.sources.sinks import load

from .test_plan import config


@pytest.fixture
def url():
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def rows(spark, url, table="APP.T"):
    return Counter(tuple(r) for r in spark.read.jdbc(url, table).collect())


def frame(spark, start=0, end=100):
    return spark.range(start, end, 1, 4).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("v "), F.col("id"))).alias("odd name"))


def expected(start=0, end=100):
    return Counter((k, f"v {k}" if k % 7 else None) for k in range(start, end))


def test_a_run_loads_once(spark, url):
    assert load_table(frame(spark), url, "APP.T", "one") == 100
    assert load_table(frame(spark, 0, 5), url, "APP.T", "one") == 100 and rows(spark, url) == expected()
    assert load_table(frame(spark, 90, 130), url, "APP.T", "two") == 40 and rows(spark, url) == expected() + expected(90, 130)
    assert load_table(frame(spark, 7, 9), url, "APP.T", "three", "replace") == 2 and rows(spark, url) == expected(7, 9)
    with pytest.raises(LoaderError, match="there already"):
        load_table(frame(spark), url, "APP.T", "four", "fail")
    with pytest.raises(LoaderError, match="if_exists"):
        load_table(frame(spark), url, "APP.T", "five", "perhaps")
    assert load_table(frame(spark, 0, 0), url, "APP.EMPTY", "six") == 0 and not rows(spark, url, "APP.EMPTY")


def test_tasks_that_ran_twice(spark, url, monkeypatch):
    """What two attempts of every task have committed is taken over once."""
    fill = database.fill

    def twice(df, *args):
        fill(df, *args)
        fill(df.where("k < 60"), *args, mode="append")  # later attempts of the same partitions

    monkeypatch.setattr(database, "fill", twice)
    assert load_table(frame(spark), url, "APP.T", "one") == 100 and rows(spark, url) == expected()


def test_a_run_that_fails_leaves_the_target(spark, url, monkeypatch):
    load_table(frame(spark, 0, 10), url, "APP.T", "one")
    take_over = database.take_over
    monkeypatch.setattr(database, "take_over", lambda *args: take_over(*args) - 1)
    with pytest.raises(LoaderError, match="of 90 rows"):
        load_table(frame(spark, 10, 100), url, "APP.T", "two")
    assert rows(spark, url) == expected(0, 10)
    monkeypatch.undo()
    assert load_table(frame(spark, 10, 100), url, "APP.T", "two") == 90 and rows(spark, url) == expected()


def test_a_task_dies_half_way():
    """In a session whose tasks are tried again: the first attempts of all tasks die in the middle of their rows, in one after they were sent."""
    script = """
        import sys
        sys.path.insert(0, {root!r})
        from collections import Counter
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from cleanloom.sources import database
        spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.execution.arrow.maxRecordsPerBatch", "50").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        tagged = database._tagged

        def dies(batches):
            context = TaskContext.get()
            for n, b in enumerate(tagged(batches)):
                if context.attemptNumber() == 0 and n == 3:
                    raise RuntimeError("half-way")
                yield b
            if context.attemptNumber() == 1 and context.partitionId() == 1:
                raise RuntimeError("at the end")

        database._tagged = dies
        url = "jdbc:derby:memory:dies;create=true"
        df = spark.range(0, 2000, 1, 4).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
        assert database.load_table(df, url, "APP.T", "run", batch_size=20) == 2000
        got = Counter(r["k"] for r in spark.read.jdbc(url, "APP.T").collect())
        assert got == Counter(range(2000)), len(got)
        print("each row once")
    """.format(root=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert "each row once" in done.stdout, done.stderr[-3000:]


def test_load_names_its_delivery(spark, url, tmp_path):
    df = frame(spark, 0, 20)
    for _ in range(2):
        out = load({"t": df}, ["sql", "parquet"], str(tmp_path), config(lambda raw: raw["target"].update(schema="APP")), url=url, run="monday")
        assert out["sql"] == {"t": 20}
    assert sum(rows(spark, url, "APP.T").values()) == 20


def test_import_and_export_of_files(spark):
    """What the database reads and writes by itself, with texts that are awkward in CSV."""
    texts = ['a,"b"; c', "two\nlines", None, "", "  x ", 'back\\slash "q', "é €,", '"', "cr\r\nlf", "plain"]
    df = spark.createDataFrame([(k, t, k / 3 if t else None, t == "plain") for k, t in enumerate(texts)] + [(None, "no key", 1.0, None)], "k long, `odd name` string, d double, b boolean").repartition(3)
    url = embedded_url()
    assert load_table(df, url, "APP.T", "one", bulk=True) == 11 and load_table(df.limit(2), url, "APP.T", "one", bulk=True) == 11
    assert load_table(df.where("k > 7"), url, "APP.T", "two", bulk=True) == 2
    wanted = Counter(tuple(r) for r in df.union(df.where("k > 7")).collect())
    assert rows(spark, url) == wanted
    for parts in (1, 3):
        assert Counter(tuple(r) for r in export_table(spark, url, "APP.T", "k", 0, 10, parts).collect()) == wanted


def test_round_trip_where_executors_are_elsewhere():
    script = """
        import sys
        sys.path.insert(0, {root!r})
        import tempfile
        from pyspark.sql import SparkSession
        from cleanloom import queries
        shared = tempfile.mkdtemp()
        spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", "file://" + shared).getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        n = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
        back = queries.queries()["jdbc_round_trip"](spark, "/root/testdata/sf0.001")
        counts = dict(back.groupBy("run").count().collect())
        assert counts["first"] == n and 0 < counts["third"] < n, counts
        print("there and back")
    """.format(root=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert "there and back" in done.stdout, done.stderr[-3000:]
