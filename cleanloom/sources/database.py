"""Tables into a database over JDBC, every row once, whatever fails and is tried again.

1. The rows are written to the shared folder and read again, so that every attempt of a task has the same ones.
2. Tasks add them to a staging table, with the number of their partition and of their attempt. A task's rows are one transaction, so those of an attempt are
   all there or none; a task that runs twice, or is lost after it has committed, leaves two attempts.
3. One transaction on one connection takes the rows of each partition's first attempt over into the target, checks how many there are, and enters the
   run into a ledger. A run that is in the ledger has been loaded: doing it again does nothing.

A run that fails before that leaves the target as it was; its staging table is made anew when it is tried again. Rows never pass through the driver.

A database that lives in the driver's JVM (Derby, embedded) is out of executors' reach. With bulk=True step 2 is the database's own import: tasks write the rows as lines of CSV
into the shared folder, where Spark commits each partition once, and the database reads these files. `export_table` is the way back. On a local master no file is needed.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import LoaderError, Where
from ..shipping import ship
from ..staging import drop_path, hadoop, new_path

LEDGER, PART, ATTEMPT = "cleanloom_loads", "cleanloom_part", "cleanloom_attempt"
MODES = ("append", "replace", "fail")


def _tagged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    for b in batches:
        tags = [pa.array([x] * b.num_rows, pa.int64()) for x in (context.partitionId(), context.taskAttemptId())]
        yield pa.RecordBatch.from_arrays([*b.columns, *tags], [*b.schema.names, PART, ATTEMPT])


@contextmanager
def connected(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Iterator[Any]:
    """A connection of the driver's, as one transaction: committed at the end, rolled back if anything is raised."""
    jvm = spark.sparkContext._jvm
    given = jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        connection.setAutoCommit(False)
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _run(connection: Any, sql: str, *values: object) -> int:
    statement = connection.prepareStatement(sql)
    try:
        for k, v in enumerate(values, 1):
            statement.setString(k, v) if isinstance(v, str) else statement.setLong(k, v)
        return statement.executeUpdate()
    finally:
        statement.close()


def _number(connection: Any, sql: str, *values: str) -> int | None:
    """The first number that a query gives; None if it gives no row."""
    statement = connection.prepareStatement(sql)
    try:
        for k, v in enumerate(values, 1):
            statement.setString(k, v)
        found = statement.executeQuery()
        return found.getLong(1) if found.next() else None
    finally:
        statement.close()


def _there(spark: SparkSession, url: str, properties: Mapping[str, str], table: str) -> bool:
    try:
        with connected(spark, url, properties) as c:
            _number(c, f"SELECT COUNT(*) FROM {table} WHERE 1 = 0")
        return True
    except Py4JJavaError:
        return False


def fill(rows: DataFrame, url: str, staging: str, properties: Mapping[str, str], batch_size: int, mode: str = "overwrite") -> None:
    """The rows, each with its partition and attempt, into the staging table."""
    kind = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema)
    tagged = rows.mapInArrow(_tagged, f"{kind}, {PART} long, {ATTEMPT} long")
    tagged.write.mode(mode).option("batchsize", batch_size).jdbc(url, staging, properties=dict(properties))


def embedded_url() -> str:
    """A Derby database on the driver's disk, for as long as the driver runs: however large, it takes no more memory than Derby's cache of pages."""
    folder = tempfile.mkdtemp(prefix="cleanloom-derby-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"jdbc:derby:{folder}/db;create=true"


def _call(connection: Any, procedure: str, *values: str | int | None) -> None:
    statement = connection.prepareCall(f"CALL SYSCS_UTIL.{procedure}({', '.join('?' * len(values))})")
    try:
        for k, v in enumerate(values, 1):
            statement.setNull(k, 12) if v is None else statement.setString(k, v) if isinstance(v, str) else statement.setShort(k, v)  # 12: VARCHAR
        statement.execute()
    finally:
        statement.close()


def _as_line(rows: DataFrame) -> Column:
    """A row as Derby imports it: texts in quotes, whatever they hold, null as nothing, bytes in hex."""

    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name.replace('`', '``')}`")
        if kind == "string":
            return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.hex(c) if kind == "binary" else c.cast("string")

    return F.concat_ws(",", *(F.coalesce(cell(c, k), F.lit("")) for c, k in rows.dtypes))


def bulk_fill(rows: DataFrame, url: str, staging: str, properties: Mapping[str, str]) -> None:
    """As fill, by the database's own import of files that tasks have written. They are copied to the driver's disk one at a time."""
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "bulk")
    tagged = rows.select("*", F.spark_partition_id().cast("long").alias(PART), F.lit(0).cast("long").alias(ATTEMPT))
    tagged.limit(0).write.mode("overwrite").jdbc(url, staging, properties=dict(properties))
    schema, _, name = staging.rpartition(".")
    try:
        tagged.select(_as_line(tagged).alias("line")).write.text(path)
        files, at = hadoop(spark, path)
        with tempfile.TemporaryDirectory() as beside, connected(spark, url, properties) as c:
            for k, f in enumerate(files.listStatus(at)):
                if f.getLen() and f.getPath().getName().startswith("part-"):
                    one = f"{beside}/{k}.csv"
                    files.copyToLocalFile(False, f.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{one}"), True)
                    _call(c, "SYSCS_IMPORT_DATA", schema.upper() or None, name.upper(), None, None, one, ",", '"', "UTF-8", 0)
                    os.remove(one)
    finally:
        drop_path(spark, path)


def export_table(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """The table of an embedded database as spark.read.jdbc gives it, by the database's own export: `parts` files in the shared folder, by ranges of a column of whole numbers."""
    properties, path, missing = dict(properties or {}), new_path(spark, "export"), uuid.uuid4().hex
    files, to = hadoop(spark, path)
    files.mkdirs(to)
    kind = spark.read.jdbc(url, table, properties=properties).schema
    bounds = [lower + (upper - lower) * k // parts for k in range(1, parts)]
    with tempfile.TemporaryDirectory() as beside, connected(spark, url, properties) as c:
        quoted = '"' + column.replace('"', '""') + '"'
        for k, (a, b) in enumerate(zip([None, *bounds], [*bounds, None], strict=True)):
            inside = [f"{quoted} >= {a}"] * (a is not None) + [f"{quoted} < {b}"] * (b is not None)
            where = f" WHERE {' AND '.join(inside)}" if inside else ""
            where += f"{' OR' if inside else ' WHERE'} {quoted} IS NULL" if a is None and inside else ""
            _call(c, "SYSCS_EXPORT_QUERY", f"SELECT * FROM {table}{where}", f"{beside}/{k}.csv", None, None, "UTF-8")
            files.copyFromLocalFile(True, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{beside}/{k}.csv"), to)
    return spark.read.schema(kind).option("escape", '"').option("multiLine", True).option("nullValue", missing).csv(path)


def take_over(connection: Any, staging: str, target: str, columns: list[str], mode: str) -> int:
    """The rows of each partition's first attempt go from the staging table to the target: how many."""
    mark = connection.getMetaData().getIdentifierQuoteString().strip()
    quoted = lambda c: f"{mark}{c.replace(mark, mark * 2) if mark else c}{mark}"
    names, part, attempt = ", ".join(map(quoted, columns)), quoted(PART), quoted(ATTEMPT)
    if mode == "replace":
        _run(connection, f"DELETE FROM {target}")
    own = ", ".join(f"s.{quoted(c)}" for c in columns)
    first = f"SELECT {part} AS p, MIN({attempt}) AS a FROM {staging} GROUP BY {part}"
    return _run(connection, f"INSERT INTO {target} ({names}) SELECT {own} FROM {staging} s JOIN ({first}) k ON s.{part} = k.p AND s.{attempt} = k.a")


def load_table(df: DataFrame, url: str, target: str, run: str, mode: str = "append", properties: Mapping[str, str] | None = None, batch_size: int = 1000, bulk: bool = False) -> int:
    """df's rows into the table target, which is made if it is not there; how many rows the run has loaded. run names this delivery: the same run
    again loads nothing. mode: append; replace, in the same transaction; fail if the table is there. bulk: the database is in this JVM, and executors are not."""
    if mode not in MODES:
        raise LoaderError(f"if_exists is one of {', '.join(MODES)}")
    spark, properties = df.sparkSession, dict(properties or {})
    ship(spark)
    schema = target.rpartition(".")[0]
    named = lambda t: f"{schema}.{t}" if schema else t
    ledger = named(LEDGER)
    key = hashlib.sha256(f"{run} {target}".encode()).hexdigest()[:16]
    if not _there(spark, url, properties, ledger):
        with connected(spark, url, properties) as c:
            _run(c, f"CREATE TABLE {ledger} (run VARCHAR(200) NOT NULL, target VARCHAR(200) NOT NULL, n BIGINT NOT NULL, PRIMARY KEY (run, target))")
    with connected(spark, url, properties) as c:
        done = _number(c, f"SELECT n FROM {ledger} WHERE run = ? AND target = ?", run, target)
    if done is not None:
        return done
    if mode == "fail" and _there(spark, url, properties, target):
        raise LoaderError(f"The table {target} is there already", Where(target))
    path, staging = new_path(spark, "load"), named(f"cleanloom_load_{key}")
    try:
        df.write.parquet(path)
        rows = spark.read.schema(df.schema).parquet(path)
        expected = rows.count()
        rows.limit(0).write.mode("append").jdbc(url, target, properties=properties)  # makes a table that is not there
        bulk_fill(rows, url, staging, properties) if bulk else fill(rows, url, staging, properties, batch_size)
        with connected(spark, url, properties) as c:
            n = take_over(c, staging, target, rows.columns, mode)
            if n != expected:
                raise LoaderError(f"{n} of {expected} rows came to {target}", Where(target))
            _run(c, f"INSERT INTO {ledger} (run, target, n) VALUES (?, ?, ?)", run, target, n)
        with connected(spark, url, properties) as c:
            _run(c, f"DROP TABLE {staging}")
    finally:
        drop_path(spark, path)
    return n
