"""Exact deduplication as a stateful stream, with DataFrame functions only.

A first pass writes, for every row, the SHA-256 of its normalised text and where the text lies (file and
row of the Parquet scan). A file stream reads these fingerprints; its aggregation keeps in RocksDB, for each
digest and without expiry, the count, and the largest identifier with its content locator. Partial sums come
before the shuffle, so a group with a third of all rows reaches a state partition as one row per task. Hits, digests of
more than one row, are then checked on full bytes: only their texts move, and of those a task sends the least and the largest of a
digest; digests for which these differ (collisions) are regrouped by the text itself. Where the hits' digests are small
by Spark's own estimate they are broadcast to the scan; otherwise its Bloom filter, of a bounded size, keeps most other texts
out of the shuffle.

With a state folder, state, checkpoint and fingerprints stay: a later call with the same folder, for a further delivery of rows, resumes
the stream there, and its verdict counts all deliveries. The texts of the earlier deliveries' files are read again on hits, so those files must
stay. Should a digest be that of another text in an earlier delivery, that is an error.

Defined results: null text counts as empty; only A-Z are lower-cased; of equal texts the row with the largest
identifier stays (null identifiers are smallest); if that identifier occurs more than once in the group, the row
last by (file, row) stays, so one row stays in every group. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from string import ascii_lowercase, ascii_uppercase

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import hadoop
from .common import drop_path, free_name, new_path, stage, unstage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: RocksDB would set aside 4 MB of disk for each log of each partition, however little it holds, and memory for each partition
ROCKS = "spark.sql.streaming.stateStore.rocksdb"
#: join filters of at most 8 MB, however small the scan
FILTERS = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10GB"}
STATE = {PROVIDER: ROCKSDB, f"{ROCKS}.allowFAllocate": "false", f"{ROCKS}.boundedMemoryUsage": "true", f"{ROCKS}.maxMemoryUsageMB": "64"}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


def is_scan(docs: DataFrame) -> bool:
    """Whether docs is one table's scan with nothing but projections and filters over it, the same at every reading."""
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def located(docs: DataFrame, to: str | None = None) -> tuple[DataFrame, Column, Column]:
    """docs as a Parquet scan, and the columns that say where each row lies in it. What is no such scan is written first (to)."""
    try:
        at = docs.metadataColumn("_metadata")
        docs.select(at["file_path"], at["row_index"])  # only Parquet scans have row_index
        if is_scan(docs):
            return docs, at["file_path"], at["row_index"]
    except AnalysisException:
        pass
    if to:
        docs.write.parquet(to)
        docs = docs.sparkSession.read.schema(docs.schema).parquet(to)
    else:
        docs = stage(docs, "located-rows")
    at = docs.metadataColumn("_metadata")
    return docs, at["file_path"], at["row_index"]


def _last(state: DataFrame) -> DataFrame:
    """A key that several batches touched was put out by each of them; its last value is the largest."""
    return state.groupBy("key").agg(F.max("n").alias("n"), F.max("keep").alias("keep"))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers at the ends of the names in a folder; none where there is no folder."""
    files, at = hadoop(spark, path)
    names = [s.getPath().getName().rpartition("=")[2] for s in files.listStatus(at)] if files.exists(at) else []
    return sorted(int(n) for n in names if n.isdecimal())


def _state(prints: DataFrame, at: str, batch_bytes: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(what the keyed state holds, after the stream has read all fingerprints under `at`, for the digests that it met now; and what it held
    of any digest before, None in a first run)"""
    spark, out = prints.sparkSession, f"{at}/kept"
    reader = spark.readStream.schema(prints.schema)
    if batch_bytes:
        reader = reader.option("maxBytesPerTrigger", str(batch_bytes))
    kept = reader.parquet(f"{at}/prints/*").groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))
    done = max(_numbers(spark, f"{at}/checkpoint/commits"), default=-1)  # the last batch of earlier deliveries
    with settings(spark, STATE):
        run = (
            kept.writeStream.outputMode("update")
            .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .option("checkpointLocation", f"{at}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    batches = [b for b in _numbers(spark, out) if b > done]  # as they were written: a stream reports only its latest batches
    if not batches:
        return spark.createDataFrame([], kept.schema), None
    state = spark.read.schema(f"{_ddl(kept)}, batch long").parquet(out)
    now = state.where(F.col("batch") > done).drop("batch")
    now = now if len(batches) == 1 else stage(_last(now), "dedup-last")
    return now, (_last(state.where(F.col("batch") <= done)) if done >= 0 else None)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, digest_bytes: int, at: str) -> tuple[DataFrame, DataFrame]:
    """(docs as a scan with locators, their fingerprints key, sha, id, file, row, written to a folder of their own under `at`)"""
    spark, name = docs.sparkSession, uuid.uuid4().hex
    scan, file, row = located(docs, f"{at}/rows-{name}")
    sha = F.unhex(F.sha2(normalised(scan[text_col]), 256))
    prints = scan.select(scan[id_col].alias("id"), sha.alias("sha"), file.alias("file"), row.alias("row")).withColumn("key", F.substring("sha", 1, digest_bytes))
    prints.write.parquet(f"{at}/prints/{name}")
    return scan, spark.read.schema(prints.schema).parquet(f"{at}/prints/{name}")


def _different(texts: DataFrame) -> DataFrame:
    """The keys of more than one text: a task hands on two texts of a key at most."""
    return texts.groupBy("key").agg(F.min("text").alias("least"), F.max("text").alias("most")).where("least <> most").select("key")


def _check_before(spark: SparkSession, hits: DataFrame, before: DataFrame, text_col: str) -> None:
    """The texts of hits (key, text) against those that earlier deliveries kept for the same digest."""
    met = stage(before.join(hits.select("key").distinct(), "key", "left_semi").select("key", "keep.file", "keep.row"), "dedup-met")
    files = [r[0] for r in met.select("file").distinct().collect()]  # of the earlier deliveries' files, which the driver has listed before
    if files:
        old = spark.read.parquet(*files)
        at = old.metadataColumn("_metadata")
        place = (at["file_path"] == met["file"]) & (at["row_index"] == met["row"])
        texts = old.join(met, place).select("key", normalised(old[text_col]).alias("text"))
        if not _different(texts.unionByName(hits.select("key", "text"))).isEmpty():
            raise ValueError("a digest of an earlier delivery belongs to another text")
    unstage(met)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, state: str | None = None, digest_bytes: int = 32, batch_bytes: int | None = None) -> DataFrame:
    """One row for every row of docs: id, keep_id, group_size, kept, sha (of the normalised text), file, row.

    state: a folder that keeps the state from one delivery to the next (None: one of our own, for this call).
    digest_bytes: how much of the SHA-256 keys the state; less than 32 is for tests of the byte check.
    batch_bytes: most bytes of fingerprints in a micro-batch (None: all that are there).
    """
    spark = docs.sparkSession
    at = state or new_path(spark, "dedup-state")
    scan, prints = fingerprints(docs, id_col, text_col, digest_bytes, at)
    known, before = _state(prints, at, batch_bytes)
    if not state:
        drop_path(spark, f"{at}/checkpoint")
    own = F.struct("id", "file", "row")
    verdict = prints.join(known, "key").select("key", "id", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"), own.eqNullSafe(F.col("keep")).alias("kept"), "sha", "file", "row")
    texts, file, row = located(scan)
    text = normalised(texts[text_col])
    keyed = texts.select(F.substring(F.unhex(F.sha2(text, 256)), 1, digest_bytes).alias("key"), texts[id_col].alias("id"), text.alias("text"), file.alias("file"), row.alias("row"))
    again = stage(known.where("n > 1").select("key", "n"), "dedup-hits", 10_000)
    with settings(spark, FILTERS):
        hits = keyed.join(again.where("n > 1"), "key", "left_semi")
        collided = stage(_different(hits), "dedup-collided")
        if before is not None:
            _check_before(spark, hits, before, text_col)
    if collided.isEmpty():
        unstage(collided, again)
        return verdict.drop("key")
    # the same digest of different texts: the text itself is the key
    apart = stage(keyed.join(collided, "key", "left_semi"), "dedup-apart")
    by_text = apart.groupBy("text").agg(F.count("*").alias("group_size"), F.max(own).alias("keep"))
    again = apart.join(by_text, "text").select("id", F.col("keep.id").alias("keep_id"), "group_size", own.eqNullSafe(F.col("keep")).alias("kept"), F.unhex(F.sha2("text", 256)).alias("sha"), "file", "row")
    return verdict.join(collided, "key", "left_anti").drop("key").unionByName(again)


def texts_at(scan: DataFrame, text_col: str, places: DataFrame, *columns: str) -> DataFrame:
    """The columns of places (f, r and others) with the text of the scan's row r of file f. Both sides have a hash of the place too: under FILTERS,
    Spark's Bloom filter of it keeps texts that are not asked for out of the shuffle, which filters of files and of rows by themselves could not.
    The side to be filtered comes first."""
    _, file, row = located(scan)
    whole = scan.select(file.alias("file"), row.alias("row"), scan[text_col].cast("string").alias("text"))
    same = (F.xxhash64("f", "r") == F.xxhash64("file", "row")) & (F.col("f") == F.col("file")) & (F.col("r") == F.col("row"))
    return whole.join(places.where("r >= 0"), same).select(*columns, "text")


def without(scan: DataFrame, dropped: DataFrame) -> DataFrame:
    """scan without the rows of dropped (file, row); columns as they were. What is dropped is written first: of known size, it is
    broadcast to the scan if it is small."""
    gone = stage(dropped.select(F.col("file").alias("__file"), F.col("row").alias("__row")), "dropped", 10_000)
    _, file, row = located(scan)
    f, r = free_name(scan, "at_file"), free_name(scan, "at_row")
    tagged = scan.select("*", file.alias(f), row.alias(r))
    return tagged.join(gone, (tagged[f] == gone["__file"]) & (tagged[r] == gone["__row"]), "left_anti").drop(f, r)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that exact_dedup drops; columns as they were."""
    scan, _, _ = located(docs)
    verdict = exact_dedup(scan, id_col, text_col, **options)
    return without(scan, verdict.where("not kept"))
