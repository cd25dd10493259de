"""Mixing sources to target weights by weighted fair queueing.

Each document gets a place in the shuffled queue of its source and a virtual finish time, the source's tokens up to and with
it divided by the source's target. At virtual time 1 every queue has given exactly its target, so cutting the merged stream
at virtual time 1 is cutting it at the total budget, the sum of the targets. A source whose target exceeds its size is
queued again, up to `MOST` times. The schedule is range-sorted by virtual finish time.

A source may hold any share of the rows: queues are cut into cells by the shuffle hash, so many that a cell has about `CELL_ROWS` rows
where one source holds all; cell sums are added up in a table of a row for each cell, and only the rows of one cell are ordered together.
There may be any number of sources: they are ranked by a range-sort, never in one task.

Defined results: null text has size 0; null is a source of its own, the last; rows with the same id (or equal rows) are
mixed one by one; where all sizes are 0 all targets are 0; in the stream of whole documents those of size 0 are dropped; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, free_name, listed, numbered, partitions, stage, unstage
from .exact_dedup import located

#: times that a document is taken at most, rows of a cell if one source holds all rows
MOST, CELL_ROWS = 3, 4096
#: rows and words that a range of the sorted results holds, sources that a range of the sources holds
ROWS, WORDS, SOURCES = 2_000_000, 16_000_000, 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """sources, one row per source, with place: their rank by code point from 0, null last."""
    spark = sources.sparkSession
    light = stage(sources, "mix-sizes", 10_000)
    out, before = numbered(light, [F.col("source").asc_nulls_last()], max(1, -(-light.count() // SOURCES)), "mix-ranked")
    unstage(light)
    ranges = listed(spark, {"part": range(len(before)), "before": before}, "part long, before long")  # a number for each range
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn("part", part).join(F.broadcast(ranges), "part").withColumn("place", F.col("before") + place).drop("part", "before", "at")


def targets(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """sources (source, source_size), one row per source, with weight and target. The common level rises until the sources
    under their ceiling take what the others cannot; the sums go to the driver in each round, and rounds end when no more sources
    are full (a fuller one stays full, so there are as many rounds as sources at most, and in practice a few)."""
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod("place", F.lit(len(weights))).cast("int") + 1)
    weighed = stage(ranked(sources).withColumn("weight", weight), "mix-sources", 10_000)
    total, level, full_before = weighed.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    size = F.col("source_size")
    while total:
        full = F.col("weight") * level > size * float(MOST)
        # whole numbers, whose sums do not depend on the order of tasks
        n_full, given, open_weight = weighed.agg(F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, size)), F.lit(0)), F.sum(F.when(~full, F.col("weight").cast("decimal(18,6)")))).first()
        if n_full == full_before or not open_weight:
            break
        level, full_before = (total - MOST * given) / float(open_weight), n_full
    return weighed.drop("place").withColumn("target", F.least(F.col("weight") * level, size * float(MOST)))


def cell_bits(rows: int) -> int:
    return max(12, (rows // CELL_ROWS).bit_length())


def queue(rows: DataFrame, weights: tuple[float, ...], seed: int, whole: bool) -> DataFrame:
    """rows (id, source, size, text_hash and others) with source_size, target, taken and finish."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    bits = cell_bits(rows.count())
    keyed = rows.withColumn("place", F.xxhash64(F.lit(seed), "id", "text_hash")).withColumn("cell", F.shiftrightunsigned("place", 64 - bits))
    cells = keyed.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    before = F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell")) - F.col("cell_size")
    cells = cells.withColumn("before", before).drop("cell_size")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    cells = cells.join(sources, same(cells, sources)).select(cells["source"], "cell", "before", "source_size", "target")
    cells = stage(cells, "mix-cells")
    joined = keyed.join(cells, same(keyed, cells) & (keyed["cell"] == cells["cell"])).select(*[keyed[c] for c in keyed.columns], "before", "source_size", "target")
    upto = F.sum("size").over(Window.partitionBy("source", "cell").orderBy("place", "id", "text_hash").rowsBetween(Window.unboundedPreceding, 0))
    placed = joined.withColumn("end", F.col("before") + upto)
    taken = F.lit(0)
    for again in range(MOST):
        start = F.col("end") - F.col("size") + F.col("source_size") * again
        if whole:  # the copy over the cut is taken if at least half of it lies before
            taken = taken + F.when(start + F.col("size") / 2 <= F.col("target"), F.col("size")).otherwise(0)
        else:
            taken = taken + F.least(F.greatest(F.floor("target") - start, F.lit(0)), F.col("size"))
    finish = F.col("end") / F.when(F.col("target") > 0, F.col("target"))
    return placed.withColumn("taken", taken.cast("long")).withColumn("finish", F.coalesce(finish, F.lit(0.0))).drop("cell", "before", "end")


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[float, ...] = (5, 2, 1), seed: int = 17, whole: bool = False) -> DataFrame:
    """One row per row of docs, range-sorted by the virtual finish time of its first copy: id, source, size, source_size,
    target, taken (tokens over all copies), finish, file, row. whole: documents are taken whole or not, each time."""
    scan, file, row = located(docs)
    text = F.coalesce(scan[text_col], F.lit(""))
    light = scan.select(scan[id_col].alias("id"), scan[source_col].alias("source"), words(text).alias("size"), F.xxhash64(text).alias("text_hash"), file.alias("file"), row.alias("row"))
    light = stage(light, "mix-rows")
    placed = queue(light, weights, seed, whole)
    n = partitions(docs.sparkSession, light.count(), ROWS)
    return placed.repartitionByRange(n, "finish", "place").sortWithinPartitions("finish", "place").drop("place", "text_hash")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed stream: the documents of docs, each as often as it is taken (whole), in order of virtual finish time. Documents of
    size 0 (null, empty, only ASCII white space) give a source no words and are dropped."""
    forget(docs.sparkSession)
    scan, _, _ = located(docs)
    plan = stage(schedule(scan, id_col, text_col, source_col, whole=True, **options).where("taken > 0"), "mix-plan")
    _, file, row = located(scan)
    f, r, t, k = (free_name(scan, x) for x in ("at_file", "at_row", "mix_finish", "mix_again"))
    copies = plan.select(F.col("file").alias("__f"), F.col("row").alias("__r"), F.posexplode(F.array_repeat(F.col("finish"), (F.col("taken") / F.col("size")).cast("int"))).alias(k, "__t"), (F.col("source_size") / F.col("target")).alias("__round"))
    tagged = scan.select("*", file.alias(f), row.alias(r))
    out = tagged.join(copies, (tagged[f] == copies["__f"]) & (tagged[r] == copies["__r"])).withColumn(t, F.col("__t") + F.col(k) * F.col("__round"))
    n = partitions(docs.sparkSession, plan.agg(F.sum("taken")).first()[0] or 0, WORDS)
    return out.repartitionByRange(n, t, f, r, k).sortWithinPartitions(t, f, r, k).select(*[out[c] for c in scan.columns])
