"""Whitening of embeddings: a covariance in one aggregation of generated SQL, its eigenvectors, and the projection of every row.

1. Entries become integers, floor(scale * c) + offset; each distinct vector of them counts once. These are written, and one aggregation
   gives their number and the exact sum of each dimension.
2. A second aggregation has a generated SQL expression for each pair of dimensions of the upper triangle, the sum of the products of the
   two centred entries. An entry is centred by the integer next to its mean, exactly, then by what the mean differs from that: nothing is lost however large the
   offset. Tasks send one row of partial sums.
3. The driver puts the matrix together, d * d numbers, and LAPACK (`numpy.linalg.eigh`) gives its eigenvectors.
4. Rows are projected in Arrow batches, with no shuffle. The covariance of what the distinct vectors become is aggregated once more, and its largest
   distance from the identity is returned with every row.

More than `PAIRS` pairs of dimensions (an aggregation's buffer has eight bytes for each) are summed in several such aggregations over the table
already written.

Defined results: vectors that are null, or hold null or non-finite entries, take no part; nor do empty ones, and ones of another number of
dimensions than most have (of equally many: the greater number). Rows count once each, null ids and repeated rows among them. Components whose
variance is nothing but rounding are left out, so fewer distinct vectors than dimensions give fewer components, and one alone, or
an empty table, no row. A deviation beyond 64 bits is null. An entry beyond 2 ** 53 / scale counts as that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import stage, unstage

#: pairs of dimensions in one aggregation
PAIRS = 4096
#: a variance below this share of the largest is nothing but rounding
ROUNDING = 1e-12
_MOST = 1 << 53


@dataclass(frozen=True)
class Whitening:
    """What fit learned: of n distinct vectors the sums of each dimension, the components (rows; unit vectors by falling variance), their
    variances, the trace of the covariance, and how far the whitened covariance is from the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    scale: float
    offset: int
    identity_error: float = 0.0

    @property
    def middle(self) -> np.ndarray:
        """The integer next to the mean, by dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def left(self) -> np.ndarray:
        """What the sums have beyond n times that: less than n either way."""
        return np.array([s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)], np.int64)


def whole(vector: Column) -> Column:
    """Whether a vector is there, with numbers only in it. NaN is above infinity in Spark."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def integers(vector: Column, scale: float, offset: int) -> Column:
    bounded = lambda c: F.greatest(F.least(F.floor(c.cast("double") * F.lit(scale)), F.lit(_MOST)), F.lit(-_MOST))
    return F.transform(vector, lambda c: bounded(c) + F.lit(offset))


def centred(k: int, middle: int, left: int, n: int) -> str:
    """SQL: the k-th entry less the mean, by an exact difference of integers and the rest. It is never null, and said so: that makes for less code."""
    return f"CAST(coalesce(x[{k}], {middle}) - {middle} AS DOUBLE) - {float(left / n)!r}D AS c{k}"


def product_sums(pairs: Iterable[tuple[int, int]]) -> list[str]:
    """SQL: the sums of products of the centred entries of each pair."""
    return [f"sum(c{i} * c{j}) AS v{i}_{j}" for i, j in pairs]


def _rows(df: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    read = df.select(df[id_col].alias("id"), df[vector_col].alias("vector")).where(whole(F.col("vector")))
    return read.select("id", integers(F.col("vector"), scale, offset).alias("x"))


def fit(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", most: int = 16, scale: float = 64.0, offset: int = 1_000_000) -> Whitening | None:
    """The whitening of the distinct vectors of df; None where there is none to learn it from."""
    spark = df.sparkSession
    ship(spark)
    rows = _rows(df, id_col, vector_col, scale, offset)
    distinct = stage(rows.select("x").distinct(), "white-distinct")
    # a row for each number of dimensions; the vote is of rows, not of distinct vectors
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if sizes is None:
        unstage(distinct)
        return None
    d = sizes["d"]
    fitted = distinct.where(F.size("x") == d)
    totals = fitted.agg(F.count("*").alias("n"), *(F.sum(F.col("x")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in range(d))).first()
    model = Whitening(totals["n"], tuple(int(totals[f"s{k}"]) for k in range(d)), np.zeros((0, d)), np.zeros(0), 0.0, scale, offset)
    apart = fitted.selectExpr(*(centred(k, int(m), int(f), model.n) for k, (m, f) in enumerate(zip(model.middle, model.left, strict=True))))
    pairs, v = [(i, j) for i in range(d) for j in range(i, d)], np.zeros((d, d))
    for at in range(0, len(pairs), PAIRS):
        summed = apart.selectExpr(*product_sums(pairs[at : at + PAIRS])).first()
        for (i, j), value in zip(pairs[at : at + PAIRS], summed, strict=True):
            v[i, j] = v[j, i] = value / model.n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1].T
    real = (values > ROUNDING * values[0]) & (np.arange(d) < model.n - 1)
    kept = np.flatnonzero(real)[:most]
    model = Whitening(model.n, model.sums, vectors[kept], values[kept], float(np.trace(v)), scale, offset)
    if len(kept):
        named = [f"w{k}" for k in range(len(kept))]
        white = fitted.select("x").mapInArrow(lambda it: _white(it, model), ", ".join(f"{w} double" for w in named))
        upper = [(i, j) for i in range(len(kept)) for j in range(i, len(kept))]
        got = white.agg(*(F.covar_pop(f"w{i}", f"w{j}") for i, j in upper)).first()
        error = max(abs(c - (i == j)) for (i, j), c in zip(upper, got, strict=True))
        model = Whitening(model.n, model.sums, vectors[kept], values[kept], model.trace, scale, offset, error)
    unstage(distinct)
    return model


def _matrix(x: pa.Array, d: int) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def whiten(x: np.ndarray, model: Whitening) -> np.ndarray:
    """The whitened values of integer vectors, a column for each component."""
    apart = (x - model.middle).astype(float) - model.left / model.n
    return apart @ (model.components / np.sqrt(model.variances)[:, None]).T


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """For each vector the sum of (n * x - sum) ** 2 over its dimensions, exact; None beyond 64 bits."""
    apart = x - model.middle
    widest = model.n * (int(np.abs(apart).max(initial=0)) + 1)
    if widest * widest * x.shape[1] < 1 << 63:
        return ((model.n * apart - model.left) ** 2).sum(axis=1).tolist()
    exact = ((apart.astype(object) * model.n - model.left.astype(object)) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in map(int, exact)]


def _white(batches: Iterable[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for b in batches:
        w = whiten(_matrix(b["x"], len(model.sums)), model)
        yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in range(w.shape[1])], [f"w{k}" for k in range(w.shape[1])])


def _project(batches: Iterable[pa.RecordBatch], model: Whitening, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            b = batch.slice(at, rows)
            x = _matrix(b["x"], len(model.sums))
            whitened = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(model.variances), whiten(x, model).ravel())
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(deviations(x, model), pa.int64()), whitened], ["id", "deviation", "whitened"])


def transform(df: DataFrame, model: Whitening | None, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row for each whole vector of df and each component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    rows = _rows(df, id_col, vector_col, model.scale, model.offset).where(F.size("x") == len(model.sums))
    out = rows.mapInArrow(lambda it: _project(it, model), f"id {kind}, deviation long, whitened array<double>")
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.variances))
    out = out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))
