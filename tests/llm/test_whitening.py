"""Whitening against numpy, exact integers against Python's."""

import math
from collections import Counter

import numpy as np
import pytest

from cleanloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id int, x string, deviation int"
NAN, INF = float("nan"), float("inf")


def vectors(n=80, d=7, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) + 3
    return [tuple(np.float32(c).item() for c in v) for v in base]


def frame(spark, rows):
    return spark.createDataFrame([(i, list(v) if v is not None else None, 1, "x", 2) for i, v in rows], SCHEMA)


def check(found, rows, most=16):
    whole = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    apart = np.array([[n * c - t for c, t in zip(x, s, strict=True)] for x in fit], float) / n
    e, u = np.linalg.eigh(apart.T @ apart / n)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    exact = Counter((i, sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))) for i, x in whole)
    count = min(most, len(e))
    assert Counter((r["id"], r["deviation"]) for r in found if r["component"] == 1) == exact
    assert Counter(r["component"] for r in found) == {k: len(whole) for k in range(1, count + 1)}
    assert {r["n"] for r in found} == {n} and {r["identity_error"] for r in found} == {found[0]["identity_error"]} and 0 <= found[0]["identity_error"] < 1e-9
    total = np.trace(apart.T @ apart / n)
    for k in range(count):
        got = sorted((r["id"] is None, r["id"] or 0, r["whitened"]) for r in found if r["component"] == k + 1)
        want = np.array([[(n * c - t) / n for c, t in zip(x, s, strict=True)] for _, x in whole]) @ u[:, k] / np.sqrt(e[k])
        either = [sorted((i is None, i or 0, sign * w) for (i, _), w in zip(whole, want, strict=True)) for sign in (1, -1)]
        assert any(all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-8 for a, b in zip(got, side, strict=True)) for side in either)
        assert [r["explained"] for r in found if r["component"] == k + 1] == pytest.approx([e[k] / total] * len(whole), rel=1e-9)


def run(df, **options):
    return whitening.transform(df, whitening.fit(df, **options)).collect()


def test_whitening_with_odd_rows(spark):
    v = vectors()
    rows = [*enumerate(v), (500, v[0]), (501, v[0]), (3, v[3]), (None, v[4]), (None, v[4]), (502, None), (503, [*v[1][:-1], None]), (504, [*v[1][:-1], NAN]), (505, [*v[1][:-1], -INF]), (506, [])]
    df = frame(spark, rows).repartition(3)
    found = run(df)
    check(found, rows)
    assert whitening.transform(df, whitening.fit(df)).columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_pairs_in_several_aggregations(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PAIRS", 5)
    rows = list(enumerate(vectors(40, 5, 1)))
    check(run(frame(spark, rows), most=3), rows, 3)


def test_a_copy_with_a_third_of_all_rows_counts_once(spark):
    v = vectors(30, 4, 2)
    rows = [*enumerate(v), *((1000 + k, v[0]) for k in range(300))]
    check(run(frame(spark, rows)), rows)


def test_fewer_vectors_than_dimensions(spark):
    rows = list(enumerate(vectors(4, 9, 3)))
    found = run(frame(spark, rows))
    assert Counter(r["component"] for r in found) == {1: 4, 2: 4, 3: 4} and found[0]["identity_error"] < 1e-6
    assert run(frame(spark, rows[:1])) == [] and run(frame(spark, [])) == [] and run(frame(spark, [(1, None)])) == []
    assert run(frame(spark, [(k, rows[0][1]) for k in range(5)])) == []


def test_other_numbers_of_dimensions_take_no_part(spark):
    rows = list(enumerate(vectors(30, 4, 4)))
    check(run(frame(spark, [*rows, (900, [1.0, 2.0]), (901, [1.0] * 9)])), rows)


def test_entries_and_deviations_beyond_64_bits(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [0.5, 2.0]), (3, [1e9, -7.0]), (4, [-2.0, 5.0])]
    found = {r["id"]: r["deviation"] for r in run(frame(spark, rows))}
    assert found == {k: None for k in range(5)}
    model = whitening.Whitening(3, (30, 60), np.eye(2), np.ones(2), 2.0, 64.0, 0)
    x = np.array([[10, 20], [11, 18], [1 << 31, 20], [1 << 40, 20]])
    assert whitening.deviations(x, model) == [0, 45, 9 * ((1 << 31) - 10) ** 2 if 9 * ((1 << 31) - 10) ** 2 < 1 << 63 else None, None]


def test_generated_sql():
    assert whitening.product_sums([(0, 0), (0, 1)]) == ["sum(c0 * c0) AS v0_0", "sum(c0 * c1) AS v0_1"]
    assert whitening.centred(2, 1_000_001, -1, 4) == "CAST(coalesce(x[2], 1000001) - 1000001 AS DOUBLE) - -0.25D AS c2"
