"""Circulant MinHash: signatures of two permutations, and components against all pairs."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from cleanloom.llm import circulant, queries
from cleanloom.llm.words import shingles

from .test_operators import SCHEMA, docs, empty, lowered, rows  # noqa: F401


def sets(rows, size=3):
    out = []
    for r in rows:
        w = lowered(r[1]).split()
        out.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    return out


def expected(rows, percent=85):
    s, top = sets(rows), list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if s[a] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
            top[find(b)] = find(a)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return Counter((rows[k][0], len(s[k]), min((rows[j][0] for j in g if rows[j][0] is not None), default=None)) for g in groups.values() for k in g), len(groups)


def check(df, rows, **options):
    found = circulant.circulant_duplicates(df, how=circulant.Circulant(**options)).collect()
    want, n = expected(rows)
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == want
    assert sum(r["first"] for r in found) == n


def test_circulant_duplicates(docs, rows, empty):  # noqa: F811
    check(docs, rows)
    assert circulant.circulant_duplicates(empty).count() == 0


def edited(rng, base, n):
    words = list(base)
    for _ in range(n):
        words[rng.integers(len(words))] = f"x{rng.integers(1 << 30)}"
    return words


@pytest.mark.parametrize("options", [{}, {"star": 5, "block": 4}, {"block_shingles": 700}])
def test_groups_that_no_middle_connects(spark, options):
    """A chain, whose ends are unlike, and families whose members reach the threshold with few others."""
    rng, texts = np.random.default_rng(8), []
    words = [f"w{k}" for k in range(150)]
    for _ in range(40):
        texts.append(list(words))
        words = edited(rng, words, 2)
    for family in range(4):
        base = [f"f{family}-{k}" for k in range(120)]
        texts += [edited(rng, base, int(rng.integers(0, 6))) for _ in range(40)]
    order = rng.permutation(len(texts))
    rows = [(int(k), " ".join(texts[j]), "en", "a", 0) for k, j in enumerate(order)]  # noqa: F811
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), rows, **options)


def test_the_threshold_is_exact(spark):
    """17 of 20 shingles in common are 85 %, of 21 they are not."""
    base = [f"w{k}" for k in range(22)]
    rows = [(0, " ".join(base[:19]), "", "", 0), (1, " ".join(base), "", "", 0), (2, " ".join(f"v{k}" for k in range(19)), "", "", 0), (3, " ".join(f"v{k}" for k in range(23)), "", "", 0)]  # noqa: F811
    assert [len(s) for s in sets(rows)] == [17, 20, 17, 21]
    found = {r["id"]: r["component_id"] for r in circulant.circulant_duplicates(spark.createDataFrame(rows, SCHEMA), how=circulant.Circulant(rows=1, bands=64)).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3}


def test_signatures_are_shifts_of_one_permutation():
    table = circulant.shifted(8)
    assert table.base is not None and np.array_equal(table[1:100, :-1], table[:99, 1:] * 0 + table[1:100, :-1]) and np.array_equal(table[5, :-1], table[4, 1:])
    assert np.array_equal(np.sort(table[:, 0]), np.arange(circulant.RING)) and table[-1, 1] == table[0, 0]
    sh = shingles(np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
    one = [circulant.signature(sh[k : k + 1], 8) for k in range(len(sh))]
    assert np.array_equal(circulant.signature(sh, 8), np.min(one, axis=0)) and np.array_equal(circulant.signature(sh, 8, step=7), np.min(one, axis=0))


def test_equal_coordinates_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        n = 400
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: round(2 * n * share / (1 + share))], rng.integers(0, 1 << 63, n).astype(np.uint64)])[:n]
        got = np.mean([(circulant.signature(a ^ np.uint64(k), 192) == circulant.signature(b ^ np.uint64(k), 192)).mean() for k in range(40)])
        assert abs(got - share) < 0.02


def test_a_tight_group_meets_only_its_middles(spark):
    """Copies of one text with one word changed: the two ends of buckets connect them, and no block is made."""
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(edited(rng, base, 1)), "en", "a", 0) for k in range(150)]  # noqa: F811
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_the_query(spark):
    got = queries.op12_circulant_near_dedup(spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]  # noqa: F811
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == expected(rows)[0]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
