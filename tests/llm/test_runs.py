"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cleanloom.llm import queries, runs

from .test_operators import SCHEMA, docs, empty, rows  # noqa: F401


def plain(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, times * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def kept(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize(("least", "times"), [(6, 4), (4, 2), (2, 2), (5, 3), (12, 2)])
def test_all_runs_are_found(least, times):
    rng = random.Random(least * times)
    for _ in range(1500):
        words = [b"abcdefg"[k : k + 1] for k in (rng.randrange(rng.choice([1, 2, 3, 7])) for _ in range(rng.randrange(70)))]
        at, p = rng.randrange(len(words) + 1), rng.randrange(1, 9)
        words[at:at] = (words[at : at + p] or [b"z"]) * rng.randrange(6)
        assert runs.find_runs(words, least, times) == plain(words, least, times)


def test_only_segments_of_repeated_grams_are_searched():
    words = [f"w{k}".encode() for k in range(1000)]
    assert runs.unmasked(words, 5) == [] and runs.overlap(6, 4) == 5 and runs.overlap(6, 2) == 3
    words[300:310] = words[700:710]
    assert runs.unmasked(words, 5) == [(300, 310), (700, 710)] and runs.find_runs(words) == []


def test_the_edges_of_halves_and_of_texts():
    for n in range(4, 70):
        assert runs.find_runs([b"a"] * n) == ([(0, n, 1)] if n >= 6 else [])
        loop = [b"a", b"b", b"c"] * n
        assert runs.find_runs([b"x", *loop, b"c"]) == [(1, 3 * n, 3)]
        assert runs.find_runs([b"c", *loop]) == [(0, 3 * n + 1, 3)]


def test_a_long_loop_takes_no_square_of_its_length():
    words = [str(k).encode() for k in range(5000)] * 20
    assert runs.find_runs(words) == [(0, 100_000, 5000)]


def test_periodic_runs(spark, docs, rows, empty):  # noqa: F811
    found = runs.periodic_runs(docs).collect()
    texts = [" ".join((r[1] or "").split()) for r in rows]
    assert Counter(r["id"] for r in found) == Counter(r[0] for r in rows)
    expected = Counter((r[0], tuple(plain(t.split())), kept(t.split(), plain(t.split()))) for r, t in zip(rows, texts, strict=True))
    assert Counter((r["id"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in found) == expected
    assert runs.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError, match="two words"):
        runs.periodic_runs(docs, times=1)


def test_white_space_and_words_beyond_ascii(spark):
    texts = ["a\tb\x0bA\x0cb\r\n" * 5, "é x " * 6, "no no no no no no", " \n\x1c x" * 8, "", None, "日本" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(df).collect()}
    assert got == {0: ([(0, 20, 4)], "a b A b"), 1: ([(0, 6, 1)], "é x"), 2: ([(0, 6, 1)], "no"), 3: ([(0, 16, 2)], "\x1c x"), 4: ([], ""), 5: ([], ""), 6: ([], "日本" * 9)}


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([f"{k} " * 30 + "tail" for k in range(50)])], ["id", "text"])
    out = list(runs._find([b], 6, 4, most=20))
    assert len(out) > 5 and [i for x in out for i in x["id"].to_pylist()] == list(range(50))
    assert [t for x in out for t in x["collapsed"].to_pylist()] == [f"{k} tail" for k in range(50)]


def test_the_query_loops_every_tenth_text(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(120))) or None) for k in range(400)]
    rows += [(None, "a b"), (None, None), (7, " "), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for i, text in rows:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = plain(words)
        start, length, q = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{p}\n" for s, n, p in found), kept(words, found))]
        expected[i, len(found), start, length, q, 1000 * length // q if found else None, *digest] += 1
    df = queries.op11_periodic_runs(spark, str(tmp_path))
    assert Counter(map(tuple, df.collect())) == expected and sum(k[1] > 0 for k in expected) > 5


def test_empty_query(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    df = queries.op11_periodic_runs(spark, str(tmp_path))
    assert df.count() == 0 and df.where(F.col("runs_sha256").isNull()).count() == 0
