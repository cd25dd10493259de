"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import copy
import hashlib
import itertools
import os
import re
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cleanloom.llm import chat, common, components, exact_dedup, mixing, near_duplicates, neighbours, packing, passages, sharding, tokens, toxicity
from cleanloom.llm.queries import vocabulary
from cleanloom.llm.words import split_words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: columns with names that the operators use themselves, and that must pass through
CLASHING = ("id", "key", "file", "row", "n", "size", "place", "cell", "uid", "band", "again", "finish", "at_file", "mix_again", "loc", "_metadata", "text_hash")


def corpus():
    rng = np.random.default_rng(11)
    vocab = [f"word{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    base, passage = text(120), text(60)
    edited = base.split()
    edited[60] = "other"
    docs = [base, " ".join(edited), base.upper(), base, text(40), "", None, "  ", "tiny", "tiny", text(9000), f"{text(30)} {passage} {text(25)}", f"{text(50)} {passage}", f"{base} {text(3)}"]
    rows = [(k, t, "en", ("a", "b", None, "c")[k % 4], len(t or "")) for k, t in enumerate(docs)]
    rows += [(3, base, "en", "c", 1), (3, base, "en", "c", 1), (None, "tiny", None, None, None), (None, None, None, None, None), (4, text(20), "fr", "a", None)]
    rows += [(100 + k, text(int(rng.integers(5, 80))), "en", "ab"[k % 2], 0) for k in range(40)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module", params=["frame", "parquet"])
def docs(request, spark, rows, tmp_path_factory):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit(c))
    if request.param == "frame":
        return df
    path = str(tmp_path_factory.mktemp("docs"))
    df.repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def key(x):
    return (x is not None, x or 0)


def test_only_plain_scans_are_read_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path)
    assert exact_dedup.is_scan(df.where("id > 2").select("id", (F.col("id") + 1).alias("x")))
    for other in (df.select("id", F.explode(F.array(F.lit(1), F.lit(2)))), df.union(df), df.join(df.select(F.col("id").alias("k")), F.col("id") == F.col("k")), df.withColumn("r", F.rand()), df.limit(3), spark.range(3)):
        assert not exact_dedup.is_scan(other)
        scan, file, row = exact_dedup.located(other)
        assert scan.select(file, row).distinct().count() == other.count()


def check_exact(found, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    expected = Counter((i, max(ids, key=key), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert Counter((r["id"], r["keep_id"], r["group_size"], bytes(r["sha"]).hex()) for r in found) == expected
    assert Counter(bytes(r["sha"]) for r in found if r["kept"]) == Counter({bytes(r["sha"]): 1 for r in found})
    assert all(r["id"] == r["keep_id"] for r in found if r["kept"])


def test_exact_dedup(docs, rows):
    check_exact(exact_dedup.exact_dedup(docs).collect(), rows)


@pytest.mark.parametrize("options", [{"digest_bytes": 1}, {"batch_bytes": 1}, {"digest_bytes": 1, "batch_bytes": 1}])
def test_exact_dedup_checks_bytes_and_batches(spark, rows, options):
    check_exact(exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), **options).collect(), rows)


@pytest.mark.parametrize("scan", [False, True])
def test_exact_dedup_resumes_its_state(spark, rows, tmp_path, scan):
    state, seen = str(tmp_path / "state"), []
    for k, part in enumerate((rows[::2], rows[1::2], [(500, "quite new", "en", "a", 0), (501, rows[0][1], "en", "a", 0)])):
        df = spark.createDataFrame(part, SCHEMA)
        if scan:
            df.repartition(2).write.parquet(str(tmp_path / f"delivery{k}"))
            df = spark.read.parquet(str(tmp_path / f"delivery{k}"))
        seen += part
        groups = defaultdict(list)
        for r in seen:
            groups[lowered(r[1])].append(r[0])
        found = exact_dedup.exact_dedup(df, state=state).collect()
        expected = Counter((r[0], max(groups[lowered(r[1])], key=key), len(groups[lowered(r[1])])) for r in part)
        assert Counter((r["id"], r["keep_id"], r["group_size"]) for r in found) == expected
        assert all(r["id"] == r["keep_id"] for r in found if r["kept"])


def test_more_batches_than_a_stream_reports(spark, tmp_path):
    """150 files, a batch each; a stream keeps the progress of its last batches only."""
    rows = [(k, f"text {k % 200}", "en", "a", 0) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartitionByRange(150, "doc_id")
    name, path = "spark.sql.streaming.numRecentProgressUpdates", str(tmp_path / "t")
    df.write.parquet(path)
    old = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        for state in (None, str(tmp_path / "state")):
            check_exact(exact_dedup.exact_dedup(spark.read.parquet(path), state=state, batch_bytes=1).collect(), rows)
        more = spark.createDataFrame([(900, "text 7", "en", "a", 0), (901, "new", "en", "a", 0)], SCHEMA).repartition(2)
        found = {r["id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(more, state=state, batch_bytes=1).collect()}
        assert found == {900: (900, 3), 901: (901, 1)}
    finally:
        spark.conf.set(name, old)


def test_exact_dedup_finds_other_bytes_of_earlier_deliveries(spark, tmp_path):
    state = str(tmp_path / "state")
    exact_dedup.exact_dedup(spark.createDataFrame([(k, f"text {k}") for k in range(400)], "doc_id long, text string"), state=state, digest_bytes=1).collect()
    with pytest.raises(ValueError, match="another text"):
        exact_dedup.exact_dedup(spark.createDataFrame([(1000, "something else")], "doc_id long, text string"), state=state, digest_bytes=1)


def test_exact_dedup_keeps_columns(docs, rows, empty):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({lowered(r[1]) for r in rows})
    assert exact_dedup.exact_dedup(empty).count() == 0


def jaccard_groups(rows, threshold=0.8):
    sets = []
    for r in rows:
        w = split_words(r[1])
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links, parent = Counter(), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[top(b)] = top(a)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[top(k)].append(k)
    return links, groups.values(), sets


def test_near_duplicates(docs, rows, empty):
    links, groups, _ = jaccard_groups(rows)
    expected, kept = Counter(), 0
    for g in groups:
        kept += 1
        least = min((rows[k][0] for k in g if rows[k][0] is not None), default=None)
        for k in g:
            expected[rows[k][0], least, links[k]] += 1
    found = near_duplicates.near_duplicates(docs).collect()
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == kept
    left = near_duplicates.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == kept
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_text_ids(spark):
    rows = [("b-2", " ".join(f"w{k}" for k in range(40)), "en", "a", 0), ("a-1", " ".join(f"w{k}" for k in range(41)), "en", "a", 0), ("c", "else", "en", "a", 0)]
    df = spark.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string"))
    assert {r["id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(df).collect()} == {"b-2": ("a-1", 1), "a-1": ("a-1", 1), "c": ("c", 0)}


def test_large_groups_are_cut_into_blocks(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        w = list(base)
        w[rng.integers(300)] = f"x{k}"
        if k % 3 == 0:
            w[rng.integers(300)] = f"y{k}"
        rows.append((k, " ".join(w), "en", "a", 0))
    small = near_duplicates.Join(bucket=7, block=5)
    links, groups, _ = jaccard_groups(rows)
    found = {r["id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, SCHEMA), join=small).collect()}
    assert found == {rows[k][0]: (min(g), links[k]) for g in groups for k in g}


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages(docs, rows, empty):
    found = passages.repeats(docs).collect()
    shared = {11, 12}
    assert shared <= {r["id"] for r in found}
    assert {r["id"] for r in found} <= {0, 1, 2, 3, 11, 12, 13}
    assert {r["id"] for r in found if r["removed"]} >= {1, 2, 3, 12, 13} and 0 in {r["id"] for r in found if not r["removed"]}
    cut = {r["doc_id"]: r["text"] for r in passages.drop_repeats(docs).collect()}
    before = {r[0]: r[1] for r in rows}
    assert len(split_words(cut[12])) < len(split_words(before[12])) and cut[11] == before[11] and cut[10] == before[10]
    assert passages.repeats(empty).count() == 0


def shared_texts(seed, vocab):
    """Texts with passages of 50 to 120 words that two or three of them share."""
    rng = np.random.default_rng(seed)
    text = lambda n: rng.choice([f"v{k}" for k in range(vocab)], n).tolist()
    docs = [text(int(rng.integers(20, 90))) for _ in range(60)]
    for k in range(40):
        passage = text(int(rng.integers(50, 121)))
        for d in rng.choice(60, 2 + k % 2, replace=False):
            at = int(rng.integers(0, len(docs[d]) + 1))
            docs[d][at:at] = passage[: len(passage) - int(rng.integers(0, 2)) * max(0, len(passage) - 70)]
    return docs


def windows(docs, n):
    places = defaultdict(list)
    for d, w in enumerate(docs):
        for s in range(len(w) - n + 1):
            places[tuple(w[s : s + n])].append((d, s))
    return {g: v for g, v in places.items() if len({d for d, _ in v}) > 1}


@pytest.mark.parametrize(("vocab", "threshold"), [(2000, 1.0), (2000, 0.8), (30, 0.8), (4, 0.8), (2, 0.8)])
def test_shared_passages_are_marked_whole(spark, vocab, threshold):
    docs = shared_texts(vocab, vocab) + [["one"] * 70, ["two"] * 5 + ["one"] * 80, (["a", "b", "c"] * 40)[:101], ["x", *(["a", "b", "c"] * 30)]]
    df = spark.createDataFrame([(d, " ".join(w), "en", "a", 0) for d, w in enumerate(docs)], SCHEMA).repartition(3)
    marked, removed = defaultdict(set), defaultdict(set)
    for r in passages.repeats(df, p=passages.Paragraphs(threshold=threshold)).collect():
        assert 0 <= r["start"] < r["end"] <= len(docs[r["id"]])
        marked[r["id"]].update(range(r["start"], r["end"]))
        if r["removed"]:
            removed[r["id"]].update(range(r["start"], r["end"]))
    whole, again = defaultdict(set), defaultdict(set)
    for places in windows(docs, 50).values():
        for k, (d, s) in enumerate(sorted(places)):
            whole[d].update(range(s, s + 50))
            if k:
                again[d].update(range(s, s + 50))
    assert whole and all(whole[d] <= marked[d] for d in whole) and all(again[d] <= removed[d] for d in again)
    if threshold == 1:  # no near copies: what is marked is shared, what is removed occurs before
        shared, later = defaultdict(set), defaultdict(set)
        for places in windows(docs, 20).values():
            for k, (d, s) in enumerate(sorted(places)):
                shared[d].update(range(s, s + 20))
                if k:
                    later[d].update(range(s, s + 20))
        assert all(marked[d] <= shared[d] for d in marked) and all(removed[d] <= later[d] for d in removed)


def near_passages(seed, edits, n):
    """Texts with passages that stand in two of them, the second time with edits (changed, left out, put in) that leave their five-word
    similarity at 0.8 or more: (texts, [(first text, second text, place there, words there)])."""
    rng = np.random.default_rng(seed)
    text = lambda n: rng.choice([f"n{k}" for k in range(3000)], n).tolist()
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    docs, planted = [], []
    while len(planted) < n:
        passage = text(int(rng.integers(60, 141)))
        copy = list(passage)
        for _ in range(edits):
            at = int(rng.integers(1, len(copy) - 1))
            copy[at : at + 1] = [["other"], [], [copy[at], "more"]][rng.integers(3)]
        a, b = grams(passage), grams(copy)
        if len(a & b) < 0.8 * len(a | b):
            continue
        before = text(int(rng.integers(10, 60)))
        planted.append((len(docs), len(docs) + 1, len(before), len(copy)))
        docs += [text(int(rng.integers(10, 60))) + passage + text(20), before + copy + text(25)]
    return docs, planted


@pytest.mark.parametrize(("edits", "reported", "marked"), [(0, 1.0, 1.0), (1, 0.99, 0.94), (2, 0.98, 0.88), (3, 0.98, 0.83)])
def test_recall_of_near_copies(spark, edits, reported, marked):
    docs, planted = near_passages(edits, edits, 300)
    df = spark.createDataFrame([(d, " ".join(w), "en", "a", 0) for d, w in enumerate(docs)], SCHEMA).repartition(3)
    removed = defaultdict(set)
    for r in passages.repeats(df).where("removed").collect():
        removed[r["id"]].update(range(r["start"], r["end"]))
    shares = [len(removed[d] & set(range(at, at + n))) / n for _, d, at, n in planted]
    print("edits", edits, "reported", np.mean([s > 0 for s in shares]), "words marked", np.mean(shares))
    assert np.mean([s > 0 for s in shares]) >= reported and np.mean(shares) >= marked
    assert all(removed[d] <= set(range(at - 2, at + n + 2)) for _, d, at, n in planted)  # a word beside a passage may be the same by chance
    assert not any(removed[d] for d, _, _, _ in planted)  # the first copy stays whole


@pytest.mark.parametrize("texts", [[None, None], ["", " "], ["a few words", "a few words"], [None, "", "short", "short"]])
def test_texts_without_a_paragraph(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert passages.repeats(df).count() == 0
    assert sorted(map(tuple, passages.drop_repeats(df).collect())) == list(enumerate(texts))


def test_short_texts_among_long_ones(spark, monkeypatch):
    """Slabs of short texts only, between slabs of long ones."""
    monkeypatch.setattr(passages._slabs, "__defaults__", (3,))
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [passage, *["a b c"] * 5, None, "", *["d e f"] * 4, passage.replace("p", "q")]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "loc": list(range(len(texts))), "tag": pa.array(range(len(texts)), pa.int32()), "text": texts})
    p = passages.Paragraphs()
    assert {i for b in passages._places([batch], p) for i in b["id"].to_pylist()} == {0, len(texts) - 1}
    assert {t for b in passages._banded([batch], p) for t in b["tag"].to_pylist()} == {0, len(texts) - 1}


@pytest.mark.parametrize("odd", ["İ", "İstanbul", "ß", "ΟΔΟΣ", "aİİb"])
def test_letters_that_grow_in_lower_case(spark, odd):
    passage, tail = " ".join(f"p{k}" for k in range(60)), " ".join(f"t{k}" for k in range(40))
    texts = [passage, f"{odd} {odd}! {passage} {odd} {tail}"]
    kept = {r["doc_id"]: r["text"] for r in passages.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept == {0: passage, 1: f"{odd} {odd}!  {odd} {tail}"}
    for t in (texts[1], f"İ{odd}x İ", odd):
        at, low = passages.word_spans(t), split_words(t)
        assert len(at) == len(low) and all(w in t[s:e].lower() and len(t[s:e].lower()) <= len(w) + 1 for (s, e), w in zip(at, low, strict=True))


def test_repeats_within_one_text(spark):
    rng = np.random.default_rng(5)
    once = [f"o{k}" for k in rng.integers(0, 1000, 60)]
    df = spark.createDataFrame([(1, " ".join(once + [f"x{k}" for k in range(30)] + once), "en", "a", 0), (2, "short", "en", "a", 0)], SCHEMA)
    assert passages.repeats(df).count() == 0
    found = passages.repeats(df, p=passages.Paragraphs(across=False)).collect()
    assert [(r["start"], r["end"]) for r in found if r["removed"]] == [(90, 150)]


def test_paragraphs_with_one_key_are_told_apart(spark, monkeypatch):
    """Keys of 3 bits: only the check tells paragraphs apart."""
    plain = passages.digests
    monkeypatch.setattr(passages, "digests", lambda *a: np.stack([plain(*a)[:, 0] % 8, plain(*a)[:, 1]], axis=1))
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 500, 60).tolist()
    texts = [[f"k{k}" for k in [*rng.integers(0, 500, 40).tolist(), *(shared if d < 2 else [])]] for d in range(6)]
    key = np.concatenate([passages.digests([t], *passages.anchors([passages.hashed(t)], passages.Paragraphs())[:2], passages.Paragraphs()) for t in texts])
    assert len(set(key[:, 0].tolist())) <= 8 < len(set(key[:, 1].tolist()))


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(vocabulary())
    found = packing.pack_documents(docs, vocabulary(), 64).collect()
    ids = [[*enc.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows]
    pieces = Counter((r[0], s // 64, s, len(x[s : s + 64]), zlib.crc32(np.array(x[s : s + 64], "<u4").tobytes())) for r, x in zip(rows, ids, strict=True) for s in range(0, len(x), 64))
    assert Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == pieces
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1] and sum(n for _, n in own) <= 64
    assert len(places) == packing.lower_bound(np.array([r["length"] for r in found]), 64)
    assert packing.pack_documents(empty, vocabulary()).count() == 0


def test_packing_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 40)
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 90, 900)
    df = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "id long, length long")
    packed = packing.pack(df, 100).collect()
    assert Counter((r["id"], r["length"]) for r in packed) == Counter((k, int(n)) for k, n in enumerate(lengths))
    used = Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 100
    alone = len(packing.best_fit_decreasing(lengths, 100)[2])
    assert packing.lower_bound(lengths, 100) <= len(used) <= alone * 1.02 + 1
    assert packing.certificate(packing.pack(df, 100), 100) == (len(used), packing.lower_bound(lengths, 100))
    assert packing.certificate(packing.pack(df.limit(0), 100), 100) == (0, 0)


def test_neighbours(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(200, 8))
    v[150:] = v[150] * rng.uniform(0.5, 2, (50, 1))
    rows = [(k, x.tolist(), 1) for k, x in enumerate(v)]
    bad = [(1000, None, 1), (1050, [0.0] * 8, 1), (1100, [1.0] * 7 + [float("nan")], 1), (1150, [1.0] * 7 + [None], 1), (1200, [float("inf")] * 8, 1), (1250, [], 1), (None, [1.0] * 8, 1), (1300, [1.0, 2.0], 1), (1350, [1.0, 3.0], 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("id") % 10 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    norm = np.sqrt((v * v).sum(axis=1))
    for q in range(0, 200, 10):
        score = (v * v[q]).sum(axis=1) / (norm * norm[q])
        score[q] = -9
        assert got.pop(q) == list(zip(range(1, 6), np.lexsort((np.arange(200), -score))[:5].tolist(), strict=True))
    assert got == {1300: [(1, 1350)], 1350: [(1, 1300)]}
    assert neighbours.nearest(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_neighbours_of_repeated_ids_and_vectors(spark):
    """Each query row has its own five; a row with the same id is a candidate; of many equal vectors the smallest ids come first."""
    rng = np.random.default_rng(17)
    v = np.concatenate([rng.normal(size=(60, 4)), np.repeat(rng.normal(size=(1, 4)), 40, axis=0)])
    ids = np.concatenate([np.arange(60) // 3, np.arange(40) % 25])
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    norm, expected = np.sqrt((v * v).sum(axis=1)), Counter()
    for q in np.flatnonzero(ids % 5 == 0):
        score = np.round((v * v[q]).sum(axis=1) / (norm * norm[q]), 9)
        others = np.flatnonzero(np.arange(100) != q)
        best = others[np.lexsort((ids[others], -score[others]))][:5]
        expected.update((int(ids[q]), rank, int(ids[b])) for rank, b in enumerate(best, 1))
    assert Counter((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(df, F.col("id") % 5 == 0).collect()) == expected


def test_neighbours_of_long_vectors_in_a_table(spark, tmp_path):
    rng = np.random.default_rng(18)
    v = rng.normal(size=(30, 3000))
    spark.createDataFrame([(k, x.tolist(), "q", 1.0) for k, x in enumerate(v)], "vec_id long, embedding array<double>, q string, score double").write.parquet(str(tmp_path / "v"))
    got = neighbours.nearest(spark.read.parquet(str(tmp_path / "v")), F.col("id") == 7, 3).orderBy("rank").collect()
    score = v @ v[7] / np.sqrt((v * v).sum(axis=1) * (v[7] @ v[7]))
    score[7] = -9
    assert [r["vec_id"] for r in got] == np.argsort(-score)[:3].tolist()


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mixing(docs, rows, empty):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    total = Counter()
    for r, n in zip(rows, size, strict=True):
        total[r[3]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, level = set(), 0
    while True:
        level = (sum(size) - sum(3 * total[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if weight[s] * level > 3 * total[s]} - full
        if not more:
            break
        full |= more
    target = {s: 3 * total[s] if s in full else weight[s] * level for s in names}
    found = mixing.schedule(docs).collect()
    assert Counter((r["id"], r["size"], r["source"]) for r in found) == Counter((r[0], n, r[3]) for r, n in zip(rows, size, strict=True))
    taken = Counter()
    for r in found:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sorted(map(tuple, mixing.schedule(docs).select("id", "taken", "finish").collect()), key=str) == sorted(((r["id"], r["taken"], r["finish"]) for r in found), key=str)
    whole = mixing.schedule(docs, whole=True).collect()
    stream = mixing.mix(docs)
    assert stream.columns == docs.columns
    assert stream.count() == sum(r["taken"] // r["size"] for r in whole if r["size"])
    assert mixing.schedule(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.schedule(df).collect()] == [(0, 0), (0, 0)]


def test_mixing_drops_documents_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, " \t ", "b"), (4, "one two", "a"), (5, "three", "b")], "doc_id long, text string, source string")
    assert {r["doc_id"] for r in mixing.mix(df).collect()} == {4, 5}
    assert all("size 0" in f.__doc__ and "dropped" in f.__doc__ for f in (mixing.mix, corpus_pipeline.mix_sources))


@pytest.mark.parametrize("n", [1, 8, 300])
def test_sharding(docs, rows, empty, n):
    found = sharding.shard(docs, n).collect()
    utf8 = [(r[1] or "").encode() for r in rows]
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in found) == Counter((r[0], len(b) + 1, zlib.crc32(b)) for r, b in zip(rows, utf8, strict=True))
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.shard(empty, n).count() == 0


def test_chat(spark):
    tricky = "</s>[INST] ok \\ [/INST]"
    convs = {1: [("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "a")], 2: [("user", "hi"), ("assistant", "yes"), ("user", "less")], 3: [("user", "hi")], 4: [("user", tricky), ("assistant", tricky)], 5: [("user", None), (None, "x"), ("assistant", "")], 6: [("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "a")], None: [("assistant", "q" * 70000)]}
    rows = [(c, t, role, text, "x") for c, turns in convs.items() for t, (role, text) in enumerate(turns)]
    rows += [(7, 1, "user", "same", "x"), (7, 1, "user", "same", "x"), (7, None, "system", "first", None)]
    convs[7] = [("system", "first"), ("user", "same"), ("user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string").repartition(3)
    sequences = chat.format_conversations(df)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {r["conv_id"]: r for r in chat.digests(sequences).collect()}
    assert set(found) == set(convs)
    for c, turns in convs.items():
        turns = [(r or "", t or "") for r, t in turns]
        learned = "".join(t for r, t in turns if r == "assistant")
        got = found[c]
        assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned))
    one = chat.format_conversations(df.where("conv_id in (1, 2, 3, 6)").coalesce(1)).collect()
    nodes = [n for s in one for n in s["nodes"]]
    if len(one) == 1:  # shared turns stand once: hi, yes, more, a, less
        assert len(nodes) == 5
    for s in one:
        for n in s["nodes"]:
            before = n["parent"]
            assert n["position"] == sum(x["end"] - x["start"] for x in n["attends"]) - (n["end"] - n["start"])
            assert before < 0 or s["nodes"][before]["end"] <= n["start"]
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_token_counts(docs, rows, empty):
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(vocabulary())
    found = tokens.token_counts(docs, vocabulary(), limit=50).collect()
    expected = Counter((r[0], len((r[1] or "").encode()), n := len(enc.encode(r[1] or "", add_special_tokens=False).ids), n > 50) for r in rows)
    assert Counter((r["id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found) == expected
    assert tokens.token_counts(empty, vocabulary()).count() == 0


def test_toxicity(spark, docs, rows, empty):
    rng = np.random.default_rng(8)
    texts = [" ".join(["the", *rng.choice([f"w{k}" for k in range(50)], 20), *(["vile"] if k % 2 else [])]) for k in range(200)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([*((k, k % 2, "x") for k in range(200)), (None, 1, "x"), (5000, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(table, labels, F.col("doc_id") % 5 != 0)
    got = {r["id"]: r["predicted"] for r in toxicity.score(table, model).collect()}
    assert np.mean([got[k] == k % 2 for k in range(0, 200, 5)]) > 0.95
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and clean.count() == sum(1 - r["predicted"] for r in found)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0), F.lit(True))).count() == 0


def _remembered(batches):
    from cleanloom.llm import words

    for b in batches:
        yield b.from_pydict({"n": [len(words._HASHES)] * b.num_rows})


def test_workers_forget_between_steps(spark):
    """What a step's Python workers remember does not stay beside the next step's."""
    near_duplicates.ship(spark)
    docs = spark.range(0, 400, 1, 4).selectExpr("id as doc_id", "concat_ws(' ', 'some words of text', id, id * 7) as text")
    assert near_duplicates.near_duplicates(docs).count() == 400
    kept = spark.range(0, 4, 1, 4).selectExpr("id as n").mapInArrow(_remembered, "n long").collect()
    assert [r["n"] for r in kept] == [0] * 4


def test_what_the_driver_lists_starts_no_python(spark, tmp_path):
    """A table made of a list of rows would be read by Python workers of its own on every executor."""
    spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "source string, source_size long").write.parquet(f"{tmp_path}/sources")
    ranked = mixing.ranked(spark.read.parquet(f"{tmp_path}/sources"))
    assert {r["source"]: r["place"] for r in ranked.collect()} == {"a": 0, "b": 1, None: 2}
    files = passages.numbers(spark.read.parquet(f"{tmp_path}/sources"))
    assert [r["number"] for r in files.orderBy("path").collect()] == list(range(files.count()))
    for df in (ranked, files):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "LocalTableScan" in plan and "ExistingRDD" not in plan


def test_toxicity_gives_memory_back_at_a_tasks_end(monkeypatch):
    """After the last batch, and when the scorer with all that it remembers is gone."""
    model, scorers, given = toxicity._untrained(7)[0], [], []
    model.threshold = dict.fromkeys(toxicity.LANGUAGES, 0.0)
    scorer = toxicity.Scorer
    monkeypatch.setattr(toxicity, "Scorer", lambda m: scorers.append(weakref.ref(s := scorer(m))) or s)
    monkeypatch.setattr(common, "give_back", lambda: given.append(scorers[-1]() is None))
    texts = [None, "", *(f"text {k}" for k in range(2500))]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts, "label": [0] * len(texts)})
    scored = [r for b in toxicity._score([batch, batch], model) for r in b.to_pylist()]
    one = scorer(model)
    assert scored == [{"id": k, "score": one.score(t)} for k, t in enumerate(texts)] * 2
    kept = [r["id"] for b in toxicity._clean([batch], model, "text") for r in b.to_pylist()]
    assert kept == [r["id"] for r in scored[: len(texts)] if r["score"] < 0.5]
    assert sum(b.num_rows for b in toxicity._logits([batch], model)) == len(texts)
    assert given == [True] * 3


def test_toxicity_moves_labelled_texts_only(spark, tmp_path):
    """Where labels are too many for a broadcast, their Bloom filter keeps the other texts out of the shuffle."""
    spark.range(3000).select(F.col("id"), F.concat(F.lit("text "), "id").alias("text")).write.parquet(f"{tmp_path}/texts")
    spark.range(0, 3000, 3).select(F.col("id"), (F.col("id") % 2).cast("int").alias("label")).write.parquet(f"{tmp_path}/labels")
    with exact_dedup.settings(spark, toxicity.JOIN_FILTERS | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        found = toxicity._labelled(*(spark.read.parquet(f"{tmp_path}/{x}") for x in ("texts", "labels")))
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [(k, k % 2, f"text {k}") for k in range(0, 3000, 3)]


def test_toxicity_learns_from_all_rows(spark, monkeypatch):
    """Words that the driver's few rows do not have are learned from the others, whatever shard they are in."""
    monkeypatch.setattr(toxicity, "SHARD", 2000)
    rng = np.random.default_rng(4)
    plain, vile = [f"w{k}" for k in range(50)], [f"{k}vile" for k in range(3)]
    texts = [" ".join([*rng.choice(plain, 20), *([vile[k // 2 % 3]] if k % 2 else [])]) for k in range(5000)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = table.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    models = [toxicity.fit(table, labels, F.col("doc_id") % 5 != 0, sample=8) for _ in range(2)]
    scorers = [toxicity.Scorer(m) for m in models]
    got = [scorers[0].score(texts[k]) for k in range(0, 5000, 5)]
    assert np.mean([(s >= 0.5) == k % 2 for s, k in zip(got, range(0, 5000, 5), strict=True)]) > 0.95
    assert got == [scorers[1].score(texts[k]) for k in range(0, 5000, 5)]
    one = toxicity.fit(table, labels.where("toxic = 0"), F.lit(True), sample=8)
    assert toxicity.Scorer(one).score(texts[1]) < 0.01


def test_shards_are_averaged(spark):
    """The fit against one process that trains each shard by itself and takes the mean; the same for any number of shuffle partitions."""
    rng = np.random.default_rng(6)
    plain = [f"w{k}" for k in range(80)]
    texts = [" ".join([*rng.choice(plain, 12), *(["vile"] if k % 3 == 0 else [])]) for k in range(1200)]
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    known = table.select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    held = F.col("id") % 5 == 0
    start, squares = toxicity._untrained(7)
    place = table.select("id", F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(4)).alias("shard"), F.xxhash64("id").alias("order")).where(~held).orderBy("shard", "order").collect()
    model = start
    for turn in range(toxicity.ROUNDS):
        shards = []
        for s in range(4):
            own, sq, r = copy.deepcopy(model), copy.deepcopy(squares), np.random.default_rng([9, turn, s])
            ids = [x["id"] for x in place if x["shard"] == s]
            toxicity._learn(own, sq, [texts[i] for i in ids], np.array([i % 3 == 0 for i in ids], np.float32), r, 1)
            shards.append(own)
        mean = copy.deepcopy(model)
        changed = np.array([(m.embed != model.embed).any(axis=1) for m in shards])
        mean.embed += (np.sum([m.embed - model.embed for m in shards], axis=0, dtype=float) / np.maximum(changed.sum(axis=0), 1)[:, None]).astype(np.float32)
        toxicity._add(mean, np.mean([toxicity._dense(m) - toxicity._dense(model) for m in shards], axis=0, dtype=float).astype(np.float32))
        model = mean
    old, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(toxicity._fit_all(table, known, held, 4, start, squares))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    print("largest difference", np.abs(got[0].embed - model.embed).max(), np.abs(toxicity._dense(got[0]) - toxicity._dense(model)).max())
    assert np.allclose(got[0].embed, model.embed, atol=1e-6) and np.allclose(toxicity._dense(got[0]), toxicity._dense(model), atol=1e-5) and not np.allclose(model.embed, start.embed, atol=1e-3)
    assert np.array_equal(got[0].embed, got[1].embed) and got[0].threshold == got[1].threshold and np.array_equal(toxicity._dense(got[0]), toxicity._dense(got[1]))


def test_shards_learn_the_same_wherever_batches_end(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    rng = np.random.default_rng(7)
    rows = [{"shard": s, "label": k % 2, "text": " ".join(rng.choice([f"w{j}" for j in range(40)], 9))} for s, n in ((0, 150), (3, 64), (4, 1), (9, 200)) for k in range(n)]
    start, squares = toxicity._untrained(7)
    table = pa.Table.from_pylist(rows)
    got = []
    for size in (1000, 70, 7):
        out = [r for b in toxicity._changes(table.to_batches(size), start, squares, 1) for r in b.to_pylist()]
        got.append(out)
        assert [r["shard"] for r in out if r["block"] < 0] == [0, 3, 4, 9]
    assert got[0] == got[1] == got[2]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", ["op6_chat_formatting", "op9_exact_dedup"])
def test_queries_with_sql(spark, name):
    import duckdb

    from cleanloom.llm import queries

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r) for r in con.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()[name]})").fetchall()), key=repr)
