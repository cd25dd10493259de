"""The pipeline's stages against plain Python over the smallest tables."""

import itertools
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cleanloom.llm import packing, toxicity
from cleanloom.llm.common import stage
from cleanloom.llm.queries import vocabulary
from cleanloom.llm.words import split_words

from .test_operators import WORD, lowered

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage kept, as it is written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        before = docs
        docs = stage(function(spark, docs, SF), name)
        out.append((before.collect(), docs))
    return out


def test_stages_keep_the_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "weighted_mixing", "best_fit_packing"]
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, df in kept[:-1])


def test_toxicity(spark, kept):
    before, after = kept[0]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), ~held)
    scorer = toxicity.Scorer(model)
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before if scorer.score(r["text"]) < 0.5}


def test_exact_dedup(kept):
    before, after = kept[1]
    last = defaultdict(int)
    for r in before:
        last[lowered(r["text"])] = max(last[lowered(r["text"])], r["doc_id"])
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(last.values())


def test_near_duplicates(kept):
    before, after = kept[2]
    sets = {}
    for r in before:
        w = split_words(r["text"])
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {d: d for d in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((top[a], top[b]))
            top = {k: low if v == high else v for k, v in top.items()}
    assert {r["doc_id"] for r in after.collect()} == set(top.values())


def test_mixing(spark, kept):
    before, after = kept[3]
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in before}
    total, queues = Counter(), defaultdict(list)
    place = {r[0]: (r[1], r[0]) for r in spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "id long, text string").select("id", F.xxhash64(F.lit(17), "id", F.xxhash64("text"))).collect()}
    for r in before:
        total[r["source"]] += size[r["doc_id"]]
        queues[r["source"]].append(r["doc_id"])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    full = set()
    while True:
        level = (sum(total.values()) - sum(3 * total[s] for s in full)) / sum(weight[s] for s in total if s not in full)
        if not (more := {s for s in total if weight[s] * level > 3 * total[s]} - full):
            break
        full |= more
    expected = Counter()
    for s, ids in queues.items():
        target = 3 * total[s] if s in full else weight[s] * level
        ids.sort(key=lambda d: (place[d][0] % 2**64, d))
        for again in range(3):
            at = again * total[s]
            for d in ids:
                if at + size[d] / 2 <= target:
                    expected[d] += 1
                at += size[d]
    assert Counter(r["doc_id"] for r in after.collect()) == expected


def test_packing(kept):
    from tokenizers import Tokenizer

    before, after = kept[4]
    enc, expected, places = Tokenizer.from_file(vocabulary()), Counter(), defaultdict(list)
    for r in before:
        ids = [*enc.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        expected.update((r["doc_id"], s // 2048, s, len(p := ids[s : s + 2048]), zlib.crc32(np.array(p, "<u4").tobytes())) for s in range(0, len(ids), 2048))
    rows = after.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all([o for o, _ in sorted(v)] == [0, *itertools.accumulate(n for _, n in sorted(v))][:-1] and sum(n for _, n in v) <= 2048 for v in places.values())
    assert len(places) <= packing.lower_bound(np.array([r["length"] for r in rows]), 2048) + 1


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
