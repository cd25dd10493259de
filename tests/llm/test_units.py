"""The parts of the operators that run without Spark."""

import itertools
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cleanloom.llm import chat, near_duplicates, neighbours, packing, passages, sharding, tokens, toxicity, words
from cleanloom.llm.common import group_starts, whole_groups
from cleanloom.llm.queries import vocabulary


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([*"\\<>|/s[]INST\n", *chat.CONTROL]), max_size=40).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


def test_whole_groups_stay_whole():
    keys = np.sort(np.random.default_rng(0).integers(0, 40, 1000))
    for size in (1, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[k : k + size])], ["k"]) for k in range(0, 1000, size)]
        tables = list(whole_groups(batches, ["k"], 50))
        assert np.concatenate([t["k"].to_numpy() for t in tables]).tolist() == keys.tolist()
        seen = [set(t["k"].to_pylist()) for t in tables]
        assert sum(map(len, seen)) == len(set().union(*seen))
        assert all(len(group_starts(t, ["k"])) == len(s) for t, s in zip(tables, seen, strict=True))


TRICKY = ["", "  ", None, "a's don't WE'RE i'll'x <|endoftext|> foo<|startoftext|>bar", "İstanbul ΣΑΣ ﬁn ½ x² a\xa0b\x1cc\x85d", "日本語 テスト😀 ok?!.. !!!a 3.14 µm ſt", "Ünïcödé, ÀÉ. x " * 3000, "x" * 5000, "e\u0301 \u0301a"]


def test_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    expected = [e.ids for e in Tokenizer.from_file(vocabulary()).encode_batch([t or "" for t in TRICKY], add_special_tokens=False)]
    assert list(tokens.encoded(TRICKY, vocabulary(), False)) == [len(x) for x in expected]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encoded(TRICKY, vocabulary(), True)] == expected


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_tokens_of_any_text(texts):
    from tokenizers import Tokenizer

    expected = [len(e.ids) for e in Tokenizer.from_file(vocabulary()).encode_batch(texts, add_special_tokens=False)]
    assert list(tokens.encoded(texts, vocabulary(), False)) == expected


def test_the_word_table_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS", 10)
    enc = tokens.WordEncoder(vocabulary(), False)
    enc.learn({b"w%d" % k for k in range(30)})
    enc.learn({b"other"})
    assert set(enc.known) == {b"other"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_packing_keeps_its_bound(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offset, free = packing.best_fit_decreasing(lengths, 20)
    for b in range(len(free)):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == [0, *lengths[own].cumsum()[:-1].tolist()]
        assert lengths[own].sum() + free[b] == 20
    assert packing.lower_bound(lengths, 20) <= len(free) <= max(1, round(11 / 9 * packing.lower_bound(lengths, 20) + 1)) * 2


def test_bounds_see_more_than_the_sum():
    assert packing.lower_bound(np.array([11] * 6), 20) == 6
    assert packing.lower_bound(np.array([7] * 6), 20) == 3
    assert packing.lower_bound(np.array([], np.int64), 20) == 0


def test_an_exchange_never_takes_a_worse_packing():
    import pandas as pd

    pieces = pd.DataFrame({"length": [10, 10, 10, 10], "part": 0, "sequence_id": [5, 5, 6, 6], "offset": [0, 10, 0, 10]})
    kept = packing._pack(pieces, 1, 20)
    assert kept["sequence_id"].tolist() == [5, 5, 6, 6] and not kept["loose"].any()
    joined = packing._pack(pieces.assign(sequence_id=[5, 6, 7, 8], offset=0), 1, 20)
    assert joined["sequence_id"].nunique() == 2


@pytest.mark.parametrize(("low", "high"), [(450, 700), (300, 900), (1, 2049)])
def test_no_group_of_an_exchange_grows(monkeypatch, low, high):
    """Rounds of exchange over 40 partitions: a group never has over FAN_IN * PIECES pieces, and no more sequences come out than of one task."""
    import pandas as pd

    monkeypatch.setattr(packing, "PIECES", 256)
    monkeypatch.setattr(packing, "FAN_IN", 4)
    rng = np.random.default_rng(low)
    n, parts, step, done = 40 * 256, 40, 0, []
    todo = pd.DataFrame({"length": rng.integers(low, high, n), "part": rng.integers(0, parts, n), "sequence_id": 0, "offset": 0, "uid": range(n)})
    while True:
        groups = [packing._pack(g, step, 2048) for _, g in todo.groupby("part")]
        assert max(map(len, groups)) <= 4 * 256 and all(g["loose"].sum() <= 256 for g in groups)
        packed = pd.concat(groups)
        if parts == 1 or not packed["loose"].any():
            break
        done.append(packed[~packed["loose"]])
        parts, step = -(-parts // 4), step + 1
        todo = packed[packed["loose"]].assign(part=lambda d: d["part"] // 4)
    packed = pd.concat([*done, packed])
    assert sorted(packed["uid"]) == list(range(n)) and packed.groupby("sequence_id")["length"].sum().max() <= 2048
    alone = len(packing.best_fit_decreasing(packed["length"].to_numpy(), 2048)[2])
    assert packed["sequence_id"].nunique() <= alone * 1.03 + 1 and (packed["gap"] >= 0).all()


def test_a_piece_longer_than_a_sequence_is_an_error():
    import pandas as pd

    with pytest.raises(ValueError, match="longer"):
        packing._pack(pd.DataFrame({"length": [5, 21], "part": 0}), 0, 20)


def test_logits_are_those_of_a_plain_convolution(monkeypatch):
    """Pieces that overlap, the word table and its restart against filters run over the whole text."""
    rng = np.random.default_rng(12)
    texts = [[f"w{k}" for k in rng.integers(0, 60, n)] for n in (0, 1, 2, 3, 40, 333)]
    model = toxicity.train([" ".join(t) for t in texts] * 5, np.arange(30, dtype=np.float32) % 2)
    monkeypatch.setattr(toxicity, "PIECE", 7)
    monkeypatch.setattr(toxicity, "KNOWN", 20)
    scorer = toxicity.Scorer(model)
    for t in texts * 2:
        vectors = np.array([model.embed[list(toxicity.parts(w))].sum(axis=0) for w in t]).reshape(-1, toxicity.WIDTH)
        vectors = np.concatenate([vectors, np.zeros((max(0, 3 - len(t)), toxicity.WIDTH))])
        z = [max(sum(vectors[s + j] @ model.filters[w][j][:, f] for j in range(w)) for s in range(len(vectors) - w + 1)) + model.bias[w][f] for w in toxicity.SPANS for f in range(toxicity.FILTERS)]
        assert scorer.logit(t) == pytest.approx(float(np.maximum(z, 0) @ model.out + model.out_bias), abs=1e-3)


def test_posterior_prunes_only_far_pairs():
    join = near_duplicates.Join()
    least = near_duplicates.least_equal(join)
    assert (np.diff(least) >= 0).all() and 0 < least[32] < 0.8 * 32 and least[-1] < 0.8 * join.values
    rng = np.random.default_rng(0)
    equal = rng.random((20000, join.values)) < 0.8
    lost = np.zeros(20000, bool)
    for e in range(join.step, join.values + 1, join.step):
        lost |= equal[:, :e].sum(axis=1) < least[e]
    assert lost.mean() < 1e-3


def test_commons_and_labels():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(12)]
    a, b = np.triu_indices(12, 1)
    for cells in (64, 1 << 20):
        got = near_duplicates.commons(sets, a, b, cells)
        assert got.tolist() == [len(set(sets[x].tolist()) & set(sets[y].tolist())) for x, y in zip(a, b, strict=True)]
    assert near_duplicates.commons([np.array([1], np.uint64), np.array([2], np.uint64)], np.array([0]), np.array([1])).tolist() == [0]
    assert near_duplicates._labels(np.array([5, 9, 2, 7]), np.array([0, 1]), np.array([1, 3])).tolist() == [5, 5, 2, 5]


def test_only_surviving_pairs_are_verified(monkeypatch):
    """A chain of texts, each 0.7 like the next: a pair or so for each link is verified, not all pairs of the chain."""
    rng = np.random.default_rng(9)
    words_, n = [f"c{k}" for k in rng.permutation(60 * 120)], 120
    texts = [" ".join(words_[52 * k : 52 * k + 300]) for k in range(n)]
    join, verified = near_duplicates.Join(), []
    sign = next(near_duplicates._sign([pa.RecordBatch.from_pydict({"text": texts})], join)).to_pydict()
    made = next(near_duplicates._shingled([pa.RecordBatch.from_pydict({"uid": list(range(n)), "text": texts})], join)).to_pydict()
    commons = near_duplicates.commons
    monkeypatch.setattr(near_duplicates, "commons", lambda sets, a, b: verified.append(len(a)) or commons(sets, a, b))
    batch = pa.RecordBatch.from_pydict({"root": [0] * n, "i": [0] * n, "j": [0] * n, "side": [0] * n, "uid": list(range(n)), "n": [1] * n, "code": sign["code"], "length": made["length"], "shingles": made["shingles"]})
    out = next(near_duplicates._verify([batch], join)).to_pydict()
    assert out["links"] == [0] * n and out["b"] == out["a"]
    assert 0 < sum(verified) <= n - 1


def test_pairs_are_all_pairs_of_a_group():
    starts, n = np.array([0, 3, 4]), 6
    side, same = np.array([0, 1, 1, 0, 0, 1]), np.array([True, True, True, True, False, False])
    got = {(int(x), int(y)) for a, b in near_duplicates._pairs(starts, n, side, same) for x, y in zip(a, b, strict=True)}
    assert got == {(0, 1), (0, 2), (1, 2), (4, 5)}


def test_minhash_estimates_similarity():
    a, b = np.arange(800, dtype=np.uint64), np.arange(100, 900, dtype=np.uint64)
    near = near_duplicates.minhash(words.mix(a), 600) == near_duplicates.minhash(words.mix(b), 600)
    assert abs(near.mean() - 700 / 900) < 0.06


def test_anchors_do_not_depend_on_what_is_around():
    rng = np.random.default_rng(2)
    p = passages.Paragraphs()
    for _ in range(300):
        shared = [f"s{k}" for k in rng.integers(0, 10**6, 50)]
        texts = [[f"t{k}" for k in rng.integers(0, 10**6, rng.integers(0, 90))] + shared + [f"t{k}" for k in rng.integers(0, 10**6, rng.integers(0, 90))] for _ in range(2)]
        text, start, all_words, at = passages.anchors([words.hashed(t) for t in texts], p)
        key = passages.digests(texts, text, start, p)
        assert set(key[text == 0, 0]) & set(key[text == 1, 0])
        runs = [" ".join(texts[t][s : s + p.words]) for t, s in zip(text, start, strict=True)]
        assert len(set(runs)) == len(set(key[:, 0])) == len(set(key[:, 1]))
        assert len(passages.bands_of(all_words, at, p)) == len(runs)
    assert len(passages.anchors([np.zeros(0, np.uint64), np.arange(3, dtype=np.uint64)], p)[0]) == 0


def test_one_pass_gives_places_and_bands():
    """A paragraph's place and digest always, its bands once for equal words."""
    rng = np.random.default_rng(3)
    p = passages.Paragraphs()
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 500, n)) for n in (300, 5, 0, 120)]
    texts += [None, texts[0]]
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, None, 3, 4, 5, 6]), "loc": list(range(6)), "text": texts})
    found = pa.Table.from_batches(passages._banded([batch.slice(0, 3), batch.slice(3)], p)).to_pylist()
    places = pa.Table.from_batches(passages._places([batch], p)).to_pylist()
    assert [{k: r[k] for k in places[0]} for r in found] == places and {r["loc"] for r in places} == {0, 3, 5}
    bands, met = {}, []
    for r in found:
        line = words.split_words(texts[r["loc"]])[r["start"] : r["start"] + p.words]
        key, check = passages.digests([line], np.zeros(1, int), np.zeros(1, int), p)[0].tolist()
        given = [r[name] for name in passages.band_names(p)]
        assert (r["key"], r["check"]) == (key, check) and (given == [None] * p.bands) == (key in bands)
        if key not in bands:
            bands[key] = given
            met.append((given, passages.bands_of(words.hashed_lines([words.word_line(" ".join(line))])[0], np.zeros(1, int), p)[0].view(np.int64).tolist()))
    assert len(found) > len(met) and all(a == b for a, b in met)


@pytest.mark.parametrize("vocab", [3, 12, 400])
@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_paragraphs_are_linked_as_by_brute_force(vocab, threshold):
    """Groups in one block and in two, with repeated shingles: the pairs that bits drop are none of those at the threshold."""
    rng, p = np.random.default_rng(vocab), passages.Paragraphs(threshold=threshold)
    base = rng.integers(0, vocab, (12, 16))
    sets = words.mix(np.where(rng.random((120, 16)) < 0.06, rng.integers(0, vocab, (120, 16)), base[rng.integers(0, 12, 120)]).astype(np.uint64))
    band, side, j = np.repeat([1, 2, 3], 40), np.arange(120) % 2, np.repeat([0, 1, 0], 40)
    side[band != 2] = 0
    inside = [x.tobytes() for x in np.sort(sets, axis=1)]
    batch = pa.RecordBatch.from_pydict({"band": band, "i": np.zeros(120, int), "j": j, "side": side, "uid": np.arange(120), "inside": inside})
    found = {(r["a"], r["b"]) for b in passages._verify([batch.slice(0, 50), batch.slice(50)], p) for r in b.to_pylist()}
    label = list(range(120))
    for _ in range(120):
        old = list(label)
        for x, y in itertools.combinations(range(120), 2):
            a, b = set(sets[x].tolist()), set(sets[y].tolist())
            if band[x] == band[y] and (j[x] == 0 or side[x] != side[y]) and len(a & b) >= threshold * len(a | b) - 1e-9:
                label[x] = label[y] = min(label[x], label[y])
        if old == label:
            break
    assert found == {(k, x) for k, x in enumerate(label) if k != x}


@pytest.mark.parametrize("within", [20, 21, 50])
def test_words_beside_paragraphs(within, monkeypatch):
    """What is asked of several texts in one pass is what each text has there, to its ends; slabs and slices of batches change nothing."""
    p = passages.Paragraphs(within=within)
    reach, rng = p.window - 1, np.random.default_rng(within)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 900, n)) for n in (20, 25, 300, 21, 90)]
    starts = [sorted({0, n - 20, n // 2 - 10}) for n in (len(x.split()) for x in texts)]
    asked = [[{"key": 100 * t + s, "side": side, "start": s, "cluster": t} for s in own for side in (0, 1)] for t, own in enumerate(starts)]
    kind = pa.list_(pa.struct([("key", pa.int64()), ("side", pa.int32()), ("start", pa.int32()), ("cluster", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([7, None, 9, 10, 11]), pa.array(range(5)), pa.array(asked, kind), pa.array(texts)], ["id", "loc", "asked", "text"])
    expected = []
    for t, x in enumerate(texts):
        h = np.maximum(words.hashed_lines([x.encode()])[0] >> np.uint64(32), np.uint64(1)).astype(np.uint32)
        for a in asked[t]:
            part = h[a["start"] + 20 :][:reach] if a["side"] == 0 else h[max(a["start"] - reach, 0) : a["start"]][::-1]
            if len(part):
                expected.append((batch["id"][t].as_py(), t, a["key"], a["side"], int(part[0]), 0, a["start"], a["cluster"], 0, part.tobytes().ljust(4 * reach, b"\0")))
    for size in (3, 100_000):
        monkeypatch.setattr(passages._slabs, "__defaults__", (size,))
        rows = [tuple(r.values()) for b in passages._beside([batch.slice(0, 1), batch.slice(1, 0), batch.slice(1)], p) for r in b.to_pylist()]
        assert rows == expected and bool(rows) == (reach > 0)
        insides = [r for b in passages._insides([batch.slice(0, 1), batch.slice(1)], p) for r in b.to_pylist()]
        assert [r["key"] for r in insides] == [a["key"] for x in asked for a in x]
        for r, (t, a) in zip(insides, [(t, a) for t, x in enumerate(asked) for a in x], strict=True):
            assert r["inside"] == np.sort(passages.grams(words.hashed_lines([texts[t].encode()])[0][a["start"] : a["start"] + 20], p.size)).tobytes()


def test_extension_over_one_edit():
    end = [0] * 3
    a = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, *end]
    others = {"changed": [1, 2, 99, 4, 5, 6, 7, 8, 9, 10, 11, 12, *end], "left out": [1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 0, *end], "put in": [1, 2, 98, 3, 4, 5, 6, 7, 8, 9, 10, 11, *end], "other": [1, 2, 50, 51, 52, 53, 54, 55, 56, 57, 58, 59, *end], "again": [1, 2, 99, 4, 5, 6, 7, 77, 9, 10, 11, 12, *end]}
    rows = np.array([a, *others.values()], np.uint32)
    other, alike = np.arange(1, 6), np.full(5, 2)
    assert passages._over_an_edit(rows, np.zeros(5, int), other, alike, 5).tolist() == [12, 12, 11, 2, 2]
    assert passages._over_an_edit(rows, other, np.zeros(5, int), alike, 5).tolist() == [12, 11, 12, 2, 2]


def shard_of(keys, shards, nodes=sharding.NODES):
    """The shard of each of some sorted keys, as the operator finds it."""
    places, owners = sharding.ring(shards, nodes)
    first, shard, _ = sharding.walk(np.bincount(sharding.arcs(keys, places), minlength=len(places) + 1), owners, shards)
    return shard[np.searchsorted(first, np.arange(len(keys)), side="right") - 1]


def ring_keys(rng, n, groups=()):
    keys = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
    for size in groups:
        keys[rng.permutation(n)[:size]] = keys[0]
        keys = rng.permutation(keys)
    return np.sort(keys)


@pytest.mark.parametrize(("shards", "n", "nodes"), [(1, 50, 4), (3, 200, 2), (8, 3000, 16), (257, 3000, 8), (5000, 12_345, 3), (10, 4, 5)])
def test_the_walk_is_that_of_each_row(shards, n, nodes):
    keys = ring_keys(np.random.default_rng(shards), n, (n // 3,))
    places, owners = sharding.ring(shards, nodes)
    assert len(places) == shards * nodes and (np.diff(places.astype(object)) >= 0).all()
    room = [n // shards + (s < n % shards) for s in range(shards)]
    expected = []
    for k in keys:  # row by row, node by node
        at = int((places < k).sum())
        while not room[owners[at % len(owners)]]:
            at += 1
        room[owners[at % len(owners)]] -= 1
        expected.append(owners[at % len(owners)])
    assert shard_of(keys, shards, nodes).tolist() == expected


@pytest.mark.parametrize("shards", [257, 5000])
def test_slots_are_gapless_with_many_shards(shards):
    counts = np.random.default_rng(1).integers(0, 3, shards * 64 + 1)
    first, shard, slot = sharding.walk(counts, sharding.ring(shards, 64)[1], shards)
    ends = np.append(first[1:], counts.sum())
    used = np.zeros(shards, np.int64)
    for s, x, y, z in zip(shard, first, ends, slot, strict=True):
        assert z == used[s]
        used[s] += y - x
    assert used.sum() == counts.sum() and used.max() - used.min() <= 1


@pytest.mark.parametrize("groups", [(), (600,) * 8 + (3000, 3000)])
def test_ring_moves_little_when_it_grows(groups):
    keys = ring_keys(np.random.default_rng(3), 60_000, groups)
    before, after = shard_of(keys, 8), shard_of(keys, 9)
    assert 1 / 9 - 0.001 <= np.mean(before != after) < 0.2
    split = sum(len(set(before[keys == k].tolist())) > 1 for k, n in zip(*np.unique(keys, return_counts=True), strict=True) if n > 1)
    assert split <= 8  # of the texts, one at most at each shard that fills


def test_tile_keeps_the_nearest():
    import pandas as pd

    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=(300, 16)), np.repeat(rng.normal(size=(1, 16)), 40, axis=0)])
    batch = pa.RecordBatch.from_pydict({"uid": list(range(len(v))), "id": [0] * len(v), "vector": v.tolist()})
    rows = pd.concat([b.to_pandas() for b in neighbours._round([batch])])
    got = neighbours._tile(rows[rows["uid"] % 17 == 0], rows, 5)
    norm = np.sqrt((v * v).sum(axis=1))
    assert len(got) < 2000
    for q, found in got.groupby("q"):
        score = (v * v[q]).sum(axis=1) / (norm * norm[q])
        inside = score[found["c"]]
        assert ((found["low"] <= inside) & (inside <= found["high"])).all() and q not in set(found["c"])
        score[q] = -9
        assert set(np.flatnonzero(score >= np.sort(score)[-5]).tolist()) <= set(found["c"])


def test_classifier_learns_and_calibrates():
    rng = np.random.default_rng(5)
    plain = [f"w{k}" for k in range(300)]
    texts, labels = [], []
    for k in range(600):
        t = list(rng.choice(plain, rng.integers(5, 60)))
        if k % 3 == 0:
            t[rng.integers(len(t))] = rng.choice(["idiotic", "idiots", "rotten"])
        texts.append(" ".join(t))
        labels.append(k % 3 == 0)
    model = toxicity.train(texts, np.array(labels, np.float32))
    scorer = toxicity.Scorer(model)
    got = np.array([scorer.score(t) >= 0.5 for t in texts])
    assert (got == np.array(labels)).mean() > 0.97
    assert scorer.score("w1 w2 idioten w3") > scorer.score("w1 w2 w4 w3")
    for odd in (None, "", "x", "rotten " * 20000):
        assert 0 <= scorer.score(odd) <= 1
    nothing = toxicity.Scorer(toxicity.train(["a", "b"], np.array([0, 0], np.float32)))
    assert nothing.score("idiots") < 0.5


def test_shingles_of_short_texts():
    h = words.hashed(["a", "b"])
    assert len(words.shingles(h, 5)) == 1 and len(words.shingles(h[:0], 5)) == 0
    assert zlib.crc32(b"") == 0 and words.split_words(None) == []


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_colliding_bands(step):
    """Rows of bands with more than one key and more than one text, however batches cut them."""
    rng = np.random.default_rng(6)
    b, t, k = rng.integers(0, 300, 1000), rng.integers(0, 3, 1000).astype(np.int32), rng.integers(0, 4, 1000)
    b[:40], b[40:80], t[40:80], b[80:120], k[80:120] = 900, 901, 7, 902, 5  # a large band, one of a single text, one of a single key
    order = np.lexsort((t, b))
    b, t, k = b[order], t[order], k[order]
    batches = (pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (b, t, k)], ["band", "tag", "key"]) for i in range(0, 1000, step))
    got = {pair for r in passages._colliding(batches) for pair in zip(r["band"].to_pylist(), r["key"].to_pylist(), strict=True)}
    assert got == {(x, y) for x, y in zip(b.tolist(), k.tolist(), strict=True) if len(set(k[b == x])) > 1 and len(set(t[b == x])) > 1}


def test_lines_of_words_are_hashed_as_words():
    """ASCII texts and others, words of any length, at any place of any text: the same words have the same hash."""
    texts = ["A b_1, c!", None, "", " ", "\x1c a\x1fb\x0bc", "ÀÉ İstanbul a", "x \udcff c", *("z" * n + " a" for n in (7, 8, 9, 16, 17, 63, 64, 65, 500))]
    texts += ["é " + t for t in texts if t]
    known: dict[str, int] = {}
    for size in (1, 40, 1 << 19):
        for text, (line, h) in zip(texts, words.hashed_texts(texts, size), strict=True):
            split = words.split_words(text)
            assert line == " ".join(split).encode("utf-8", "surrogatepass") and len(h) == len(split)
            assert all(known.setdefault(w, x) == x for w, x in zip(split, h.tolist(), strict=True))
    assert len(set(known.values())) == len(known) > 12
    assert list(words.hashed_texts([])) == []


def test_texts_without_spaces_leave_nothing_behind():
    """Each is one word, of its own: none is remembered, by the encoder, the classifier or the hashes."""
    from tokenizers import Tokenizer

    texts = ["日本語のテキスト" * 40 + str(k) for k in range(300)]
    library = Tokenizer.from_file(vocabulary())
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    for ids in (False, True):
        enc = tokens.WordEncoder(vocabulary(), ids)
        for t, n in zip(texts, expected, strict=True):
            word = t.encode()
            enc.learn({word, b"short"})
            assert (len(enc.known[word]) // 4 if ids else enc.known[word]) == n and len(enc.known.long) <= 2
        assert set(enc.known) == {b"short"} and enc.known.bytes < 1000


def test_word_tables_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_BYTES", 50_000)
    enc = tokens.WordEncoder(vocabulary(), True)
    for k in range(40):
        enc.learn({f"word{k}x{j}".encode() for j in range(100)})
    assert enc.known.bytes <= 50_000 + 100 * (tokens.ENTRY + 64 + 4 * 64) and len(enc.known) < 600
    monkeypatch.setattr(toxicity, "KNOWN_CHARS", 5000)
    model = toxicity._untrained(7)[0]
    model.threshold = dict.fromkeys(toxicity.LANGUAGES, 0.0)
    scorer, plain = toxicity.Scorer(model), toxicity.Scorer(model)
    for k in range(50):
        scorer.score("字" * 900 + str(k))
        assert scorer.words.chars <= 5000 + 1000
    assert scorer.score("some text") == plain.score("some text")
    monkeypatch.setattr(words, "KNOWN_CHARS", 5000)
    for k in range(50):
        words.hashed(["字" * 900 + str(k)])
        assert words._HASHES.chars <= 5000 + 1000


@pytest.mark.parametrize("apart", [1e-3, 1e-4, 1e-5])
def test_near_copies_do_not_all_leave_a_tile(apart):
    """Vectors of one cluster that the first layer of codes cannot tell apart: a few pairs a query are left, and the nearest are among them."""
    import pandas as pd

    rng = np.random.default_rng(3)
    base = rng.standard_normal(64)
    v = base + apart * rng.standard_normal((3000, 64))
    batch = pa.RecordBatch.from_pydict({"uid": list(range(3000)), "id": list(range(3000)), "vector": v.tolist()})
    rows = pd.concat([b.to_pandas() for b in neighbours._round([batch])])
    asked = rows[rows["uid"] % 50 == 0]
    left = neighbours._tile(asked, rows, 5)
    assert len(left) < (20 if apart > 1e-5 else 600) * len(asked)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    for u in asked["uid"]:
        score = unit @ unit[u]
        score[u] = -2
        assert set(np.argsort(-score)[:5]) <= set(left["c"][left["q"] == u])


def test_encoders_forget_words_at_a_tasks_end():
    path = vocabulary()
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["some words of text", "日本語" * 50]})
    n = [b["n_tokens"].to_pylist() for b in tokens._count([batch, batch], path)]
    assert n[0] == n[1] and not tokens.encoder(path).known and not tokens.encoder(path).known.long and tokens.encoder(path).known.bytes == 0
    pieces = [b.num_rows for b in packing._cut([batch], path, 8, 0)]
    assert sum(pieces) > 2 and not tokens.encoder(path, True).known


def test_a_scorers_table_takes_no_more_than_its_rows(monkeypatch):
    monkeypatch.setattr(toxicity, "KNOWN", 50_000)
    model, _ = toxicity._untrained(1)
    table = 4 * toxicity.FILTERS * len(toxicity.PLACES) * (toxicity.KNOWN + toxicity.PIECE)
    tracemalloc.start()
    try:
        scorer = toxicity.Scorer(model)
        first = [scorer.logit([f"w{k}" for k in range(at, at + 100)]) for at in range(0, 40_000, 100)][0]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 2.2 * table, most / table  # with the words; over that when the table was grown by doubling
    long = [f"v{k}" for k in range(70_000)]  # one text of more words than there is room for
    assert scorer.logit(long) == toxicity.Scorer(model).logit(long)
    assert scorer.logit([f"w{k}" for k in range(100)]) == first and len(scorer.adds) == toxicity.KNOWN + toxicity.PIECE


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from([*"aZ_9 ,.-\n\x1c\x85\xa0éÉßİŉ«»’“”字।ा́​٣²½", "\ud800", "\U0001d400", "\U0001f600"])).map("".join)))
def test_lines_have_the_words_of_any_text(text):
    assert words.word_line(text) == " ".join(words.split_words(text)).encode("utf-8", "surrogatepass")


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_colliding_bands_in_any_order_of_texts(step):
    """Rows come sorted by band alone."""
    rng = np.random.default_rng(6)
    b, t, k = np.sort(rng.integers(0, 300, 1000)), rng.integers(0, 3, 1000).astype(np.int32), rng.integers(0, 4, 1000)
    b[900:930], b[930:960], t[930:960], b[960:], k[960:] = 900, 901, 7, 902, 5  # a large band, one of a single text, one of a single key
    batches = (pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (b, t, k)], ["band", "tag", "key"]) for i in range(0, 1000, step))
    got = {pair for r in passages._colliding(batches) for pair in zip(r["band"].to_pylist(), r["key"].to_pylist(), strict=True)}
    assert got == {(x, y) for x, y in zip(b.tolist(), k.tolist(), strict=True) if len(set(k[b == x])) > 1 and len(set(t[b == x])) > 1}
