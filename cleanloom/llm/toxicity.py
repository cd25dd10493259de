"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of PARTS hashed ones: two for the word (so that a collision with another word is only half a
word) and one for each of its starts of 4 and 5 characters (for words that inflect). Filters of several widths run over the
words of the whole text; each filter's maximum goes, through a rectifier, into a logistic unit. Scoring is a map over Arrow batches, in which a worker keeps, for a
bounded number of words, what a word adds to each filter at each offset. Thresholds are calibrated on the labelled rows
that training does not see, one in HELD, one threshold for each language; the language is read off the text itself (its
commonest function words), never from a column, and the score is shifted so that 0.5 is the threshold.

Every labelled row is used, in training or for the thresholds. Few rows are trained on in numpy on the driver. Where there are
more, that model of some of them is only the start. In each of ROUNDS rounds every shard (about SHARD rows; how many there are follows from the number of labelled rows
alone, and a row's shard and place from hashes of its id) goes on from the common model over its own rows, and what the shards have changed is averaged (an
embedding over the shards that have changed it). So the model does not depend on how Spark deals its partitions. All held rows then
have a score by the common model; how many there are of each kind goes to the driver by language and score, in steps of 1 / STEPS. Only texts with a label move.

Defined results: null text counts as empty, and an empty text has a score too (all filters at their bias); null labels are
not learned from; without labels of both kinds all scores are near 0 and nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import forget, pieces, stage, text_batches, tidy, unstage
from .exact_dedup import FILTERS as JOIN_FILTERS
from .exact_dedup import settings
from .words import split_words

#: labelled rows of either kind that the driver trains on at most; where there are more, shards of so many rows go on from there
SAMPLE, SHARD, ROUNDS = 2000, 4096, 2
#: rows of a shard that are learned from together
CHUNK = 1000
#: embeddings in a row of what a shard has changed, steps and bound of the scores that thresholds are chosen from
BLOCK, STEPS, MOST = 2048, 256, 64
BUCKETS, PARTS, WIDTH, FILTERS, SPANS = 1 << 17, 4, 16, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, DECAY, HELD = 6, 64, 0.05, 1e-5, 5
#: words that a worker remembers and their characters, words of a long text that are looked at together
KNOWN, KNOWN_CHARS, PIECE = 200_000, 8 << 20, 8192
#: fixed values: common function words of each language
FUNCTION_WORDS = {
    "en": "the and of to in is that it for with on was are this from".split(),
    "fr": "le la les de des et que un une est pas pour dans du qui".split(),
    "de": "der die das und ist nicht ein eine mit den von zu sich auf im".split(),
    "es": "el la los las de que en un una por con para no se del".split(),
}
LANGUAGES = (*FUNCTION_WORDS, "other")
#: (span, offset) of what stands side by side in a word's row of FILTERS values each
PLACES = tuple((w, j) for w in SPANS for j in range(w))


@dataclass
class Model:
    embed: np.ndarray
    filters: dict[int, np.ndarray]  # span -> (span, WIDTH, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    threshold: dict[str, float] = field(default_factory=dict)


def parts(word: str) -> tuple[int, ...]:
    h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
    starts = (xxhash.xxh64_intdigest(word[:n].encode("utf-8", "surrogatepass"), seed=n) % BUCKETS for n in (4, 5))
    return (h % BUCKETS, (h >> 32) % BUCKETS, *starts)


def language(words: Iterable[str]) -> str:
    seen = set(words)
    best = max(FUNCTION_WORDS, key=lambda k: (sum(w in seen for w in FUNCTION_WORDS[k]), k))
    return best if any(w in seen for w in FUNCTION_WORDS[best]) else "other"


class Vocabulary(dict):
    """Words to rows; row 0 is the padding. New words gather in `new` until they are taken."""

    def __init__(self):
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self.chars += len(word)
        self[word] = n = len(self) + 1
        return n

    def rows(self, words: list[str]) -> np.ndarray:
        ids = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return np.concatenate([ids, np.zeros(max(0, max(SPANS) - len(ids)), np.int32)])

    def take(self) -> np.ndarray:
        new, self.new = self.new, []
        return np.array([parts(w) for w in new], np.int64).reshape(-1, PARTS)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.side = np.concatenate([model.filters[w][j] for w, j in PLACES], axis=1)
        self.adds = np.zeros((0, self.side.shape[1]), np.float32)
        self.start()

    def start(self) -> None:
        self.words, self.n = Vocabulary(), 1
        if len(self.adds) != (room := KNOWN + PIECE):  # memory is only taken as rows are written; grown by doubling, rows would be there three times
            self.adds = np.zeros((room, self.adds.shape[1]), np.float32)

    def logit(self, words: list[str]) -> float:
        if len(self.words) > KNOWN or self.words.chars > KNOWN_CHARS:
            self.start()
        ids = self.words.rows(words)
        if len(new := self.words.take()):
            if (more := self.n + len(new) - len(self.adds)) > 0:  # the words of one text, where it has more than there is room for
                self.adds = np.concatenate([self.adds, np.zeros((more, self.adds.shape[1]), np.float32)])
            self.adds[self.n : self.n + len(new)] = self.model.embed[new].sum(axis=1) @ self.side
            self.n += len(new)
        best = {w: np.full(FILTERS, -np.inf, np.float32) for w in SPANS}
        for s in range(0, len(ids), PIECE):  # long texts in pieces that overlap, of which the maximum is taken
            adds = self.adds[ids[s : s + PIECE + max(SPANS) - 1]]
            for w in SPANS:
                if (n := len(adds) - w + 1) > 0:
                    best[w] = np.maximum(best[w], sum(adds[j : j + n, k * FILTERS : (k + 1) * FILTERS] for k, (v, j) in enumerate(PLACES) if v == w).max(axis=0))
        z = np.concatenate([best[w] + self.model.bias[w] for w in SPANS])
        return float(np.maximum(z, 0) @ self.model.out + self.model.out_bias)

    def score(self, text: str | None) -> float:
        words = split_words(text)
        z = self.logit(words) - self.model.threshold[language(words)]
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _untrained(seed: int) -> tuple[Model, dict]:
    """A model, and Adagrad's sums of squares."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32),
        {w: rng.normal(0, 0.3 / w**0.5, (w, WIDTH, FILTERS)).astype(np.float32) for w in SPANS},
        {w: np.zeros(FILTERS, np.float32) for w in SPANS},
        np.abs(rng.normal(0, 0.3, FILTERS * len(SPANS))).astype(np.float32),
        0.0,
    )
    squares = {"e": np.full(BUCKETS, 1e-6, np.float32), "o": np.full_like(model.out, 1e-6)} | {(k, w): np.full_like(v[w], 1e-6) for k, v in (("f", model.filters), ("b", model.bias)) for w in SPANS}
    return model, squares


def _constant(model: Model) -> Model:
    model.out[:], model.out_bias, model.threshold = 0, -30.0, dict.fromkeys(LANGUAGES, 0.0)
    return model


def _learn(model: Model, squares: dict, texts: list[str | None], labels: np.ndarray, rng: np.random.Generator, epochs: int) -> None:
    """Steps over all texts, in random order."""
    vocabulary = Vocabulary()
    ids = [vocabulary.rows(split_words(t)) for t in texts]
    subs = np.concatenate([np.zeros((1, PARTS), np.int64), vocabulary.take()])
    for _ in range(epochs):
        learned = rng.permutation(len(ids))
        for at in range(0, len(learned), BATCH):
            batch = learned[at : at + BATCH]
            _step(model, [ids[i] for i in batch], subs, labels[batch], squares)


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Every HELD-th text, in random order, is held for the thresholds."""
    model, squares = _untrained(seed)
    if len(set(labels.tolist())) < 2 or len(labels) < 2 * HELD:
        return _constant(model)
    rng = np.random.default_rng([seed, 1])
    order = rng.permutation(len(texts))
    held, learned = order[::HELD], np.delete(order, np.arange(0, len(order), HELD))
    _learn(model, squares, [texts[i] for i in learned], labels[learned], rng, EPOCHS)
    scorer = Scorer(model)
    words = [split_words(texts[i]) for i in held]
    y = labels[held]
    model.threshold = calibrate(np.array([scorer.logit(w) for w in words]), y, 1 - y, [language(w) for w in words])
    return model


def _step(model: Model, texts: list[np.ndarray], subs: np.ndarray, y: np.ndarray, squares: dict) -> None:
    """One step of Adagrad; only the words behind each maximum have a gradient."""
    ends = np.cumsum([len(t) for t in texts])
    ids, n = np.concatenate(texts), ends[-1]
    used, at = np.unique(ids, return_inverse=True)
    vectors = model.embed[subs[used]].sum(axis=1)
    vectors[used == 0] = 0
    feats, wins = [], {}
    for w in SPANS:
        sums = (vectors @ model.filters[w][0])[at[: n - w + 1]]
        for j in range(1, w):
            sums += (vectors @ model.filters[w][j])[at[j : n - w + 1 + j]]
        wins[w] = np.stack([e - len(t) + sums[e - len(t) : e - w + 1].argmax(axis=0) for t, e in zip(texts, ends, strict=True)])
        feats.append(np.take_along_axis(sums, wins[w], axis=0) + model.bias[w])
    z = np.concatenate(feats, axis=1)
    h = np.maximum(z, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ model.out + model.out_bias, -50, 50)))
    g = ((p - y) / len(y)).astype(np.float32)
    to_z = g[:, None] * model.out[None, :] * (z > 0)
    grads, rows, values = {"o": h.T @ g + DECAY * model.out}, [], []
    for k, w in enumerate(SPANS):
        gz = to_z[:, k * FILTERS : (k + 1) * FILTERS]
        grads["b", w] = gz.sum(axis=0)
        grads["f", w] = np.stack([np.einsum("tf,tfd->df", gz, vectors[at[wins[w] + j]]) for j in range(w)]) + DECAY * model.filters[w]
        for j in range(w):
            rows.append(ids[wins[w] + j].ravel())
            values.append((gz[:, :, None] * model.filters[w][j].T[None]).reshape(-1, WIDTH))
    model.out_bias -= RATE * float(g.sum())
    for key, grad in grads.items():
        value = model.out if key == "o" else (model.filters if key[0] == "f" else model.bias)[key[1]]
        squares[key] += grad * grad
        value -= RATE * grad / np.sqrt(squares[key])
    rows, values = np.concatenate(rows), np.concatenate(values)
    live = (rows > 0) & values.any(axis=1)
    touched, where = np.unique(subs[rows[live]].ravel(), return_inverse=True)
    grad = np.zeros((len(touched), WIDTH), np.float32)
    np.add.at(grad, where.ravel(), np.repeat(values[live], PARTS, axis=0))
    grad += DECAY * model.embed[touched]
    squares["e"][touched] += (grad * grad).mean(axis=1)
    model.embed[touched] -= RATE * grad / np.sqrt(squares["e"][touched])[:, None]


def calibrate(scores: np.ndarray, ones: np.ndarray, zeros: np.ndarray, languages: list[str], least: int = 20) -> dict[str, float]:
    """For each language the threshold of the fewest errors, halfway between neighbours; languages with less than `least`
    texts of either kind take the threshold of all. ones, zeros: how many texts of either kind have a score."""

    def best(s: np.ndarray, one: np.ndarray, zero: np.ndarray) -> float:
        order = np.argsort(s, kind="stable")
        s, one, zero = s[order], one[order], zero[order]
        wrong = np.concatenate([[0], one.cumsum()]) + np.concatenate([zero[::-1].cumsum()[::-1], [0]])
        ties = np.flatnonzero(wrong == wrong.min())
        low, high = s[max(ties[0] - 1, 0)], s[min(ties[-1], len(s) - 1)]
        return float((low + high) / 2)

    languages = np.array(languages)
    common, out = best(scores, ones, zeros), {}
    for k in LANGUAGES:
        own = languages == k
        enough = min(ones[own].sum(), zeros[own].sum()) >= least
        out[k] = best(scores[own], ones[own], zeros[own]) if enough else common
    return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learns from all labelled rows where `learn` (over the columns of labels) holds: on the driver up to `sample` rows of either
    kind, beyond that in shards, from a start on as many rows of the smallest hash of the id."""
    known = labels.where(learn & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    count = dict(known.groupBy("label").count().collect())  # two numbers
    whole = max(count.values(), default=0) <= sample
    held = F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(HELD)) == 0
    some = known if whole else known.where(~held)
    first = lambda k: some.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = _once(texts.join(F.broadcast(first(0).unionByName(first(1))), "id"))  # 2 * sample rows at most
    got = sorted((r["id"], r["label"], r["text"] or "") for r in rows.collect())
    had, y = [r[2] for r in got], np.array([r[1] for r in got], np.float32)
    if whole:
        return train(had, y)
    start, squares = _untrained(7)
    if len(set(y.tolist())) == 2:
        _learn(start, squares, had, y, np.random.default_rng(8), EPOCHS)
    return _fit_all(texts, known, held, -(-sum(count.values()) // SHARD), start, squares)


def _once(rows: DataFrame) -> DataFrame:
    """An id in many rows is learned from once."""
    return rows.groupBy("id", "label").agg(F.min("text").alias("text"))


def _labelled(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The texts that have a label. Spark makes a Bloom filter only of a side that a comparison has filtered: labels are 0 or 1, so this one leaves all of them."""
    return _once(texts.join(known.where("label >= 0"), "id"))


def _fit_all(texts: DataFrame, known: DataFrame, held: Column, shards: int, start: Model, squares: dict) -> Model:
    """start, trained on by each shard of the rows that are not held, averaged, in rounds, with thresholds from all held rows."""
    spark = texts.sparkSession
    ship(spark)
    # written, so that Spark knows its size: it is broadcast to the texts if it is small; otherwise its Bloom filter keeps other texts where they are
    known = stage(known.where("id is not null"), "toxic-labels", 10_000)
    with settings(spark, JOIN_FILTERS):
        labelled = stage(_labelled(texts, known), "toxic-rows")
    shard = F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards))
    labelled_by = labelled.select("id", "label", "text", shard.alias("shard"), held.alias("held"))

    def dealt(which: str) -> DataFrame:
        """Rows in the order of shards, each shard's in one partition, a partition for each."""
        rows = labelled_by.where(which).repartitionById(shards, F.col("shard").cast("int"))
        return rows.sortWithinPartitions("shard", F.xxhash64("id"), "id", "label").select("shard", "label", "text")

    forget(spark)  # the shuffle files behind the labelled rows go before those of the rounds, and each round's before the next
    model, seen = start, np.zeros(2, np.int64)
    with text_batches(spark):
        for turn in range(ROUNDS):
            shared = spark.sparkContext.broadcast((model, squares))  # its size is fixed
            changes = dealt("not held").mapInArrow(lambda it: _changes(it, *shared.value, turn), "block int, shard long, rows binary, change binary")  # noqa: B023
            changes = changes.repartition(-(-BUCKETS // BLOCK), "block").sortWithinPartitions("block", "shard").mapInArrow(_averaged, "block int, change binary, zeros long, ones long")
            model, seen = moved(model, changes.collect())  # as many numbers as the model has
            shared.unpersist()
            del changes
            forget(spark)
        if not seen.all():
            return _constant(model)
        scored = spark.sparkContext.broadcast(model)
        found = dealt("held").mapInArrow(lambda it: _logits(it, scored.value), "language string, step int, label int")
        found = found.groupBy("language", "step").agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros")).collect()  # 2 * MOST * STEPS rows a language at most
        scored.unpersist()
    unstage(known, labelled)
    found.sort(key=lambda r: (r["step"], r["language"]))
    column = lambda name: np.array([r[name] for r in found], np.int64)
    both = found and column("ones").any() and column("zeros").any()
    model.threshold = calibrate(column("step") / STEPS, column("ones"), column("zeros"), [r["language"] for r in found]) if both else dict.fromkeys(LANGUAGES, 0.0)
    return model


def moved(start: Model, changes: Iterable) -> tuple[Model, np.ndarray]:
    """start with the mean changes (block, change, zeros, ones) added; how many rows of either kind they come from."""
    model, seen = deepcopy(start), np.zeros(2, np.int64)
    for r in changes:
        change = np.frombuffer(r["change"], np.float32)
        if r["block"] < 0:
            _add(model, change)
            seen += [r["zeros"], r["ones"]]
        else:
            at = r["block"] * BLOCK
            model.embed[at : at + BLOCK] += change.reshape(-1, WIDTH)
    return model, seen


def _dense(model: Model) -> np.ndarray:
    """All of a model but the embeddings, in a row."""
    return np.concatenate([*(model.filters[w].ravel() for w in SPANS), *(model.bias[w] for w in SPANS), model.out, [model.out_bias]]).astype(np.float32)


def _add(model: Model, change: np.ndarray) -> None:
    at = 0
    for part in (*(model.filters[w] for w in SPANS), *(model.bias[w] for w in SPANS), model.out):
        part += change[at : at + part.size].reshape(part.shape)
        at += part.size
    model.out_bias += float(change[at])


@tidy
def _changes(batches: Iterable[pa.RecordBatch], start: Model, squares: dict, turn: int) -> Iterator[pa.RecordBatch]:
    """What the rows of each shard change in start: the rows of embeddings that have changed, block by block; the rest as block -1, with the number of
    rows of either kind. Batches are in the order of shards."""
    now, rows = None, None
    for b in batches:
        shard = b["shard"].to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if s == e:
                continue
            if shard[s] != now:
                if rows is not None:
                    yield rows.changes()
                now, rows = int(shard[s]), _Shard(int(shard[s]), start, squares, turn)
            rows.add(b["text"][s:e].to_pylist(), b["label"][s:e].to_pylist())
    if rows is not None:
        yield rows.changes()


class _Shard:
    """A shard's own model, CHUNK rows at a time, wherever batches end."""

    def __init__(self, shard: int, start: Model, squares: dict, turn: int):
        self.shard, self.start, self.model, self.squares = shard, start, deepcopy(start), deepcopy(squares)
        self.rng, self.seen = np.random.default_rng([9, turn, shard]), np.zeros(2, np.int64)
        self.texts: list[str | None] = []
        self.labels: list[int] = []

    def add(self, texts: list[str | None], labels: list[int]) -> None:
        self.texts += texts
        self.labels += labels
        while len(self.texts) >= CHUNK:
            self._learn(CHUNK)

    def _learn(self, n: int) -> None:
        y = np.array(self.labels[:n], np.float32)
        _learn(self.model, self.squares, self.texts[:n], y, self.rng, 1)
        self.seen += np.bincount(y.astype(np.int64), minlength=2)
        self.texts, self.labels = self.texts[n:], self.labels[n:]

    def changes(self) -> pa.RecordBatch:
        if self.texts:
            self._learn(len(self.texts))
        changed = np.flatnonzero((self.model.embed != self.start.embed).any(axis=1)).astype(np.int32)
        blocks, rows, change = [-1], [self.seen.tobytes()], [(_dense(self.model) - _dense(self.start)).tobytes()]
        for k in np.unique(changed // BLOCK).tolist():
            own = changed[changed // BLOCK == k]
            blocks.append(k)
            rows.append((own % BLOCK).tobytes())
            change.append((self.model.embed[own] - self.start.embed[own]).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([self.shard] * len(blocks), pa.int64()), pa.array(rows, pa.binary()), pa.array(change, pa.binary())], ["block", "shard", "rows", "change"])


@tidy
def _averaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of changes sorted by block, the mean in each block."""

    def mean(block: int, total: np.ndarray, n: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
        out = (total / np.maximum(n, 1)).astype(np.float32).tobytes()
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "change": pa.array([out], pa.binary()), "zeros": pa.array([seen[0]], pa.int64()), "ones": pa.array([seen[1]], pa.int64())})

    block = None
    for b in batches:
        for k, rows, change in zip(*(b[c].to_pylist() for c in ("block", "rows", "change")), strict=True):
            change = np.frombuffer(change, np.float32)
            if k != block:
                if block is not None:
                    yield mean(block, total, n, seen)
                block, seen = k, np.zeros(2, np.int64)
                total, n = (np.zeros(len(change)), np.zeros(1)) if k < 0 else (np.zeros((BLOCK, WIDTH)), np.zeros((BLOCK, 1)))
            if k < 0:
                seen += np.frombuffer(rows, np.int64)
                total += change
                n += 1
            else:
                own = np.frombuffer(rows, np.int32)
                total[own] += change.reshape(-1, WIDTH)
                n[own] += 1
    if block is not None:
        yield mean(block, total, n, seen)


@tidy
def _logits(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    for b in batches:
        words = [split_words(t) for t in b["text"].to_pylist()]
        steps = np.round(np.clip([scorer.logit(w) for w in words], -MOST, MOST) * STEPS).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([language(w) for w in words], pa.string()), pa.array(steps, pa.int32()), b["label"].cast(pa.int32())], ["language", "step", "label"])


@tidy
def _score(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    for b in pieces(batches):
        yield pa.RecordBatch.from_arrays([b["id"], pa.array(map(scorer.score, b["text"].to_pylist()), pa.float64())], ["id", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, score (0 to 1), predicted (1 if the score is 0.5 or more)."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed
    read = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return read.mapInArrow(lambda it: _score(it, shared.value), f"id {kind}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@tidy
def _clean(batches: Iterable[pa.RecordBatch], model: Model, text_col: str) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    for b in pieces(batches):
        yield b.filter(pa.array([scorer.score(t) < 0.5 for t in b[text_col].to_pylist()], pa.bool_()))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs without the rows whose score is 0.5 or more; columns as they were."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(lambda it: _clean(it, shared.value, text_col), docs.schema)
