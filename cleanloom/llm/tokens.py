"""Token counts and ids: batch encoding in Arrow functions.

The vocabulary drops white space, and none of its patterns crosses it, so an ASCII white-space character is a safe
boundary: the ids of a text are those of its white-space-separated words, one after the other. Texts (of any length) are
cut there; each batch of about the same number of bytes sends only the words that the worker has not seen to the
library's batch encoder, and sums what the words have. The table of words is bounded, by entries and by bytes, and starts anew when it is full.
A text without ASCII white space has no safe boundary and is one word, however long; words of more than LONG bytes are encoded for their batch
only and not remembered, so texts of other scripts, whose words are whole sentences or texts, leave nothing behind.

Plain words (Latin letters, then perhaps punctuation) are a stem in lower case and a tail, which the vocabulary tells apart too.
Stems are encoded in lines of many, for an encoding has a price of its own; a line's ids fall to its stems by the ids that end
a word. Tails, and words of any other kind, are encoded one by one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import tidy

#: words that a worker remembers, bytes of them and of what they have (with what an entry takes), bytes of the longest
WORDS, KNOWN_BYTES, ENTRY, LONG = 1_000_000, 192 << 20, 130, 64
#: UTF-8 bytes of text in a batch, UTF-8 bytes of words sent to the encoder at once, words in a line
BATCH_BYTES, ENCODE_BYTES, LINE = 4 << 20, 256 << 10, 1000
#: letters that neither normalisation nor a neighbour changes, then punctuation that begins no pattern of its own
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


class Known(dict):
    """Words to what they have. Long words are only kept until the next batch."""

    def __init__(self):
        self.long: dict[bytes, int | bytes] = {}
        self.bytes = 0

    def __missing__(self, word: bytes) -> int | bytes:
        return self.long[word]

    def start(self) -> None:
        """Before a batch: long words go, and all words if there are too many."""
        self.long.clear()
        if len(self) > WORDS or self.bytes > KNOWN_BYTES:
            self.forget()

    def forget(self) -> None:
        self.clear()
        self.long.clear()
        self.bytes = 0

    def put(self, word: bytes, value: int | bytes) -> None:
        if len(word) > LONG:
            self.long[word] = value
        else:
            self[word] = value
            self.bytes += ENTRY + len(word) + (len(value) if isinstance(value, bytes) else 0)


class WordEncoder:
    """Words (bytes without ASCII white space) to counts, or to their ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, ids: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.ids, self.known = Tokenizer.from_file(path), ids, Known()
        vocabulary, mark = self.tokenizer.get_vocab(), getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if mark:
            self.ends[[i for w, i in vocabulary.items() if w.endswith(mark)]] = True

    def learn(self, words: set[bytes]) -> None:
        known, put = self.known, self.known.put
        known.start()
        for part in by_bytes([w for w in words if w not in known], ENCODE_BYTES):
            text = b"\n".join(part).decode().split("\n")
            plain = [PLAIN.fullmatch(t) for t in text] if self.ends.any() else [None] * len(text)
            split = [(m[1].lower().encode(), m[2].encode()) if m else None for m in plain]
            stems = [x for x in {s[0] for s in split if s} if x not in known]
            lines = [stems[k : k + LINE] for k in range(0, len(stems), LINE)]
            other = [w for w, s in zip(part, split, strict=True) if not s] + [x for x in {s[1] for s in split if s} if x and x not in known]
            encoded = self.tokenizer.encode_batch_fast([b" ".join(x).decode() for x in lines] + [x.decode() for x in other], add_special_tokens=False)
            for line, e in zip(lines, encoded, strict=False):
                for w, v in zip(line, self.apart(e.ids, len(line)), strict=True):
                    put(w, v)
            for w, e in zip(other, encoded[len(lines) :], strict=True):
                put(w, self.value(e.ids))
            for w, s in zip(part, split, strict=True):
                if s:
                    put(w, known[s[0]] + known[s[1]] if s[1] else known[s[0]])

    def value(self, ids: list[int]) -> int | bytes:
        return np.array(ids, "<u4").tobytes() if self.ids else len(ids)

    def apart(self, ids: list[int], words: int) -> list[int | bytes]:
        """The ids of a line of stems, word by word: each has one id that ends a word, its last."""
        got = np.array(ids, "<u4")
        stops = np.flatnonzero(self.ends[got]) + 1
        if len(stops) != words or stops[-1] != len(got):
            raise ValueError("a line of plain words has other ends of words than its words have")
        if not self.ids:
            return np.diff(stops, prepend=0).tolist()
        raw, at = got.tobytes(), [0, *(4 * stops).tolist()]
        return [raw[s:e] for s, e in zip(at, at[1:], strict=False)]


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def encoder(path: str, ids: bool = False) -> WordEncoder:
    if (path, ids) not in _ENCODERS:
        _ENCODERS[path, ids] = WordEncoder(path, ids)
    return _ENCODERS[path, ids]


def remembering(function: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """function over a task's batches; the words it has learned go when the task ends. Workers take tasks in turn, more of them than there are cores, and
    each would keep a table of its own; the next task learns the common words again in no time."""

    @tidy
    @wraps(function)
    def run(*args, **options) -> Iterator[pa.RecordBatch]:
        yield from function(*args, **options)
        for enc in _ENCODERS.values():
            enc.known.forget()

    return run


def by_bytes(items: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """items in runs of about `most` bytes, one item at least."""
    part, n = [], 0
    for x in items:
        part.append(x)
        n += len(x)
        if n >= most:
            yield part
            part, n = [], 0
    if part:
        yield part


def encoded(texts: Iterable[str | None], path: str, ids: bool) -> Iterator[int | bytes]:
    """For each text its number of ids, or the ids' bytes."""
    enc = encoder(path, ids)
    for part in by_bytes(((t or "").encode() for t in texts), BATCH_BYTES):
        words = [t.split() for t in part]
        enc.learn(set().union(*words))
        look = enc.known.__getitem__
        for w in words:
            yield b"".join(map(look, w)) if ids else sum(map(look, w))


@remembering
def _count(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = pc.fill_null(b["text"], "")
        yield pa.RecordBatch.from_arrays([b["id"], pc.cast(pc.binary_length(text), pa.int64()), pa.array(encoded(text.to_pylist(), path, False), pa.int64())], ["id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit. Null text counts as empty; other columns are not read."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return read.mapInArrow(lambda it: _count(it, path), f"id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
