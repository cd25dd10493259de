"""Chat formatting with a prefix tree.

Conversations that share their first turns share nodes of a tree. A node is one formatted turn; a sequence holds the nodes
depth-first, each shared turn once, with the position of every node (its ancestors' length) and the intervals of the
sequence that it may attend to: its ancestors' and its own. The loss mask covers the texts of assistant turns.

Conversations are range-sorted by their path, the list of their turns' hashes, then by id, so neighbours in a partition share
the longest prefixes, and each partition builds its trees in one pass over a stack as deep as one conversation. A first
turn that a third of all conversations share is cut over many partitions and sequences; it is put out once in each.

Template: TURN role TEXT text END for each turn. Control strings in roles and texts are escaped reversibly: backslashes are
doubled, and a backslash is put after a control string's first character.

Defined results: turns go by number (null first), ties by role and text; null roles and texts count as empty; rows whose id
is null are one conversation; repeated rows are turns of their own; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import partitions

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: our own marks, and those of common templates, which must not look like control strings either
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE, MAX_CHARS = "assistant", 1 << 16

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURNS = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)

SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
NODE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("parent", pa.int32()), ("loss", SPAN), ("attends", pa.list_(SPAN))])
LEAF = pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])
SCHEMA = pa.schema([("text", pa.string()), ("nodes", pa.list_(NODE)), ("leaves", pa.list_(LEAF))])
KIND = "text string, nodes array<struct<start:long,end:long,position:long,parent:int,loss:struct<start:long,end:long>,attends:array<struct<start:long,end:long>>>>, leaves array<struct<conv_id:long,node:int>>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class _Sequence:
    """A sequence that grows depth-first; the stack holds the nodes from the root to the last conversation's leaf."""

    def __init__(self):
        self.parts, self.length, self.nodes, self.leaves = [], 0, [], []
        self.stack: list[tuple[tuple[str, str], int]] = []

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.stack)) and self.stack[shared][0] == turns[shared]:
            shared += 1
        del self.stack[shared:]
        for role, text in turns[shared:]:
            parent = self.stack[-1][1] if self.stack else -1
            above = self.nodes[parent] if self.stack else None
            head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
            start, at = self.length, self.length + len(head)
            self.parts += head, body, END
            self.length = at + len(body) + len(END)
            span = {"start": start, "end": self.length}
            attends = [*above["attends"][:-1], *_joined(above["attends"][-1], span)] if above else [span]
            loss = {"start": at, "end": at + len(body)} if role == LOSS_ROLE else None
            self.nodes.append(span | {"position": above["position"] + above["end"] - above["start"] if above else 0, "parent": parent, "loss": loss, "attends": attends})
            self.stack.append(((role, text), len(self.nodes) - 1))
        self.leaves.append({"conv_id": conv_id, "node": self.stack[-1][1] if self.stack else -1})

    def row(self) -> dict:
        return {"text": "".join(self.parts), "nodes": self.nodes, "leaves": self.leaves}


def _joined(a: dict, b: dict) -> list[dict]:
    return [{"start": a["start"], "end": b["end"]}] if a["end"] == b["start"] else [a, b]


def _build(batches: Iterable[pa.RecordBatch], max_chars: int) -> Iterator[pa.RecordBatch]:
    seq, most = _Sequence(), 1 << 14
    for b in batches:
        for conv_id, turns in zip(b["conv_id"].to_pylist(), b["turns"].to_pylist(), strict=True):
            if seq.length >= max_chars or len(seq.leaves) >= most:
                yield pa.RecordBatch.from_pylist([seq.row()], SCHEMA)
                seq = _Sequence()
            seq.add(conv_id, [(t["role"], t["text"]) for t in turns])
    if seq.leaves:
        yield pa.RecordBatch.from_pylist([seq.row()], SCHEMA)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", max_chars: int = MAX_CHARS) -> DataFrame:
    """Sequences: text, nodes (start, end, position, parent, loss, attends; in code points) and leaves (conv_id, node).
    A sequence takes conversations until it has max_chars; none is cut."""
    ship(rows.sparkSession)
    empty = F.lit("")
    turn = F.struct(rows[turn_col].cast("long").alias("turn"), F.coalesce(rows[role_col], empty).alias("role"), F.coalesce(rows[text_col], empty).alias("text"))
    whole = rows.groupBy(rows[conv_col].cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    path = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    ordered = whole.withColumn("path", path).repartitionByRange(partitions(rows.sparkSession), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return ordered.select("conv_id", "turns").mapInArrow(lambda it: _build(it, max_chars), KIND)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    for b in batches:
        rows = []
        for text, nodes, leaves in zip(*(b[c].to_pylist() for c in ("text", "nodes", "leaves")), strict=True):
            for leaf in leaves:
                at, masked = leaf["node"], []
                seen = "".join(text[s["start"] : s["end"]] for s in nodes[at]["attends"]) if at >= 0 else ""
                while at >= 0:
                    if loss := nodes[at]["loss"]:
                        masked.append(unescape(text[loss["start"] : loss["end"]]))
                    at = nodes[at]["parent"]
                turns, learned = [(unescape(r), unescape(t)) for r, t in _TURNS.findall(seen)], "".join(reversed(masked))
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                rows.append((leaf["conv_id"], len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(seen)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], schema=kinds)


def digests(sequences: DataFrame) -> DataFrame:
    """What each conversation's node sees in the sequences, read back: one row per conversation."""
    ship(sequences.sparkSession)
    return sequences.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
