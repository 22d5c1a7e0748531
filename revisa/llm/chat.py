"""Chat formatting by columnar byte assembly.

A conversation becomes one string of turns,

    <|turn|>role<|text|>content<|end|>

Inside roles and contents every ``<``, backslashes, ``|`` gets one backslash more before
the bar, so no control string can stand in them, and taking one away restores them.  The
bytes of a whole batch of conversations are put together at once: lengths of all segments
(headers, roles, contents, added backslashes), running offsets, and for every source byte
its place in one preallocated buffer that becomes the Arrow string column.  Byte ranges
of the assistant contents are the loss mask.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import PIECE_BYTES, flat, pieces

#: Control strings (fixed values) and the role whose texts are learnt.
TURN, TEXT, END = b"<|turn|>", b"<|text|>", b"<|end|>"
LEARNT = b"assistant"
_ESCAPED = re.compile(rb"<(\\*)\\\|")
_TURNS = re.compile(rb"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.S)


def bars_to_escape(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions of bars that follow a ``<`` and any backslashes within the same text."""
    bars = np.flatnonzero(data == 124)
    if not len(bars):
        return bars
    plain = np.maximum.accumulate(np.where(data != 92, np.arange(len(data)), -1))
    before = np.where(bars > 0, plain[np.maximum(bars - 1, 0)], -1)
    own = off[np.searchsorted(off, bars, side="right") - 1]
    return bars[(before >= own) & (data[np.maximum(before, 0)] == 60)]


def place(out: np.ndarray, data: np.ndarray, off: np.ndarray, to: np.ndarray, bars: np.ndarray) -> None:
    """Scatter texts to their places in the buffer, with a backslash before each bar of ``bars``."""
    length = np.diff(off)
    at = np.arange(len(data)) + np.repeat(to - off[:-1], length)
    if len(bars):
        added = np.zeros(len(data) + 1, np.int64)
        added[bars] = 1
        run = np.cumsum(added)[:-1]
        before = run[off[:-1].clip(max=len(data) - 1)] - added[off[:-1].clip(max=len(data) - 1)]
        at += run - np.repeat(before, length)
        out[at[bars] - 1] = 92
    out[at] = data


def assemble(role: pa.Array, text: pa.Array, first: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Formatted strings, loss starts and loss ends of conversations beginning at rows ``first`` (one more than conversations)."""
    parts = [flat(role), flat(text)]
    bars = [bars_to_escape(d, o) for d, o in parts]
    length = [np.diff(o) + np.bincount(np.searchsorted(o, b, side="right") - 1, minlength=len(o) - 1) for (_, o), b in zip(parts, bars)]
    n = len(length[0])
    turn = len(TURN) + len(TEXT) + len(END) + length[0] + length[1]
    end = np.cumsum(turn)
    start = end - turn
    out = np.empty(int(end[-1]) if n else 0, np.uint8)
    role_at = start + len(TURN)
    text_at = role_at + length[0] + len(TEXT)
    for mark, at in ((TURN, start), (TEXT, role_at + length[0]), (END, text_at + length[1])):
        out[at[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    place(out, *parts[0], role_at, bars[0])
    place(out, *parts[1], text_at, bars[1])

    whole = np.concatenate([start, [len(out)]])[first]
    formatted = pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(whole.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    learnt = np.array([r == LEARNT.decode() for r in role.to_pylist()], bool)
    masked = np.concatenate([[0], np.cumsum(learnt)])[first].astype(np.int32)
    base = np.repeat(whole[:-1], np.diff(first))
    loss = [pa.ListArray.from_arrays(pa.array(masked), pa.array((x - base)[learnt].astype(np.int64))) for x in (text_at, text_at + length[1])]
    return formatted, *loss


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_start[] and loss_end[] (byte offsets of assistant contents).

    Rows are ordered by turn, then role, then text (nulls first); repeated rows all count.
    A null role or text is empty.  Rows with a null conv_id are one conversation.  A
    conversation is one string, so its rows meet in one task and in memory; ``format_parts``
    has no such bound.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def finish(table: pa.Table, first: np.ndarray):
        role, text = (table.column(c).combine_chunks() for c in ("role", "text"))
        formatted, starts, ends = assemble(role, text, first)
        ids = table.column("conv_id").take(pa.array(first[:-1])).combine_chunks()
        return pa.RecordBatch.from_arrays([ids, formatted, starts, ends], names=["conv_id", "formatted", "loss_start", "loss_end"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, limit = 0, PIECE_BYTES
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                held.append(batch.slice(at, 1000))
                size += held[-1].nbytes
                if size < limit:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                first = boundaries(table)
                if len(first) > 2:  # the last conversation may go on
                    yield finish(table.slice(0, first[-2]), first[:-1])
                    table = table.slice(first[-2])
                held = table.to_batches()
                size = sum(b.nbytes for b in held)
                limit = max(PIECE_BYTES, 2 * size)  # a long conversation is not put together again for every slice
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield finish(table, boundaries(table))

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, formatted string, loss_start array<long>, loss_end array<long>")


def format_parts(conversations: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Conversations of any length: conv_id, part, formatted, loss_start[] and loss_end[] within the part.

    The parts of a conversation in the order of ``part`` (not consecutive) are its formatted
    string; each holds whole turns, of about ``piece_bytes`` or one turn.  Rows are dealt by
    ranges of (conv_id, turn, role, text), so a long conversation is spread over tasks.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    by = ["conv_id", "turn", "role", "text"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)

    def run(batches):
        part = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text", piece_bytes):
            first = boundaries(pa.Table.from_batches([batch]))
            formatted, starts, ends = assemble(batch.column(2), batch.column(3), first)
            ids = batch.column(0).take(pa.array(first[:-1]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.arange(part, part + len(ids))), formatted, starts, ends], names=["conv_id", "part", "formatted", "loss_start", "loss_end"])
            part += len(ids)

    kind = conversations.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, part long, formatted string, loss_start array<long>, loss_end array<long>")


class Digest:
    """Running counts and hashes of a conversation's parts."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, data: str, starts: list[int], ends: list[int]) -> None:
        whole = data.encode()
        for role, text in read_turns(whole):
            self.turns += 1
            self.said.update(role + b"\n" + text + b"\n")
        for a, b in zip(starts, ends):
            text = unescape(whole[a:b])
            self.loss_chars += len(text.decode())
            self.loss.update(text)
        self.chars += len(data)

    def row(self) -> tuple:
        return self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def boundaries(table: pa.Table) -> np.ndarray:
    """First row of each run of equal conv_id, and the number of rows."""
    ids = table.column("conv_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]]) if len(ids) else np.zeros(1, np.int64)


def unescape(data: bytes) -> bytes:
    return _ESCAPED.sub(rb"<\1|", data)


def read_turns(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURNS.findall(formatted)]
