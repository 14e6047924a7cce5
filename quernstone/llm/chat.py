"""Chat formatting by columnar byte assembly.

Conversations become one string each: every turn is `open role says text close`.
The control strings cannot occur inside roles or texts, because each occurrence of
one (or of another reserved string) gets one more backslash after its first
character, whatever number stands there already; removing one restores the text.

Defined cases: a null role or text counts as empty; a null conv_id is a conversation
of its own; rows of equal turn are ordered by role, then text, and repeated rows are
all kept; an empty table gives an empty result; other columns are ignored, whatever
their names; a text of any length stays whole, up to what an Arrow string can hold. A
conversation beyond `part_bytes` is written as several consecutive parts, so no
conversation has to fit into memory.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import buffers, spans, text_or_empty


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings begin with `<` or `[` and have neither anywhere else, so that none can arise where two segments meet."""

    open: str = "<|turn|>"
    says: str = "<|says|>"
    close: str = "<|end|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    learned_role: str = "assistant"

    def __post_init__(self) -> None:
        for c in self.controls:
            if not re.fullmatch(r"[<\[][^<\[\\]+", c):
                raise ValueError(f"not a usable control string: {c!r}")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.says, self.close, *self.reserved)

    @property
    def tails(self) -> str:
        return "|".join(sorted({"".join(f"\\{ch}" if not ch.isalnum() else ch for ch in c[1:]) for c in self.controls}))

    @property
    def escape_pattern(self) -> str:
        return rf"([<\[])(\\*)({self.tails})"

    def unescape(self, text: str) -> str:
        if "\\" not in text:
            return text
        return re.sub(rf"([<\[])\\(\\*)({self.tails})", r"\1\2\3", text)


#: Rows are assembled in blocks of about so many bytes, as escapes can double a text and offsets have 32 bits.
BLOCK_BYTES = 256 << 20
PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.list_(pa.int64())), ("loss_length", pa.list_(pa.int64()))])
PARTS_DDL = "conv_id long, part long, n_turns long, formatted string, loss_start array<long>, loss_length array<long>"


def _escaped(column: pa.Array, template: ChatTemplate) -> pa.Array:
    if pc.any(pc.match_substring_regex(column, template.escape_pattern)).as_py():
        return pc.replace_substring_regex(column, template.escape_pattern, r"\1\\\2\3")
    return column


def _scatter(out: np.ndarray, starts: np.ndarray, off: np.ndarray, data: np.ndarray, block: int = 1 << 20) -> None:
    """Copy each source segment to its start in `out`, through index arrays of bounded size."""
    lengths = np.diff(off)
    cuts = np.searchsorted(off, np.arange(off[0], off[-1] + block, block), "right") - 1
    cuts = np.unique(np.append(np.minimum(cuts, len(lengths)), len(lengths)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a == 1:
            out[starts[a] : starts[a] + lengths[a]] = data[off[a] : off[b]]
        else:
            index = np.repeat(starts[a:b] - off[a:b], lengths[a:b]) + np.arange(off[a], off[b])
            out[index] = data[off[a] : off[b]]


def assemble(conv: pa.Array, part: np.ndarray, role: pa.Array, text: pa.Array, template: ChatTemplate) -> pa.RecordBatch:
    """One formatted string for each run of rows with one conv_id; `part` has the part of every run."""
    n = len(conv)
    learned = np.asarray(pc.equal(role, template.learned_role).to_numpy(zero_copy_only=False), bool)
    role, text = _escaped(role, template), _escaped(text, template)
    role_off, role_data = buffers(role)
    text_off, text_data = buffers(text)
    consts = [np.frombuffer(c.encode(), np.uint8) for c in (template.open, template.says, template.close)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = (len(c) for c in consts)
    lengths[:, 1], lengths[:, 3] = np.diff(role_off), np.diff(text_off)
    ends = np.cumsum(lengths.ravel())
    starts = (ends - lengths.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]), np.uint8)
    for k, c in zip((0, 2, 4), consts, strict=True):
        out[starts[:, k, None] + np.arange(len(c))] = c
    _scatter(out, starts[:, 1], role_off, role_data)
    _scatter(out, starts[:, 3], text_off, text_data)

    valid = conv.is_valid().to_numpy(zero_copy_only=False)
    ids = conv.fill_null(0).to_numpy()
    first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (valid[1:] != valid[:-1])))
    after = np.append(first[1:], n)
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("one turn's formatted text has more bytes than an Arrow string can have")
    offsets = np.append(starts[first, 0], ends[-1]).astype(np.int32)

    points = np.empty((n, 5), np.int64)  # the same layout in code points
    points[:, 0], points[:, 2], points[:, 4] = (len(c) for c in (template.open, template.says, template.close))
    points[:, 1], points[:, 3] = pc.utf8_length(role).to_numpy(), pc.utf8_length(text).to_numpy()
    at = (np.cumsum(points.ravel()) - points.ravel()).reshape(n, 5)
    run = np.repeat(np.arange(len(first)), after - first)
    begin = at[:, 3] - at[first, 0][run]
    counts = np.append(0, np.cumsum(np.bincount(run[learned], minlength=len(first)))).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(counts), pa.array(v[learned])) for v in (begin, points[:, 3])]
    strings = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pa.RecordBatch.from_arrays([conv.take(pa.array(first)), pa.array(part), pa.array(after - first), strings, *lists], schema=PARTS)


def _format(stream: Iterator[pa.RecordBatch], template: ChatTemplate, part_bytes: int) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    last, parts = ("none",), 0  # of the conversation written last, and how many parts it has so far

    def write(table: pa.Table) -> pa.RecordBatch:
        nonlocal last, parts
        conv, role, text = (table[c].combine_chunks() for c in ("conv_id", "role", "text"))
        ids = [k for k, _ in itertools.groupby(conv.to_pylist())]
        number = np.zeros(len(ids), np.int64)
        if (ids[0],) == last:
            number[0] = parts
        last, parts = (ids[-1],), int(number[-1]) + 1
        return assemble(conv, number, role, text, template)

    def bounded(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """In blocks of bounded bytes; a conversation across two of them has several parts."""
        sizes = sum(pc.binary_length(table[c].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("role", "text"))
        for a, b in spans(sizes, BLOCK_BYTES):
            yield write(table.slice(a, b - a))

    for batch in stream:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ids = held["conv_id"].combine_chunks()
        end = ids[len(ids) - 1].as_py()
        same = pc.is_null(ids) if end is None else pc.fill_null(pc.equal(ids, end), False)
        complete = len(ids) - int(pc.sum(same).as_py() or 0)
        if held.slice(complete).nbytes > part_bytes:
            complete = len(ids)  # a conversation of several parts
        if complete:
            yield from bounded(held.slice(0, complete))
            held = held.slice(complete) if complete < len(ids) else None
    if held is not None and len(held):
        yield from bounded(held)


def format_conversations(conversations: DataFrame, template: ChatTemplate = ChatTemplate(), part_bytes: int = 16 << 20) -> DataFrame:
    """conv_id, part, n_turns, formatted, and the learned spans (loss_start, loss_length: code points of `formatted`).

    One shuffle by conv_id; within a partition the rows stream in order, so parts of a conversation stand one after the other.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(lambda it: _format(it, template, part_bytes), PARTS_DDL)


def turns_of(formatted: str, template: ChatTemplate) -> list[tuple[str, str]]:
    """The turns read back from formatted text."""
    out = []
    for piece in formatted.split(template.close)[:-1]:
        if not piece.startswith(template.open):
            raise ValueError("a turn does not begin with its control string")
        role, says, text = piece[len(template.open) :].partition(template.says)
        if not says:
            raise ValueError("a turn has no text marker")
        out.append((template.unescape(role), template.unescape(text)))
    return out


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(stream: Iterator[pa.RecordBatch], template: ChatTemplate) -> Iterator[pa.RecordBatch]:
    state: list | None = None

    def closed() -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    for batch in stream:
        rows = []
        for conv, part, formatted, starts, lengths in zip(*(batch[c].to_pylist() for c in ("conv_id", "part", "formatted", "loss_start", "loss_length")), strict=True):
            if part == 0:
                if state is not None:
                    rows.append(closed())
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in turns_of(formatted, template):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for a, n in zip(starts, lengths, strict=True):
                learned = template.unescape(formatted[a : a + n])
                state[3] += len(learned)
                state[4].update(learned.encode())
            state[5] += len(formatted)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), DIGEST, strict=True)], schema=DIGEST)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(closed(), DIGEST, strict=True)], schema=DIGEST)


def conversation_digests(parts: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Turns and learned text read back from the result of `format_conversations`, one row a conversation.

    No shuffle: the parts of a conversation are in one partition, in order.
    """
    return parts.mapInArrow(lambda it: _digest(it, template), DIGEST_DDL)
