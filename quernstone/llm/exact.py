"""Exact deduplication by Grace hashing.

Texts are equal when identical after lower-casing A-Z. Each task first collapses the
equal texts of its own partition, so a text that a third of all rows share reaches the
shuffle once a task; the remaining texts are hashed to partitions and collapsed there.
Both steps use the same table: open addressing over complete contents within a memory
budget; contents beyond it go to spill files by the next bits of their hash, and each
file is treated in the same way.

Defined cases: null text counts as empty, and empty texts equal one another; a null
doc_id is smaller than any other (keep_id is null only where all are); of rows with
equal text and doc_id the first in scan order stays; a text of any length is compared
whole; an empty table gives an empty result; other columns are ignored, or kept by
`drop_exact_copies`, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import batches, fresh_name, row_bytes, text_or_empty

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
FANOUT_BITS = 4


def _pickled(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


class GraceTable:
    """Groups records (content, payload) by complete content.

    `fold(state, payload)` returns a group's new state (None at first); `groups` yields
    (content, state) of each group once. At most about `budget` bytes of distinct content
    are held; what does not fit is dealt to spill files by four bits of the hash a level,
    while copies of the contents that are held are still folded in.
    """

    def __init__(self, fold: Callable, budget: int, level: int = 0):
        self.fold, self.budget, self.level = fold, budget, level
        self.mask = 1023
        self.slots = array("q", [-1]) * 1024
        self.hashes = array("Q")
        self.contents: list[bytes] = []
        self.states: list = []
        self.used = 0
        self.spills: dict[int, object] = {}

    def _grow(self) -> None:
        self.mask = self.mask * 2 + 1
        self.slots = array("q", [-1]) * (self.mask + 1)
        for k, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = k

    def add(self, content: bytes, payload, h: int | None = None):
        """The state of the record's group, or None where the record was spilled."""
        if h is None:
            h = xxhash.xxh3_64_intdigest(content)
        at = h & self.mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                self.states[k] = self.fold(self.states[k], payload)
                return self.states[k]
            at = (at + 1) & self.mask
        if self.contents and self.used + len(content) + 200 > self.budget:
            bucket = (h >> (60 - FANOUT_BITS * self.level % 64)) & 15
            if bucket not in self.spills:
                self.spills[bucket] = tempfile.TemporaryFile()
            pickle.dump((content, payload, h), self.spills[bucket], pickle.HIGHEST_PROTOCOL)
            return None
        self.slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.states.append(self.fold(None, payload))
        self.used += len(content) + 200
        if 2 * len(self.contents) > self.mask:
            self._grow()
        return self.states[-1]

    def _spilled(self) -> Iterator[tuple[GraceTable, Iterator[tuple]]]:
        """A table for each spill file, and its records."""
        self.contents, self.states, self.hashes, self.slots = [], [], array("Q"), array("q")
        for bucket in sorted(self.spills):
            with self.spills.pop(bucket) as file:
                file.seek(0)
                yield GraceTable(self.fold, self.budget, self.level + 1), _pickled(file)

    def groups(self) -> Iterator[tuple[bytes, object]]:
        yield from zip(self.contents, self.states, strict=True)
        for inner, records in self._spilled():
            for record in records:
                inner.add(*record)
            yield from inner.groups()

    def states_of(self, records: Iterable[tuple]) -> Iterator[tuple]:
        """Each record's payload with the state of its group just behind it, as it goes; what was spilled comes later."""
        for content, payload, *h in records:
            state = self.add(content, payload, *h)
            if state is not None:
                yield payload, state
        for inner, spilled in self._spilled():
            yield from inner.states_of(spilled)


LEAST = -(1 << 63)
LOCAL_DDL = "group_row long, content_hash long, content binary, best_id long, best_row long, n long"
LOCAL = pa.schema([("group_row", pa.int64()), ("content_hash", pa.int64()), ("content", pa.binary()), ("best_id", pa.int64()), ("best_row", pa.int64()), ("n", pa.int64())])
MEMBER_DDL = "row long, doc_id long, group_row long"
MEMBER = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("group_row", pa.int64())])
GLOBAL_DDL = "group_row long, keep_id long, keep_row long, group_size long, text_sha256 string"
GLOBAL = pa.schema([("group_row", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string())])


def _order(doc_id: int | None, row: int) -> tuple[int, int]:
    """The largest doc_id first, null below any, then the earliest row."""
    return (LEAST if doc_id is None else doc_id, -row)


def _records(stream: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, int, int | None]]:
    for batch in stream:
        for text, row, doc_id in zip(row_bytes(batch["text"]), batch["row"].to_pylist(), batch["doc_id"].to_pylist(), strict=True):
            yield text.translate(LOWER), row, doc_id


def _local_groups(stream: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """A row for each distinct text of the partition; group_row is its first row in scan order."""

    def fold(state, payload):
        row, doc_id = payload
        if state is None:
            return [row, doc_id, row, 1]
        if _order(doc_id, row) > _order(state[1], state[2]):
            state[1], state[2] = doc_id, row
        state[3] += 1
        return state

    table = GraceTable(fold, budget)
    for content, row, doc_id in _records(stream):
        table.add(content, (row, doc_id))
    rows = ((s[0], xxhash.xxh3_64_intdigest(c) - (1 << 63), c, s[1], s[2], s[3]) for c, s in table.groups())
    yield from batches(rows, LOCAL, weight=2)


def _local_members(stream: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Each row with the group_row of its text. The first row of a text is its group in either pass, whatever was spilled."""

    def fold(state, payload):
        return payload[0] if state is None else state

    records = ((content, (row, doc_id)) for content, row, doc_id in _records(stream))
    rows = ((row, doc_id, first) for (row, doc_id), first in GraceTable(fold, budget).states_of(records))
    yield from batches(rows, MEMBER, 8192)


def _global_groups(stream: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    def fold(state, payload):
        group_row, best_id, best_row, n = payload
        if state is None:
            return [array("q", [group_row]), best_id, best_row, n]
        state[0].append(group_row)
        if _order(best_id, best_row) > _order(state[1], state[2]):
            state[1], state[2] = best_id, best_row
        state[3] += n
        return state

    table = GraceTable(fold, budget)
    for batch in stream:
        for content, *payload in zip(*(batch[c].to_pylist() for c in ("content", "group_row", "best_id", "best_row", "n")), strict=True):
            table.add(content, payload)

    def rows() -> Iterator[tuple]:
        for content, (members, best_id, best_row, n) in table.groups():
            digest = hashlib.sha256(content).hexdigest()
            for group_row in members:
                yield group_row, best_id, best_row, n, digest

    yield from batches(rows(), GLOBAL)


def with_row(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column, under a name of its own, which tells rows apart even where doc_id does not.

    It rests on the partitions of `docs` being the same whenever it is computed, as with files and checkpoints.
    """
    name = fresh_name(docs, "row")
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def exact_groups(docs: DataFrame, row_col: str | None = None, budget_bytes: int = 128 << 20) -> DataFrame:
    """One row per row of `docs`: row, doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Two passes over the texts and one shuffle of the texts that are distinct within their
    partition; ids are joined by group, where a group has a partition's rows at most.
    """
    if row_col is None:
        docs, row_col = with_row(docs)
    rows = docs.select(F.col(row_col).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    members = rows.mapInArrow(lambda it: _local_members(it, budget_bytes), MEMBER_DDL)
    groups = rows.mapInArrow(lambda it: _local_groups(it, budget_bytes), LOCAL_DDL)
    found = groups.repartition("content_hash").mapInArrow(lambda it: _global_groups(it, budget_bytes), GLOBAL_DDL)
    joined = members.join(found, "group_row", "left")
    # A row without its group would mean that the two passes saw different partitions.
    size = F.coalesce("group_size", F.raise_error(F.lit("partitions changed between two passes; write the input as a table first")).cast("long"))
    return joined.select("row", "doc_id", "keep_id", size.alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, budget_bytes: int = 128 << 20) -> DataFrame:
    """`docs` with one row of each group of equal texts: the one with the largest doc_id. All columns stay as they are."""
    numbered, row = with_row(docs)
    kept = exact_groups(numbered, row, budget_bytes).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").drop(row)
