"""Best-fit packing by the sum of squares.

N(g) is the number of open bins with g tokens left. A piece goes where the sum of
N(g)^2 over 0 < g < capacity becomes smallest: into an open bin (gap g to g - size) or
a new one. Bins are then spread over gaps such that later pieces find exact fits.

Pieces are dealt at random to tasks of many thousand pieces, each packed on its own in
order of falling size; the bins a task leaves with more than a few tokens free are
taken apart again and packed together in a further round, in far fewer tasks, so what
a task loses at its end is lost once and not once a task.

Defined cases: null text counts as empty (one piece: the end id alone); repeated rows
and repeated doc_ids are all packed; a null doc_id is a document like any other; a text
of any length is cut into as many pieces as it needs; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import batches, parts_for, text_or_empty, written
from quernstone.llm.tokens import WordTokens

PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(stream: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    words = WordTokens.load(path)
    for batch in stream:

        def rows(batch: pa.RecordBatch = batch) -> Iterator[tuple]:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.encode(batch["text"].to_pylist()), strict=True):
                ids = np.append(ids, words.dtype.type(end_id))
                for k, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start : start + capacity]
                    yield doc_id, k, start, len(cut), zlib.crc32(cut.astype("<u4").tobytes())

        yield from batches(rows(), PIECES)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of `capacity`: their lengths and checksums."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lambda it: _pieces(it, tokenizer_path, capacity, end_id), PIECES_DDL)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin (numbered from 0) and offset of each piece, packed in the order given."""
    count = np.zeros(capacity + 1, np.int64)  # open bins per gap
    bins: dict[int, list[int]] = defaultdict(list)  # gap -> bins
    used: list[int] = []
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, size in enumerate(lengths.tolist()):
        # change of the sum: -2N(g)+1 for the gap that goes, 2N(g-size)+1 for the one that comes, nothing for full and for new bins
        gaps = np.flatnonzero(count[size:capacity]) + size
        best, chosen = (2 * count[capacity - size] + 1 if size < capacity else 0), capacity
        if len(gaps):
            change = 1 - 2 * count[gaps]
            rest = gaps - size
            change += np.where(rest > 0, 2 * count[rest] + 1, 0)
            k = int(np.argmin(change))  # the tightest of equals
            if change[k] <= best:
                chosen = int(gaps[k])
        if chosen == capacity:
            b = len(used)
            used.append(0)
        else:
            b = bins[chosen].pop()
            count[chosen] -= 1
        at[i], offset[i] = b, used[b]
        used[b] += size
        if left := capacity - used[b]:
            bins[left].append(b)
            count[left] += 1
    return at, offset


PACKED_DDL = "row long, bin long, offset long, slack long"


def _pack(frames: Iterator[pd.DataFrame], capacity: int, tag: int) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    held = list(frames)
    if not held or not sum(map(len, held)):
        return
    rows = pd.concat(held, ignore_index=True).sort_values(["length", "row"], ascending=[False, True], kind="stable", ignore_index=True)
    lengths = rows["length"].to_numpy()
    at, offset = sum_of_squares(lengths, capacity)
    slack = capacity - np.bincount(at, lengths, minlength=int(at.max()) + 1).astype(np.int64)
    base = (tag << 58) + (TaskContext.get().partitionId() << 34)
    yield pd.DataFrame({"row": rows["row"], "bin": base + at, "offset": offset, "slack": slack[at]})


def pack(pieces: DataFrame, capacity: int = 2048, each: int = 200_000, slack: int = 8, rounds: int = 3) -> DataFrame:
    """`pieces` (with the column length, and a unique `row`) with sequence_id and offset.

    Only row and length are shuffled. A task of the first rounds gets about `each` pieces;
    the bins with over `slack` tokens left are packed anew while they are many.
    """
    todo, done = pieces.select("row", F.col("length").cast("long").alias("length")), []
    for k in range(rounds):
        n = todo.count()
        parts = parts_for(n, each)
        packed = todo.repartition(parts, F.xxhash64("row")).mapInPandas(lambda it, k=k: _pack(it, capacity, k), PACKED_DDL)
        packed = written(packed, f"packed-{k}")
        if parts == 1 or k == rounds - 1:
            done.append(packed)
            break
        done.append(packed.where(F.col("slack") <= slack))
        todo = todo.join(packed.where(F.col("slack") > slack), "row", "left_semi")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return pieces.join(out.select("row", F.col("bin").alias("sequence_id"), F.col("offset")), "row").drop("row")


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, each: int = 200_000) -> DataFrame:
    """The pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id).withColumn("row", F.monotonically_increasing_id())
    return pack(written(pieces, "pieces"), capacity, each)
