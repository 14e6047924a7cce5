"""Training-order shards of token ids.

The ids of the documents a task reads, each with an end id behind it, run on into
sequences of `stride` ids, so only a task's last sequence is not full; a document can
begin and end anywhere in them. Sequences are numbered 0..n-1 in the order of the written
token table. A keyed Feistel network over the smallest even number of bits that covers n,
walked on while it lands beyond n, is a permutation of these numbers, so every sequence
has a global slot that anyone with the key can compute. Slots are dealt in ranges to
shards: files of fixed-stride records (a 32-bit length, then little-endian unsigned ids,
padded), in slot order, so a reader finds slot s in shard s div per_shard at
(s mod per_shard) records and can resume anywhere. Beside each shard stands its index, an
Arrow file of the documents' parts in each record.

A shard and its index are written under temporary names and then renamed, so a task that
is repeated or lost leaves no half shard behind.

Defined cases: null text counts as empty (the end id alone); repeated rows and ids, and
rows of null doc_id, are all written, each as a document of its own; a text of any length
runs through as many sequences as it needs; an empty table gives no shards; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm.common import batches, drop, parts_for, row_bytes, scratch, text_or_empty, written
from quernstone.llm.tokens import WordTokens

ROUNDS = 6
HEADER = 4


def _round(value: np.ndarray, key: int, number: int) -> np.ndarray:
    x = value + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each of `numbers` (0..n-1); a permutation of 0..n-1 for every key."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]  # cycle walking
    return out.astype(np.int64)


#: `parts` packs what stands in a sequence, in order: for each part of a document doc_id, whether that is null, start in the document's ids, length.
PART = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("start", "<i8"), ("length", "<u4")])
SEQUENCE_DDL = "task int, place long, ids binary, parts binary"
SEQUENCE = pa.schema([("task", pa.int32()), ("place", pa.int64()), ("ids", pa.binary()), ("parts", pa.binary())])


def _sequences(stream: Iterator[pa.RecordBatch], path: str, stride: int, end_id: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """The task's documents one after the other, cut into sequences."""
    from pyspark import TaskContext

    words, task = WordTokens.load(path), TaskContext.get().partitionId()
    end = np.array([end_id], dtype)

    def rows() -> Iterator[tuple]:
        ids, parts, free, place = [], [], stride, 0
        for batch in stream:
            for doc_id, found in zip(batch["doc_id"].to_pylist(), words.encode(batch["text"].to_pylist()), strict=True):
                document = np.append(found.astype(dtype), end)
                start = 0
                while start < len(document):
                    cut = document[start : start + free]
                    ids.append(cut.tobytes())
                    parts.append((doc_id or 0, doc_id is None, start, len(cut)))
                    start += len(cut)
                    free -= len(cut)
                    if not free:
                        yield task, place, b"".join(ids), np.array(parts, PART).tobytes()
                        ids, parts, free, place = [], [], stride, place + 1
        if ids:
            yield task, place, b"".join(ids), np.array(parts, PART).tobytes()

    yield from batches(rows(), SEQUENCE, 1024)


def sequences(docs: DataFrame, tokenizer_path: str, stride: int = 1024, end_id: int = 0, dtype: str = "<u2") -> DataFrame:
    """task, place in the task, ids, parts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lambda it: _sequences(it, tokenizer_path, stride, end_id, dtype), SEQUENCE_DDL)


SLOTTED_DDL = "slot long, ids binary, parts binary"


def _slotted(stream: Iterator[pa.RecordBatch], begin: np.ndarray, n: int, key: int) -> Iterator[pa.RecordBatch]:
    """`begin` has the number of the first sequence of each task. Ids go packed, as Spark's own compression finds little in them."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in stream:
        slot = permuted(begin[batch["task"].to_numpy()] + batch["place"].to_numpy(), n, key)
        ids = pa.array([pack(i) for i in row_bytes(batch["ids"])], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(slot), ids, batch["parts"]], names=["slot", "ids", "parts"])


def slotted(table: DataFrame, key: int) -> tuple[DataFrame, int]:
    """slot, ids (packed), parts of the written sequences, and how many there are.

    Sequences are counted by task; the driver holds one number a task, and nothing is shuffled.
    """
    counts = dict(table.groupBy("task").agg((F.max("place") + 1).alias("n")).collect())
    sizes = np.zeros(max(counts, default=-1) + 2, np.int64)
    for task, n in counts.items():
        sizes[task + 1] = n
    begin, n = np.cumsum(sizes), int(sizes.sum())
    return table.mapInArrow(lambda it: _slotted(it, begin, n, key), SLOTTED_DDL), n


SHARD_DDL = "shard long, path string, first_slot long, n long"
SHARD = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("first_slot", pa.int64()), ("n", pa.int64())])
INDEX = pa.schema([("slot", pa.int64()), ("parts", pa.binary())])


def _opened(folder: str) -> tuple:
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _write(stream: Iterator[pa.RecordBatch], folder: str, per_shard: int, stride: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """Rows come in slot order; each shard is in one partition, whole."""
    system, base = _opened(folder)
    system.create_dir(base, recursive=True)
    width = np.dtype(dtype).itemsize
    file = index = name = temporary = None
    shard, first, n = -1, 0, 0
    unpack = zstandard.ZstdDecompressor().decompress

    def done() -> pa.RecordBatch:
        index.close()
        file.close()
        system.move(f"{temporary}.arrow", f"{name}.arrow")
        system.move(f"{temporary}.bin", f"{name}.bin")
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, f"{name}.bin", first, n), SHARD, strict=True)], schema=SHARD)

    for batch in stream:
        for k in range(0, len(batch), 256):  # a few records at a time as Python objects
            some = batch.slice(k, 256)
            for slot, ids, parts in zip(*(some[c].to_pylist() for c in ("slot", "ids", "parts")), strict=True):
                if slot // per_shard != shard:
                    if file is not None:
                        yield done()
                    shard, first, n = slot // per_shard, slot, 0
                    name, temporary = f"{base}/shard-{shard:08d}", f"{base}/.{uuid.uuid4().hex}"
                    file = system.open_output_stream(f"{temporary}.bin")
                    index = pa.ipc.new_file(system.open_output_stream(f"{temporary}.arrow"), INDEX, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                    held: list[tuple] = []
                ids = unpack(ids)
                file.write((len(ids) // width).to_bytes(HEADER, "little") + ids + bytes(stride * width - len(ids)))
                held.append((slot, parts))
                n += 1
                if len(held) == 1024 or n == per_shard:
                    index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), INDEX, strict=True)], schema=INDEX))
                    held = []
    if file is not None:
        if held:
            index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), INDEX, strict=True)], schema=INDEX))
        yield done()


def _records(stream: Iterator[pa.RecordBatch], folder: str, stride: int, dtype: str, block: int = 1024) -> Iterator[tuple[str, int, list[bytes]]]:
    """Path, first slot and ids of each block of the shards, read one after the other."""
    system, _ = _opened(folder)
    size, width = HEADER + stride * np.dtype(dtype).itemsize, np.dtype(dtype).itemsize
    for batch in stream:
        for path, first, n in zip(batch["path"].to_pylist(), batch["first_slot"].to_pylist(), batch["n"].to_pylist(), strict=True):
            with system.open_input_stream(path) as file:
                for k in range(0, n, block):
                    data = file.read(min(block, n - k) * size)
                    lengths = np.frombuffer(data, np.uint8).reshape(-1, size)[:, :HEADER].copy().view("<u4").ravel().tolist()
                    yield path, first + k, [data[i * size + HEADER : i * size + HEADER + m * width] for i, m in enumerate(lengths)]


READ_DDL = "slot long, ids binary"


def _read(stream: Iterator[pa.RecordBatch], folder: str, stride: int, dtype: str) -> Iterator[pa.RecordBatch]:
    for _, first, records in _records(stream, folder, stride, dtype):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + len(records))), pa.array(records, pa.binary())], names=["slot", "ids"])


CONTENTS_DDL = "slot long, offset long, doc_id long, start long, length long, ids_crc32 long"
CONTENTS = pa.schema([(c, pa.int64()) for c in ("slot", "offset", "doc_id", "start", "length", "ids_crc32")])


def _contents(stream: Iterator[pa.RecordBatch], folder: str, stride: int, dtype: str) -> Iterator[pa.RecordBatch]:
    system, _ = _opened(folder)
    width, path, parts = np.dtype(dtype).itemsize, None, None

    def index(name: str) -> Iterator[tuple[int, bytes]]:
        with system.open_input_file(name) as file:
            reader = pa.ipc.open_file(file)
            for k in range(reader.num_record_batches):
                batch = reader.get_batch(k)
                yield from zip(batch["slot"].to_pylist(), batch["parts"].to_pylist(), strict=True)

    for name, first, records in _records(stream, folder, stride, dtype):
        if name != path:
            path, parts = name, index(name.removesuffix("bin") + "arrow")
        rows = []
        for slot, ids in enumerate(records, first):
            of_slot, packed = next(parts)
            if of_slot != slot:
                raise ValueError(f"the index of {name} has slot {of_slot} for {slot}")
            offset = 0
            for doc_id, no_id, start, length in np.frombuffer(packed, PART).tolist():
                cut = np.frombuffer(ids, dtype, length, offset * width)
                rows.append((slot, offset, None if no_id else doc_id, start, length, zlib.crc32(cut.astype("<u4").tobytes())))
                offset += length
            if offset * width != len(ids):
                raise ValueError(f"the parts of slot {slot} are not its ids")
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CONTENTS, strict=True)], schema=CONTENTS)


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, key: int = 20_240_601, stride: int = 1024, per_shard: int = 8192, end_id: int = 0, dtype: str = "<u2") -> DataFrame:
    """Write the shards of `docs` to `folder`, now; returns the manifest: shard, path, first_slot, n.

    The ids are written once as a table, so that no lost executor has them made again, and
    shuffled once, each to the task of its shard.
    """
    spark = docs.sparkSession
    held = scratch(spark, "tokens")
    sequences(docs, tokenizer_path, stride, end_id, dtype).write.option("compression", "zstd").parquet(held)
    placed, n = slotted(spark.read.parquet(held), key)
    dealt = placed.repartitionById(parts_for(n, per_shard), F.floor(F.col("slot") / per_shard).cast("int")).sortWithinPartitions("slot")
    manifest = written(dealt.mapInArrow(lambda it: _write(it, folder, per_shard, stride, dtype), SHARD_DDL), "manifest")
    drop(spark, held)
    return manifest


def _opening(manifest: DataFrame) -> DataFrame:
    """The manifest, a few shards a task: it is one row a shard."""
    spark: SparkSession = manifest.sparkSession
    return manifest.repartition(max(1, min(manifest.count(), spark.sparkContext.defaultParallelism * 64)), "shard")


def read_shards(manifest: DataFrame, folder: str, stride: int = 1024, dtype: str = "<u2", from_slot: int = 0) -> DataFrame:
    """slot, ids from `from_slot` on; whole shards before it are not opened."""
    live = _opening(manifest.where(F.col("first_slot") + F.col("n") > from_slot))
    return live.mapInArrow(lambda it: _read(it, folder, stride, dtype), READ_DDL).where(F.col("slot") >= from_slot)


def shard_contents(manifest: DataFrame, folder: str, stride: int = 1024, dtype: str = "<u2") -> DataFrame:
    """slot, offset, doc_id, start, length, ids_crc32: every document's parts as the shards and their indexes hold them.

    start is a part's place among its document's ids; the checksum is of the ids as 32-bit ones. No shuffle but of the manifest.
    """
    return _opening(manifest).mapInArrow(lambda it: _contents(it, folder, stride, dtype), CONTENTS_DDL)
