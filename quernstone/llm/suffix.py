"""Removal of repeated passages by hash-compared suffix sorting.

A byte goes if a string of `window` bytes that covers it also starts in a document with
a smaller doc_id. Every window has an anchor: of the short strings inside it the one
whose hash is least. Equal windows have equal anchors at the same place, so only strings
around equal anchors need comparing, and most anchors are found in one document alone.

1. Documents are written as chunks (compressed, about 4 MB), whose ids stand for them.
2. Each chunk sends 40 bits of each of its anchors' hashes to a bucket; hashes of one
   document alone are dropped there, and each chunk hears which are not.
3. For those, a chunk sends the run of windows that share an anchor as one short string.
   Equal runs of a chunk are sent once, for the smallest document, since the others are
   then repeats. Runs of anchors that many chunks have are held back until the task's end
   and sent once a task; so a passage in a third of all documents is sent once a task.
4. A bucket sorts the suffixes that begin at anchors by mergesort. Two suffixes are
   compared by their common extension, found by binary search over prefix polynomial
   hashes; neighbours are then compared byte by byte, and a bucket in which a hash has
   deceived is sorted by its bytes. In the sorted order the windows that reach t bytes
   before the anchor fall into classes by their part from the anchor on; within a class
   the t bytes before are grouped by hash, verified as well, and the least doc_id known.
5. Chunks hear which windows repeat, and remove the bytes.

Defined cases: null text counts as empty; documents of equal doc_id do not affect each
other; a null doc_id is larger than any other; documents shorter than the window stay
whole; texts of any length are compared whole; an empty table gives an empty result. Only bytes decide: where a cut falls into a
character, the text that is given back leaves the rest of that character out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from quernstone.llm.common import buffers, parts_for, quoted, spans, text_or_empty, written

WINDOW, ANCHOR = 50, 20
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)
NO_ID = (1 << 63) - 1
CHUNK_BYTES, PIECE = 4 << 20, 1 << 19
BUCKET_BYTES, TASK_BUCKETS = 2 << 20, 6
#: An anchor in so many chunks is a common one; a task holds so many bytes of strings of common anchors.
COMMON_CHUNKS, HELD_BYTES = 16, 64 << 20

CHUNK_DDL = "chunk long, doc_ids binary, lengths binary, body binary, rest binary"
CHUNK = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.binary()), ("lengths", pa.binary()), ("body", pa.binary()), ("rest", pa.binary())])
ROUTED_DDL = "bucket int, chunk long, body binary"
ROUTED = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("body", pa.binary())])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each behind its length, compressed."""
    out = b"".join(part for a in arrays for part in (np.int64(a.nbytes).tobytes(), a.tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(out)


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(body), 0, []
    for kind in kinds:
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(np.frombuffer(data, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


def _chunks(stream: Iterator[pa.RecordBatch], chunk_bytes: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Documents in scan order; each batch is cut by bytes, and its other columns ride along as an Arrow stream."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in stream:
        batch = pa.RecordBatch.from_arrays(batch.columns, names=names)
        off, data = buffers(batch["text"])
        ids = batch["doc_id"].fill_null(NO_ID).to_numpy()
        rest = batch.drop_columns(["text"])
        for a, b in spans(np.diff(off), chunk_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rest.slice(a, b - a))
            body = zstandard.ZstdCompressor(level=1).compress(data[off[a] : off[b]].tobytes())
            row = (number, ids[a:b].astype("<i8").tobytes(), np.diff(off[a : b + 1]).astype("<i8").tobytes(), body, sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, CHUNK, strict=True)], schema=CHUNK)
            number += 1


def _rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: the columns of a batch can be large."""
    for batch in stream:
        for k in range(len(batch)):
            yield batch.slice(k, 1).to_pylist()[0]


class Chunk:
    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        self.bounds = np.append(0, np.cumsum(np.frombuffer(row["lengths"], "<i8")))
        self.bytes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["body"]) if self.bounds[-1] else b"", np.uint8)
        self.rest = row["rest"]

    def runs(self) -> Iterator[tuple[np.ndarray, ...]]:
        """start, count, anchor offset, key of each run of windows with one anchor, and the offset and bytes of the piece they are in."""
        n = len(self.bytes)
        if n < WINDOW:
            return
        whole = np.zeros(n - WINDOW + 2, np.int64)  # which windows lie in one document
        first, last = self.bounds[:-1], self.bounds[1:] - WINDOW + 1
        ok = last > first
        whole[first[ok]] += 1
        whole[last[ok]] -= 1
        whole = np.cumsum(whole)[:-1] > 0
        for a in range(0, n - WINDOW + 1, PIECE):
            piece = self.bytes[a : a + PIECE + WINDOW - 1]
            start, count, anchor, key = piece_runs(piece, whole[a : a + PIECE])
            if len(start):
                yield start + a, count, anchor, key, a, piece


def piece_runs(piece: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, ...]:
    h1 = piece.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _power(1) + h1[1:]
    h4 = h2[:-2] * _power(2) + h2[2:]
    h8 = h4[:-4] * _power(4) + h4[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    h = h16[:-4] * _power(4) + h4[16:]  # of ANCHOR = 16 + 4 bytes
    del h1, h2, h4, h8, h16
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(32)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, span = 1, WINDOW - ANCHOR + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: -(span - width)], least[span - width :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at[~whole] = -1
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    count = np.diff(np.append(start, len(at)))
    live = at[start] >= 0
    start, count = start[live], count[live]
    return start, count, at[start] - start, h[at[start]]


def bucket_of(key: np.ndarray, parts: int) -> np.ndarray:
    return (key % np.uint64(parts)).astype(np.int32)


def short(key: np.ndarray) -> np.ndarray:
    return key >> np.uint64(24)


def _five(key: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _eight(packed: np.ndarray) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = packed.reshape(-1, 5)
    return out.view("<u8").ravel()


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1])).tolist() if len(values) else []
    return list(zip(cuts, [*cuts[1:], len(values)][: len(cuts)], strict=True))


def _routed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROUTED, strict=True)], schema=ROUTED)


def _asked(stream: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's distinct anchor keys by bucket, those of several documents of the chunk marked."""
    for row in _rows(stream):
        chunk = Chunk(row)
        keys, docs = [], []
        for start, _, _, key, _, _ in chunk.runs():
            keys.append(key)
            docs.append(chunk.ids[np.searchsorted(chunk.bounds, start, "right") - 1])
        if not keys:
            continue
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        key = key[first]
        bucket = bucket_of(key, parts)
        order = np.argsort(bucket, kind="stable")
        key, several, bucket = short(key[order]), several[order], bucket[order]
        yield _routed([(int(bucket[a]), chunk.number, _five(key[a:b]).tobytes() + np.packbits(several[a:b]).tobytes()) for a, b in _runs(bucket)])


def _told(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys that a chunk has been told, with their bucket above, in order; and which of them are common."""
    keys, common = [], []
    for body in bodies:
        n = (len(body) - 4) * 8 // 41
        data = np.frombuffer(body, np.uint8, offset=4)
        keys.append(_eight(data[: 5 * n]) | np.uint64(int.from_bytes(body[:4], "little")) << np.uint64(40))
        common.append(np.unpackbits(data[5 * n :], count=n).astype(bool))
    key, mark = np.concatenate(keys), np.concatenate(common)
    order = np.argsort(key)
    return key[order], mark[order]


def _answered(stream: Iterator[pa.RecordBatch], common_chunks: int) -> Iterator[pa.RecordBatch]:
    """For each chunk its keys that several documents have, those that many chunks have marked."""
    keys, marks, buckets, chunks, sizes = [], [], [], [], []
    for batch in stream:
        for bucket, number, body in zip(batch["bucket"].to_pylist(), batch["chunk"].to_pylist(), batch["body"].to_pylist(), strict=True):
            n = len(body) * 8 // 41
            data = np.frombuffer(body, np.uint8)
            keys.append(_eight(data[: 5 * n]))
            marks.append(np.unpackbits(data[5 * n :], count=n).astype(bool))
            buckets.append(bucket)
            chunks.append(number)
            sizes.append(n)
    if not keys:
        return
    key, mark, row = np.concatenate(keys), np.concatenate(marks), np.repeat(np.arange(len(sizes)), sizes)
    full = key | np.repeat(np.array(buckets, np.uint64), sizes) << np.uint64(40)  # buckets of one task stay apart
    order = np.argsort(full, kind="stable")
    same = full[order][1:] == full[order][:-1]
    several = mark[order]
    several[1:] |= same
    several[:-1] |= same
    # a mark counts for all rows of its key
    first = np.flatnonzero(np.append(True, ~same))
    size = np.diff(np.append(first, len(order)))
    several = np.repeat(np.logical_or.reduceat(several, first), size)
    common = np.zeros(len(order), bool)
    common[order] = np.repeat(size >= common_chunks, size)  # a chunk has a key once
    told = np.sort(order[several])
    key, row, common = key[told], row[told], common[told]
    out = [(0, chunks[row[a]], np.int32(buckets[row[a]]).tobytes() + _five(key[a:b]).tobytes() + np.packbits(common[a:b]).tobytes()) for a, b in _runs(row)]
    for k in range(0, len(out), 2048):
        yield _routed(out[k : k + 2048])


POW = np.array([int(_power(k)) for k in range(2 * WINDOW)], np.uint64)
INVERSE = np.array([pow(int(BASE), -k, 1 << 64) for k in range(2 * WINDOW)], np.uint64)


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slices one after the other, the offset of each, and the place of every byte inside its slice."""
    off = np.append(0, np.cumsum(length))
    place = np.arange(off[-1]) - np.repeat(off[:-1], length)
    return data[np.repeat(start, length) + place], off, place


def prefix_hash(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Running sums of byte values times powers of the base, the power by place within the slice; modulo 2^64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POW[place], out=out[1:])
    return out


def _equal_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray, step: int = 1) -> np.ndarray:
    """Whether the strings from x and y on (backwards with step -1) agree over their length."""
    same = np.ones(len(x), bool)
    for k in range(int(length.max(initial=0))):
        live = np.flatnonzero(same & (length > k))
        same[live] = data[x[live] + step * k] == data[y[live] + step * k]
    return same


class Held:
    """Strings of common anchors, each for the smallest document of the task that has it."""

    def __init__(self, parts: int, limit: int):
        self.parts, self.limit, self.size = parts, limit, 0
        self.strings: dict[tuple[int, int, bytes], tuple[int, int, np.ndarray]] = {}  # key, anchor, text -> doc, chunk, places
        self.settled: dict[int, list[tuple[np.ndarray, int]]] = {}  # chunk -> places of repeats, number of windows

    def take(self, key: int, anchor: int, text: bytes, doc: int, chunk: int, places: np.ndarray) -> bool:
        """Whether the string is settled or held; not if a document of the same id has it already, as these do not affect each other."""
        name = key, anchor, text
        other = self.strings.get(name)
        if other is None:
            self.strings[name] = doc, chunk, places
            self.size += len(text) + places.nbytes + 400
            return True
        if other[0] == doc:
            return False
        count = len(text) - WINDOW + 1
        if other[0] < doc:
            self.settled.setdefault(chunk, []).append((places, count))
        else:
            self.settled.setdefault(other[1], []).append((other[2], count))
            self.strings[name] = doc, chunk, places
        self.size += places.nbytes + 100
        return True

    def flush(self) -> Iterator[pa.RecordBatch]:
        for chunk, found in self.settled.items():
            where = np.concatenate([places for places, _ in found])
            masks = np.repeat([(1 << count) - 1 for _, count in found], [len(places) for places, _ in found])
            yield _routed([(-1, chunk, _pack(where.astype("<u4"), masks.astype("<u4")))])
        by: dict[tuple[int, int], list] = {}
        for (key, anchor, text), (doc, chunk, places) in self.strings.items():
            by.setdefault((key % self.parts, chunk), []).append((doc, len(text), anchor, len(places), places, text))
        for (bucket, chunk), strings in sorted(by.items()):
            doc, length, anchor, n, places, text = zip(*strings, strict=True)
            yield _routed([(bucket, chunk, _pack(np.array(doc, "<i8"), np.array(length, np.uint8), np.array(anchor, np.uint8), np.array(n, "<u4"), np.concatenate(places).astype("<u4"), np.frombuffer(b"".join(text), np.uint8)))])
        self.strings, self.settled, self.size = {}, {}, 0


def _sent(stream: Iterator[pa.RecordBatch], parts: int, held_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs around shared anchors: to their bucket, or, where the task knows them to be repeats, straight to the result (bucket -1)."""
    held = Held(parts, held_bytes)
    for row in _rows(stream):
        if not row["told"]:
            continue
        known, common = _told(row["told"])
        chunk = Chunk(row)
        found = []
        for start, count, anchor, key, a, piece in chunk.runs():
            full = short(key) | bucket_of(key, parts).astype(np.uint64) << np.uint64(40)
            at = np.minimum(np.searchsorted(known, full), len(known) - 1)
            keep = known[at] == full
            found.append((start[keep], count[keep], anchor[keep], key[keep], common[at[keep]]))
        start, count, anchor, key, often = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = chunk.ids[np.searchsorted(chunk.bounds, start, "right") - 1]
        length = count + WINDOW - 1
        data, off, place = gathered(chunk.bytes, start, length)
        sums = prefix_hash(data, place)
        content = sums[off[1:]] - sums[off[:-1]]
        # equal runs stand together, the smallest document first
        order = np.lexsort((start, doc, content, length, anchor, key))
        start, count, anchor, key, doc, length, content, often = (v[order] for v in (start, count, anchor, key, doc, length, content, often))
        at = off[:-1][order]
        same = np.append(False, (key[1:] == key[:-1]) & (content[1:] == content[:-1]) & (length[1:] == length[:-1]) & (anchor[1:] == anchor[:-1]))
        group = np.cumsum(~same) - 1
        head = np.flatnonzero(~same)[group]
        deceived = ~_equal_bytes(data, at, at[head], np.where(head == np.arange(len(head)), 0, length))
        least = (doc == doc[head]) & ~deceived
        repeat = ~least & ~deceived
        if repeat.any():
            yield _routed([(-1, chunk.number, _pack(start[repeat].astype("<u4"), ((np.int64(1) << count[repeat]) - 1).astype("<u4")))])
        # one string per group, with all its places in the smallest document
        string = np.flatnonzero((head == np.arange(len(head))) | deceived)
        owner = np.where(deceived, np.arange(len(head)), head)
        places = np.flatnonzero(least | deceived)
        places = places[np.argsort(owner[places], kind="stable")]
        n_places = np.bincount(np.searchsorted(string, owner[places]), minlength=len(string))
        begin = np.append(0, np.cumsum(n_places))
        left = np.ones(len(string), bool)
        for i in np.flatnonzero(often[string]).tolist():
            k = int(string[i])
            text = data[at[k] : at[k] + length[k]].tobytes()
            left[i] = not held.take(int(key[k]), int(anchor[k]), text, int(doc[k]), chunk.number, start[places[begin[i] : begin[i + 1]]])
        live = np.flatnonzero(left)
        bucket = bucket_of(key[string[live]], parts)
        by = live[np.argsort(bucket, kind="stable")]
        rows = []
        for a, b in _runs(np.sort(bucket, kind="stable")):
            one = by[a:b]
            s = string[one]
            text, _, _ = gathered(data, at[s], length[s])
            where, _, _ = gathered(start[places], begin[one], n_places[one])
            rows.append((int(bucket_of(key[s[:1]], parts)[0]), chunk.number, _pack(doc[s].astype("<i8"), length[s].astype(np.uint8), anchor[s].astype(np.uint8), n_places[one].astype("<u4"), where.astype("<u4"), text)))
            if len(rows) == 64:
                yield _routed(rows)
                rows = []
        if rows:
            yield _routed(rows)
        if held.size > held.limit:
            yield from held.flush()
    yield from held.flush()


class Suffixes:
    """Strings with an anchor each, sorted by key and by what stands from the anchor on."""

    def __init__(self, data: np.ndarray, length: np.ndarray, anchor: np.ndarray, key: np.ndarray | None = None):
        self.data, self.anchor = data, anchor
        self.off = np.append(0, np.cumsum(length))[:-1]
        self.begin = self.off + anchor
        self.right = length - anchor
        self.sums = prefix_hash(data, np.arange(len(data)) - np.repeat(self.off, length))
        self.key = self.hash(np.arange(len(length)), anchor, np.full(len(length), ANCHOR)) if key is None else key

    def hash(self, i: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = self.off[i] + begin
        return (self.sums[at + length] - self.sums[at]) * INVERSE[begin]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the common extension of two suffixes, by binary search over hashes."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.right[i], self.right[j])
        a, b = self.anchor[i], self.anchor[j]
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live] + 1) >> 1
            same = self.hash(i[live], a[live], mid) == self.hash(j[live], b[live], mid)
            low[live] = np.where(same, mid, low[live])
            high[live] = np.where(same, high[live], mid - 1)

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = self.common(i, j)
        ends_i, ends_j = n >= self.right[i], n >= self.right[j]
        x = self.data[np.where(ends_i, 0, self.begin[i] + n)]
        y = self.data[np.where(ends_j, 0, self.begin[j] + n)]
        return np.where(ends_i, ~ends_j, ~ends_j & (x < y))

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """The order, and each one's common extension with the one before (0 across keys)."""
        order = np.argsort(self.key, kind="stable")
        order = self._merge(order)
        lcp = self._neighbours(order, self.common)
        wrong = ~_equal_bytes(self.data, self.begin[order[1:]], self.begin[order[:-1]], lcp[1:])
        one, two = order[:-1], order[1:]
        n = lcp[1:]
        alike = self.key[one] == self.key[two]
        end = n >= np.minimum(self.right[one], self.right[two])
        falls = self.data[np.where(end, 0, self.begin[one] + n)] > self.data[np.where(end, 0, self.begin[two] + n)]
        if (wrong | alike & ~end & falls | alike & end & (self.right[one] > self.right[two])).any():  # a hash has deceived
            raw = self.data.tobytes()
            suffix = [raw[b : b + r] for b, r in zip(self.begin.tolist(), self.right.tolist(), strict=True)]
            order = np.array(sorted(range(len(suffix)), key=lambda i: (int(self.key[i]), suffix[i])), np.int64)
            lcp = self._neighbours(order, self._common_bytes)
        return order, lcp

    def _neighbours(self, order: np.ndarray, common) -> np.ndarray:
        lcp = np.zeros(len(order), np.int64)
        at = np.flatnonzero(self.key[order[1:]] == self.key[order[:-1]]) + 1
        lcp[at] = common(order[at], order[at - 1])
        return lcp

    def _common_bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, most = np.zeros(len(i), np.int64), np.minimum(self.right[i], self.right[j])
        live = np.flatnonzero(n < most)
        while len(live):
            live = live[self.data[self.begin[i[live]] + n[live]] == self.data[self.begin[j[live]] + n[live]]]
            n[live] += 1
            live = live[n[live] < most[live]]
        return n

    def _merge(self, order: np.ndarray) -> np.ndarray:
        """Mergesort of all keys' groups side by side: the place of an element is its own plus its rank in the sibling run."""
        key = self.key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(order)))
        start, size = np.repeat(first, size), np.repeat(size, size)
        inside = np.arange(len(order)) - start
        width = 1
        while True:
            live = np.flatnonzero(size > width)
            if not len(live):
                return order
            run = inside[live] // width
            mine = start[live] + run * width
            other = start[live] + (run ^ 1) * width
            n = np.clip(start[live] + size[live] - other, 0, width)
            is_right = run & 1 == 1
            low, high = np.zeros(len(live), np.int64), n.copy()
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                x, y = order[live[open_]], order[other[open_] + mid]
                right = is_right[open_]
                # a right element comes after its equals in the left run
                before = np.empty(len(open_), bool)
                before[right] = ~self.less(x[right], y[right])
                before[~right] = self.less(y[~right], x[~right])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            place = np.minimum(mine, other) + (live - mine) + low
            merged = order.copy()
            merged[place] = order[live]
            order = merged
            width *= 2


def repeated_windows(doc: np.ndarray, length: np.ndarray, anchor: np.ndarray, data: np.ndarray) -> np.ndarray:
    """A bit per window of each string, set if a string of the same anchor and a smaller doc has the same window."""
    suffixes = Suffixes(data, length, anchor)
    order, lcp = suffixes.sorted()
    doc, anchor, begin = doc[order], anchor[order], suffixes.begin[order]
    count = length[order] - WINDOW + 1
    mask = np.zeros(len(order), np.uint32)
    for t in range(WINDOW - ANCHOR + 1):
        classes = np.cumsum(lcp < WINDOW - t)
        item = np.flatnonzero((anchor >= t) & (anchor - t < count))
        if len(item) < 2:
            continue
        # classes with more than one document
        c, d = classes[item], doc[item]
        first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        n = np.diff(np.append(first, len(item)))
        item = item[np.repeat(np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first), n)]
        if not len(item):
            continue
        left = suffixes.hash(order[item], anchor[item] - t, np.full(len(item), t))
        by = np.lexsort((doc[item], left, classes[item]))
        item, left = item[by], left[by]
        same = (classes[item[1:]] == classes[item[:-1]]) & (left[1:] == left[:-1])
        if t and same.any():
            x, y = item[1:][same], item[:-1][same]
            if not _equal_bytes(data, begin[x] - 1, begin[y] - 1, np.full(len(x), t), -1).all():
                texts = [data[b - t : b].tobytes() for b in begin[item].tolist()]
                by = np.array(sorted(range(len(item)), key=lambda i: (int(classes[item[i]]), texts[i], int(doc[item[i]]))), np.int64)
                same = np.array([classes[item[i]] == classes[item[j]] and texts[i] == texts[j] for i, j in zip(by[1:], by[:-1], strict=True)], bool)
                item = item[by]
        head = np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(item)), 0))
        repeat = doc[item] > doc[item[head]]
        mask[item[repeat]] |= np.uint32(1) << (anchor[item[repeat]] - t).astype(np.uint32)
    out = np.empty(len(order), np.uint32)
    out[order] = mask
    return out


def _solve(parts: list[list[np.ndarray]], chunks: list[int]) -> Iterator[pa.RecordBatch]:
    """The repeated windows of one bucket, for each chunk that has any."""
    sizes = [len(p[0]) for p in parts]
    doc, length, anchor, n_places, where, data = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    length, anchor, n_places = length.astype(np.int64), anchor.astype(np.int64), n_places.astype(np.int64)
    mask = repeated_windows(doc, length, anchor, data)
    row, begin = np.repeat(np.arange(len(sizes)), sizes), np.append(0, np.cumsum(n_places))
    hit = np.flatnonzero(mask)
    for a, b in _runs(row[hit]):
        one = hit[a:b]
        places, _, _ = gathered(where, begin[one], n_places[one])
        yield _routed([(-1, chunks[row[one[0]]], _pack(places, np.repeat(mask[one], n_places[one]).astype("<u4")))])


def _solved(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come one after the other; what is settled already goes through."""
    parts, chunks, at = [], [], -1
    for row in _rows(stream):
        if row["bucket"] < 0:
            yield _routed([(-1, row["chunk"], row["body"])])
            continue
        if row["bucket"] != at and parts:
            yield from _solve(parts, chunks)
            parts, chunks = [], []
        at = row["bucket"]
        parts.append(_unpack(row["body"], "<i8", "u1", "u1", "<u4", "<u4", "u1"))
        chunks.append(row["chunk"])
    if parts:
        yield from _solve(parts, chunks)


def covered(n: int, bodies: list[bytes]) -> np.ndarray:
    """Which of n bytes are in a repeated window."""
    starts = [np.zeros(0, np.int64)]
    for body in bodies:
        place, mask = _unpack(body, "<u4", "<u4")
        for k in range(0, len(place), 1 << 16):
            bits = mask[k : k + (1 << 16), None] >> np.arange(WINDOW - ANCHOR + 1, dtype=np.uint32) & np.uint32(1)
            row, bit = np.nonzero(bits)
            starts.append(place[k + row].astype(np.int64) + bit)
    start = np.concatenate(starts)
    change = np.bincount(start, minlength=n + 1) - np.bincount(start + WINDOW, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _cleaned(stream: Iterator[pa.RecordBatch], schema: pa.Schema, with_text: bool) -> Iterator[pa.RecordBatch]:
    for row in _rows(stream):
        chunk = Chunk(row)
        gone = covered(len(chunk.bytes), row["told"] or [])
        edges = np.append(False, gone)
        rises = gone & ~edges[:-1]
        rises[chunk.bounds[:-1][chunk.bounds[:-1] < len(gone)]] |= gone[chunk.bounds[:-1][chunk.bounds[:-1] < len(gone)]]
        removed, n_spans = (np.append(0, np.cumsum(x))[chunk.bounds] for x in (gone, rises))
        digests, texts = [], []
        for a, b, any_ in zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), np.diff(removed).tolist(), strict=True):
            kept = chunk.bytes[a:b]
            kept = (kept[~gone[a:b]] if any_ else kept).tobytes()
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode("utf-8", "ignore"))
        rest = pa.ipc.open_stream(chunk.rest).read_all().combine_chunks().to_batches()[0]
        columns = {name: rest[name] for name in rest.schema.names}
        columns |= {"n_bytes": pa.array(np.diff(chunk.bounds)), "n_removed": pa.array(np.diff(removed)), "n_spans": pa.array(np.diff(n_spans)), "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            columns["text"] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def remove_repeats(docs: DataFrame, with_text: bool = True, chunk_bytes: int = CHUNK_BYTES, common_chunks: int = COMMON_CHUNKS, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Every document with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the text that is left.

    Other columns of `docs` stay; any of them that has one of these names is replaced.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    others = [quoted(c) for c in docs.columns if c not in (*made, "text", "doc_id")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"), *others)
    # under names without dots, which Spark would take for fields of a column
    plain, columns = rows.toDF(*[f"c{k}" for k in range(len(rows.columns))]), rows.columns
    chunks = written(plain.mapInArrow(lambda it: _chunks(it, chunk_bytes, columns), CHUNK_DDL), "chunks", compression="none")
    total = chunks.agg(F.sum(F.length("lengths") / 8 * 64 + F.length("body")), F.count("*")).first()
    buckets = parts_for((total[0] or 0) * 2, BUCKET_BYTES, 4)  # about as many bytes of shared strings as of text
    parts = parts_for(buckets, TASK_BUCKETS, 4)

    asked = chunks.mapInArrow(lambda it: _asked(it, buckets), ROUTED_DDL)
    told = asked.repartitionById(parts, F.col("bucket") % parts).mapInArrow(lambda it: _answered(it, common_chunks), ROUTED_DDL)
    with_told = chunks.join(told.groupBy("chunk").agg(F.collect_list("body").alias("told")), "chunk", "left")
    sent = with_told.mapInArrow(lambda it: _sent(it, buckets, held_bytes), ROUTED_DDL)
    # what is settled already is spread by chunk, the rest by bucket
    where = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("chunk"), F.lit(buckets))).otherwise(F.col("bucket"))
    solved = sent.repartitionById(parts, (where % parts).cast("int")).sortWithinPartitions("bucket").mapInArrow(_solved, ROUTED_DDL)
    results = chunks.join(solved.groupBy("chunk").agg(F.collect_list("body").alias("told")), "chunk", "left")
    names = [f.name for f in rows.schema if f.name != "text"]
    fields = [rows.schema[n] for n in names] + StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string").fields + [StructField("text", StringType())] * with_text
    schema = to_arrow_schema(StructType(fields))
    return results.mapInArrow(lambda it: _cleaned(it, schema, with_text), StructType(fields))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with repeated passages gone from text, and n_chars, where there is one, of what is left; all other columns as they are."""
    names = docs.columns
    inside = [c if c in ("doc_id", "text") else f"c{k}" for k, c in enumerate(names)]
    cleaned = remove_repeats(docs.toDF(*inside))
    if "n_chars" in names:
        cleaned = cleaned.withColumn(inside[names.index("n_chars")], F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*[F.col(i).alias(c) for i, c in zip(inside, names, strict=True)])
