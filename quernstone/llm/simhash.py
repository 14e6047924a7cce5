"""SimHash near-deduplication by Golay-code fuzzy hashing.

Fingerprints that differ in at most four of 64 bits link. The bits form two segments of
23, A and B, and S of 18. The perfect binary Golay code has a codeword within three bits
of any 23-bit word, and the codewords of all words within one bit of a segment (one, or
six) are its keys: two segments that differ in at most two bits share a word halfway and
so a key. With a, b, s of at most four errors in the segments:

* s = 0: a or b is at most two: a key of A, or of B, with S exactly;
* a = 0: s is at most two, or else b is at most one: A exactly with a key of S, or of B;
* b = 0: likewise B exactly with a key of S, or of A;
* else none is zero, so two of them are one and the third at most two: a key of the third
  with a half of each of the two, as one error leaves one half of a segment whole.

These eighteen kinds of joint keys, each of 30 to 36 bits, find every linked pair.
Candidates that share a joint key are verified bit by bit.

Copies collapse first: keys are made of distinct fingerprints. Buckets are verified in
blocks, and a batch of verified links leaves a task as a star for each of its connected
parts. A group of n near copies has a star in every task that holds a key of it, so up to
88 n rows, one a key; `contracted` takes them to stars of blocks of links, of n - 1 rows
where a block holds them all, before components spread over them round by round.

Defined cases: null text counts as empty; texts without words have fingerprint zero and
link like any other; a null doc_id is never a component's id unless it has no other;
repeated rows are all returned; a text of any length counts whole; an empty table gives
an empty result; other columns are ignored, whatever their names. Of a component
`drop_near_copies` keeps one row: of the smallest doc_id, null after all others, and of
rows with that the first in scan order.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import parts_for, row_bytes, text_or_empty
from quernstone.llm.exact import LOWER, with_row
from quernstone.operators import graph
from quernstone.operators.graph import checkpointed

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
BITS, ALLOWED = 64, 4
FINGERPRINT_DDL = "row long, doc_id long, fp long"
FINGERPRINT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each run of `width` lower-cased words, joined by blanks; of all words where there are fewer."""
    words = WORD.findall(text.translate(LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - width + 1].tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def fingerprint(text: bytes, width: int = 4) -> int:
    """A bit is set if it is set in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        block = hashes[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(stream: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        fps = np.array([fingerprint(t, width) for t in row_bytes(batch["text"])], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], pa.array(fps)], schema=FINGERPRINT)


def fingerprints(docs: DataFrame, width: int = 4, row_col: str | None = None) -> DataFrame:
    """row, doc_id, fp of every document."""
    if row_col is None:
        docs, row_col = with_row(docs)
    rows = docs.select(F.col(row_col).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lambda it: _fingerprints(it, width), FINGERPRINT_DDL)


GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


@functools.cache
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the 23 single bits, and the error pattern of each remainder: of weight three at most, as the code is perfect."""
    single = []
    for bit in range(23):
        rest = 1 << bit
        for k in range(bit, 10, -1):
            if rest >> k & 1:
                rest ^= GENERATOR << (k - 11)
        single.append(rest)
    errors = np.full(2048, -1, np.int64)
    errors[0] = 0
    for a in range(23):
        errors[single[a]] = 1 << a
        for b in range(a):
            errors[single[a] ^ single[b]] = 1 << a | 1 << b
            for c in range(b):
                errors[single[a] ^ single[b] ^ single[c]] = 1 << a | 1 << b | 1 << c
    if (errors < 0).any():
        raise AssertionError("the code is not perfect")
    return np.array(single, np.int64), errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    single, errors = _syndromes()
    rest = np.zeros_like(words)
    for bit in range(23):
        rest ^= np.where(words >> bit & 1, single[bit], 0)
    return (words ^ errors[rest]) >> 11


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and codeword index of every key: the nearest codewords of each word and of the 23 words a bit away."""
    around = np.stack([codeword_index(words ^ flip) for flip in [0, *(1 << b for b in range(23))]], axis=1)
    around.sort(axis=1)
    fresh = np.ones(around.shape, bool)
    fresh[:, 1:] = around[:, 1:] != around[:, :-1]
    rows, columns = np.nonzero(fresh)
    return rows, around[rows, columns]


def joint_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and joint key of each distinct fingerprint (uint64)."""
    f = fps.astype(np.uint64)
    first, second, short = ((f >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in ((41, 23), (18, 23), (0, 18)))
    (r1, k1), (r2, k2), (r3, k3) = (nearby_indices(s) for s in (first, second, short))
    rows, keys = [], []

    def add(row: np.ndarray, key: np.ndarray) -> None:
        keys.append(key | len(rows) << 40)
        rows.append(row)

    add(r1, k1 << 18 | short[r1])
    add(r2, k2 << 18 | short[r2])
    add(r3, first[r3] << 12 | k3)
    add(r2, first[r2] << 12 | k2)
    add(r3, second[r3] << 12 | k3)
    add(r1, second[r1] << 12 | k1)
    halves = [(segment & (1 << n) - 1, segment >> n) for segment, n in ((first, 11), (second, 11), (short, 9))]
    for (r, k), one, other in (((r1, k1), 1, 2), ((r2, k2), 0, 2), ((r3, k3), 0, 1)):
        for x in halves[one]:
            for y in halves[other]:
                add(r, (k << 12 | x[r]) << 12 | y[r])
    return np.concatenate(rows), np.concatenate(keys)


KEYED_DDL = "key long, fp long"
KEYED = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
EDGE_DDL = "a long, b long"
EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _keyed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for k in range(0, len(batch), 1024):
            fps = batch["fp"].slice(k, 1024).to_numpy()
            rows, keys = joint_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], schema=KEYED)


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the graph with edges (a, b), and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _large_bucket(fps: np.ndarray, allowed: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a large bucket: each row against all in one pass, until everything is connected."""
    label = np.arange(len(fps))
    a, b = [], []
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= allowed)
        others = np.unique(label[near])
        if len(others) > 1:
            first = near[np.unique(label[near], return_index=True)[1]]
            a.append(np.full(len(first), i))
            b.append(first)
            label[np.isin(label, others)] = others[0]
            if (label == label[0]).all():
                break
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return fps[np.concatenate(a)], fps[np.concatenate(b)]


def _links(stream: Iterator[pa.RecordBatch], allowed: int, small: int = 64) -> Iterator[pa.RecordBatch]:
    """Stars of the links found in key order; the last bucket of a batch waits for its rest."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def solve(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits = fp.view(np.uint64)
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(key)))
        a, b = [], []
        for s, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
            x, y = _large_bucket(bits[s : s + n], allowed)
            a.append(x.view(np.int64))
            b.append(y.view(np.int64))
        keep = np.repeat((sizes > 1) & (sizes <= small), sizes)
        key, fp, bits = key[keep], fp[keep], bits[keep]
        for d in range(1, small):
            at = np.flatnonzero(key[d:] == key[:-d])
            if not len(at):
                break
            at = at[np.bitwise_count(bits[at] ^ bits[at + d]) <= allowed]
            a.append(fp[at])
            b.append(fp[at + d])
        if a and sum(map(len, a)):
            nodes, root = roots(np.concatenate(a), np.concatenate(b))
            other = nodes != root
            yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(root[other])], schema=EDGE)

    for batch in stream:
        key, fp = np.append(key, batch["key"].to_numpy()), np.append(fp, batch["fp"].to_numpy())
        if len(key) and key[0] != key[-1] and len(key) > 50_000:
            cut = np.searchsorted(key, key[-1])
            yield from solve(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
    yield from solve(key, fp)


def _stars(stream: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The links of a task as one star for each of its connected parts."""
    held, size = [], 0

    def star(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        nodes, root = roots(*map(np.concatenate, zip(*held, strict=True)))
        other = nodes != root
        return nodes[other], root[other]

    for batch in stream:
        held.append((batch["a"].to_numpy(), batch["b"].to_numpy()))
        size += len(batch)
        if size > limit:
            held = [star(held)]
            size = 0
    if held:
        a, b = star(held)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=EDGE)


def contracted(edges: DataFrame, each: int = 2_000_000) -> DataFrame:
    """Links (a, b) that connect the same nodes as `edges`, dealt evenly in blocks of `each` that leave as stars; again while they halve."""
    edges = checkpointed(edges.distinct())
    n = edges.count()
    while True:
        parts = parts_for(n, each)
        edges = checkpointed(edges.repartition(parts).mapInArrow(_stars, EDGE_DDL))
        before, n = n, edges.count()
        if parts == 1 or 2 * n > before:
            return edges


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of the nodes that edges (a, b) have."""
    links = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return graph.components(links.select(F.col("src").alias("node")), links)


def near_groups(docs: DataFrame, width: int = 4, allowed: int = ALLOWED, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """row, doc_id, fp, keep (doc_id and row of its component's first) of every document; and the `keep` of every component.

    The texts are read once and never shuffled; what moves is fingerprints and keys. Where
    many rows share a fingerprint, or many fingerprints a component, they hear of it by a
    broadcast of bounded size.
    """
    fps = checkpointed(fingerprints(docs, width, row_col))
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row")
    distinct = checkpointed(fps.groupBy("fp").agg(F.min(order).alias("least"), F.count("*").alias("n")))
    total, n = distinct.agg(F.sum("n"), F.count("*")).first()
    keyed = distinct.select("fp").mapInArrow(_keyed, KEYED_DDL)
    edges = keyed.repartition(parts_for(n, 5_000, 12), "key").sortWithinPartitions("key").mapInArrow(lambda it: _links(it, allowed), EDGE_DDL)
    linked = components(contracted(edges))
    rooted = distinct.join(linked, distinct.fp == linked.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = checkpointed(rooted)
    keeps = checkpointed(rooted.groupBy("root").agg(F.min("least").alias("keep")))  # else its grouping by root would deal all rows of a heavy root to one task
    of_fp = graph.looked_up(rooted.select("fp", "root"), "root", keeps.select(F.col("root").alias("node"), F.col("keep").alias("value")), graph.heavy_keys(rooted, "root", n))
    often = distinct.where(F.col("n") > max(graph.LEAST_HEAVY, (total or 0) // graph.HEAVY)).select(F.col("fp").alias("heavy"))
    told = graph.looked_up(fps, "fp", of_fp.select(F.col("fp").alias("node"), "value"), often)
    return told.withColumnRenamed("value", "keep"), keeps


def near_copies(docs: DataFrame, width: int = 4, allowed: int = ALLOWED) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    told, _ = near_groups(docs, width, allowed)
    return told.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("keep.doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, width: int = 4, allowed: int = ALLOWED) -> DataFrame:
    """`docs` with one row of each component: the one with the smallest doc_id. All columns stay as they are."""
    numbered, row = with_row(docs)
    _, keeps = near_groups(numbered, width, allowed, row)
    return numbered.join(keeps.select(F.col("keep.row").alias(row)), row, "left_semi").drop(row)
