"""Quality classifier by positive-unlabelled learning.

A linear model of byte and byte-pair frequencies, length and compressibility is fitted by the non-negative unbiased
risk: prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)]) with the logistic loss
l, trusted positives P, unlabelled web text U and the class prior. Where the second term
falls below zero, the step goes against it, so the model cannot win by memorising U.

The prior is the share of ones among all labels of the training folds. It uses the
negatives as well and is right for the table only where labels were drawn at random from
it; it is no estimate from positives and unlabelled texts alone.

The trusted positives and the unlabelled texts of the fit are samples of at most
`positives` and `unlabelled` rows at any size of the table: drawn by a hash of the id, of
the unlabelled ones of id and text, so that copies of a text are drawn apart, and cut by
rank, so that rows repeated with id and text cannot exceed the bound. All documents are
scored, over their whole texts. Labels, lang, source and doc_id are never part of the
features.

Defined cases: null text counts as empty; an empty text has only the length feature and
gets the score that follows; without any label of 1 every score is near 0, without any
label 0.5; repeated rows are all scored; several labels of a document count each; texts
of any length are read whole; an empty table gives an empty result; other columns are
ignored, or kept by `drop_rejected`, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import buffers, spans, text_or_empty

PAIRS = 256
COUNTS = 256 + PAIRS
WIDTH = COUNTS + 3
FOLDS, HELD_OUT, CUT = 5, 0, 0.3


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte and hashed byte-pair counts of each text; no pair spans two texts."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    b = data[off[0] : off[-1]].astype(np.int64)
    out = np.bincount(row * COUNTS + b, minlength=n * COUNTS)
    if len(b) > 1:
        pair = (b[:-1] * 40503 + b[1:] * 10007 >> 3) % PAIRS
        inside = row[1:] == row[:-1]
        out += np.bincount((row[1:] * COUNTS + 256 + pair)[inside], minlength=n * COUNTS)
    return out.reshape(n, COUNTS)


def features(texts: pa.Array, block: int = 1 << 19) -> Iterator[np.ndarray]:
    """Rows of features for consecutive texts: square roots of frequencies, the length and how far it compresses."""
    off, data = buffers(texts)
    for a, b in spans(np.diff(off), block):
        if b - a == 1 and off[b] - off[a] > block:  # a long text, by parts that share a byte
            counts = np.zeros((1, COUNTS), np.int64)
            for k in range(int(off[a]), int(off[b]), block):
                part = _counts(data, np.array([max(k - 1, int(off[a])), min(k + block, int(off[b]))]))
                if k > off[a]:
                    part[0, data[k - 1]] -= 1
                counts += part
        else:
            counts = _counts(data, off[a : b + 1])
        length = np.diff(off[a : b + 1])
        packed = np.array([len(zlib.compress(data[off[i] : off[i + 1]], 1)) for i in range(a, b)])
        out = np.empty((b - a, WIDTH), np.float32)
        out[:, :COUNTS] = np.sqrt(counts / np.maximum(length, 1)[:, None])
        out[:, COUNTS] = np.log1p(length) / 10
        out[:, COUNTS + 1] = np.log((packed + 1) / (length + 12))  # how repetitive
        out[:, COUNTS + 2] = out[:, COUNTS + 1] ** 2
        yield out


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(x.astype(np.float64) @ self.weights + self.bias, -30, 30)
        return 1 / (1 + np.exp(-z))


def softplus(z: np.ndarray) -> np.ndarray:
    """The logistic loss l(-z)."""
    return np.logaddexp(0, z)


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the risk of scores on positives and on unlabelled texts: prior * E_P[l(z)] and E_U[l(-z)] - prior * E_P[l(-z)]."""
    return prior * softplus(-zp).mean(), softplus(zu).mean() - prior * softplus(zp).mean()


def step_direction(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """What a step goes down, by score: the whole risk, or the second term's negative where that term is below zero."""
    of_p, of_u = (1 / (1 + np.exp(-np.clip(z, -30, 30))) / len(z) for z in (zp, zu))  # gradients of the means of l(-z)
    if risk(zp, zu, prior)[1] >= 0:
        return prior * (of_p - 1 / len(zp)) - prior * of_p, of_u
    return prior * of_p, -of_u


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 3000, rate: float = 0.1, decay: float = 1e-5, batch: int = 512, seed: int = 7) -> QualityModel:
    """Adam on the non-negative risk, over batches of both samples, with a falling rate."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-3)
    p_all, u_all = (((x - mean) / scale / 4).astype(np.float32) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(p_all.shape[1], np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        p, u = p_all[rng.integers(0, len(p_all), batch)], u_all[rng.integers(0, len(u_all), 2 * batch)]
        gp, gu = step_direction(p @ w + bias, u @ w + bias, prior)
        grad = np.append(p.T @ gp.astype(np.float32) + u.T @ gu.astype(np.float32) + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        now = rate * (1 - step / (steps + 1))
        change = now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w = (w - change[:-1]).astype(np.float32)
        bias -= change[-1]
    weights = (w / scale / 4).astype(np.float64)
    return QualityModel(weights, float(bias - weights @ mean))


FEATURES_DDL = "positive boolean, place long, x binary"
FEATURES = pa.schema([("positive", pa.bool_()), ("place", pa.int64()), ("x", pa.binary())])


def _featured(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        x = [r.tobytes() for block in features(batch["text"]) for r in block]
        yield pa.RecordBatch.from_arrays([batch["positive"], batch["place"], pa.array(x, pa.binary())], schema=FEATURES)


def place(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key, F.lit("fit")), F.lit(1 << 30))


def about(key: list[str], bound: int, total: int) -> Column:
    """About `bound` of `total` rows, by a hash of the key."""
    return place(*key) < int(min(1.0, bound / max(total, 1)) * (1 << 30))


def drawn(rows: DataFrame, bound: int) -> DataFrame:
    """About `bound` rows; copies of a text are drawn one by one."""
    return rows.where(about(["doc_id", "text"], bound, rows.count()))


def sampled(rows: DataFrame, positive: bool, bound: int) -> DataFrame:
    """The features of `bound` rows (doc_id, text) at most: the first by hash, kept in every task before they meet."""
    marked = rows.select(F.lit(positive).alias("positive"), place("doc_id", "text").alias("place"), "text")
    return marked.mapInArrow(_featured, FEATURES_DDL).orderBy("place", "x").limit(bound)


def train(docs: DataFrame, labels: DataFrame, positives: int = 3000, unlabelled: int = 6000) -> QualityModel:
    """Fit on the training folds. The fit is one task over at most `positives` + `unlabelled` rows of features; the weights reach the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    n, ones = known.agg(F.count("*"), F.sum("quality")).first()
    if not n or not ones:
        return QualityModel(np.zeros(WIDTH), -30.0 if n else 0.0)
    prior = min(max(ones / n, 0.01), 0.99)

    trusted = known.where((F.col("quality") == 1) & about(["doc_id"], positives, ones)).select("doc_id").distinct().orderBy(place("doc_id"), "doc_id").limit(positives)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")).where(F.coalesce(fold(F.col("doc_id")) != HELD_OUT, F.lit(True)))
    # the trusted ids are `positives` at most
    p = sampled(rows.join(F.broadcast(trusted), "doc_id", "left_semi"), True, positives)
    u = sampled(drawn(rows, unlabelled), False, unlabelled)
    # one task of bounded input, whose linear algebra Spark holds to the cores of a task
    fitted = p.unionByName(u).repartition(1).mapInArrow(lambda it: _fitted(it, prior), MODEL_DDL).first()
    if fitted is None:
        return QualityModel(np.zeros(WIDTH), float(np.log(prior / (1 - prior))))
    return QualityModel(np.frombuffer(fitted["weights"], np.float64), fitted["bias"])


MODEL_DDL = "weights binary, bias double"


def _fitted(stream: Iterator[pa.RecordBatch], prior: float) -> Iterator[pa.RecordBatch]:
    found = pa.Table.from_batches(list(stream), FEATURES)
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float32).reshape(-1, WIDTH)
    is_p = np.array(found["positive"].to_pylist(), bool)
    if not is_p.any() or is_p.all():
        return
    order = sorted(range(len(x)), key=lambda i: (bool(is_p[i]), x[i].tobytes()))  # the fit does not depend on the order of tasks
    x, is_p = x[order], is_p[order]
    model = fit(x[is_p], x[~is_p], prior)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])


SCORED_DDL = "doc_id long, held_out boolean, score double, predicted int"
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def _scores(texts: pa.Array, model: QualityModel) -> np.ndarray:
    blocks = [model.score(x) for x in features(texts)]
    return np.round(np.concatenate(blocks), 9) if blocks else np.zeros(0)


def _scored(stream: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        s = _scores(batch["text"], model)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(s), pa.array((s >= CUT).astype(np.int32))], schema=SCORED)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; no shuffle of texts."""
    model = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(lambda it: _scored(it, model), SCORED_DDL)


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the documents that the classifier predicts to be of low quality."""
    model = train(docs, labels)

    at = docs.columns.index("text")

    def keep(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch[at].cast(pa.string()).fill_null("")
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(_scores(texts, model) >= CUT))

    names = docs.columns
    # under names without dots, which Spark would take for fields of a column
    return docs.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(keep, docs.schema)
