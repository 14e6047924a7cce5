"""Quality rules with distribution divergence.

Base counts come first (words, symbols, repeated lines and windows). The method's
verdict compares two histograms of a document with those of languages by the
Jensen-Shannon distance (square root of the divergence, base 2): characters by class,
and common words against all others. A language's reference is the mean histogram of
those of its documents that pass the base rules and are long enough for both histograms
(60 words, 400 characters), each counting alike whatever its length. Every language with
five such documents has one, whatever its share of the table. A document is held against
the nearest of its own language and the widespread ones, so that a rare language's
documents have their own reference and the odd ones of a rare label excuse no others.
Where its language has no reference, a document is not judged by divergence, and too
short a document for a histogram is not judged by it.

Texts are read once: what a document counts is kept as a short row, from which come both
the references and the verdicts.

Defined cases: null text counts as none (0 words, base_failed); a null lang is a
language of its own; repeated rows are all returned and all count; texts of any length
are read whole; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import batches, text_or_empty, written

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of each language.
COMMON = {
    "de": "als an auch auf aus bei das dem den der des die ein eine einen er es für hat ich im in ist mit nach nicht sich sie sind so um und von war werden wie wird zu zum".split(),
    "en": "a an and are as at be but by for from had has have he his in is it not of on or she that the they this to was were which will with you".split(),
    "es": "a al como con de del el en es esta este fue ha la las le lo los más me mi no o para pero por que se si sin son su sus te un una y".split(),
    "fr": "a au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
PLACE = {w: k for k, w in enumerate(WORDS)}
EDGES = ".,;:!?\"'()[]"
CLASSES = ("lower", "upper", "digit", "space", "sentence mark", "other mark", "symbol", "accented", "other")


def _class_table() -> np.ndarray:
    """The class of each byte of UTF-8; continuation bytes have none."""
    table = np.full(256, CLASSES.index("other"), np.int64)
    for b in range(128):
        c = chr(b)
        name = "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "space" if c in SPACES else "sentence mark" if c in ".,;:?'\"-" else "symbol" if c in SYMBOLS else "other mark"
        table[b] = CLASSES.index(name)
    table[0x80:0xC0] = len(CLASSES)
    table[0xC3:0xC6] = CLASSES.index("accented")
    return table


CLASS_OF = _class_table()
N_CLASSES, N_WORDS = len(CLASSES), len(WORDS) + 1


@dataclass(frozen=True)
class RuleLimits:
    min_words: int = 10
    max_repeat_percent: int = 20
    min_class_chars: int = 400
    max_class_distance: float = 0.30
    #: From so many words on, so large a distance: short texts stray further from any reference.
    word_limits: tuple[tuple[int, float], ...] = ((200, 0.25), (60, 0.37))

    @property
    def min_common_words(self) -> int:
        return min(n for n, _ in self.word_limits)

    def max_word_distance(self, n_words: int) -> float:
        return next((most for n, most in self.word_limits if n_words >= n), 1.0)


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words inside windows of `width` words that are found twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    place = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    key, size = ids[:n], len(place)
    for k in range(1, width):
        if size * len(place) >= 1 << 62:
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key, size = key * len(place) + ids[k : k + n], size * len(place)
    ordered = np.sort(key)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    marks = np.zeros(len(words) + 1, np.int64)
    begin = np.flatnonzero(count[at] > 1)
    np.add.at(marks, begin, 1)
    np.add.at(marks, begin + width, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = text.split("\n")
    duplicates = 0
    if len(lines) > 1:
        live = [x for x in lines if x.strip(SPACES)]
        duplicates = len(live) - len(set(live))
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words)


def histograms(text: str, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of characters by class, and of common words with all others last."""
    classes = np.bincount(CLASS_OF[np.frombuffer(text.encode(), np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]
    common = np.zeros(N_WORDS, np.int64)
    get = PLACE.get
    found = [k for k in [get(w.lower()) if w.isalpha() else get(w.strip(EDGES).lower()) for w in words] if k is not None]
    if found:
        common += np.bincount(found, minlength=N_WORDS)
    common[-1] = len(words) - len(found)
    return classes, common


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the histogram p to each row of q."""
    p = p / p.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum((left + right) / 2, 0))


def base_failed(counts: Sequence[int], limits: RuleLimits) -> bool:
    return counts[0] < limits.min_words or 100 * counts[4] > limits.max_repeat_percent * counts[0]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What a document counts: `classes` has a 32-bit number a class, `common` pairs of a common word's place and its number, the rest last.
COUNTED_DDL = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS) + ", classes binary, common binary"
COUNTED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in COUNTS), ("classes", pa.binary()), ("common", pa.binary())])


def _counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:

        def rows(batch: pa.RecordBatch = batch) -> Iterator[tuple]:
            for doc_id, lang, text in zip(batch["doc_id"].to_pylist(), batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = WORD.findall(text)
                classes, common = histograms(text, words)
                found = np.flatnonzero(common)
                yield doc_id, lang, *base_counts(text, words), classes.astype("<u4").tobytes(), np.stack([found, common[found]]).astype("<u4").tobytes()

        yield from batches(rows(), COUNTED)


def counted(docs: DataFrame) -> DataFrame:
    """A short row for every document, as a table in the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_or_empty("text").alias("text"))
    return written(rows.mapInArrow(_counted, COUNTED_DDL), "counts")


def _histograms_of(classes: bytes, common: bytes) -> tuple[np.ndarray, np.ndarray]:
    words = np.zeros(N_WORDS, np.int64)
    at, n = np.frombuffer(common, "<u4").reshape(2, -1)
    words[at] = n
    return np.frombuffer(classes, "<u4").astype(np.int64), words


SUMS_DDL = "lang string, n long, classes array<double>, words array<double>"
SUMS = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("classes", pa.list_(pa.float64())), ("words", pa.list_(pa.float64()))])


def _sums(stream: Iterator[pa.RecordBatch], limits: RuleLimits) -> Iterator[pa.RecordBatch]:
    total: dict[str | None, list] = {}
    for batch in stream:
        for lang, n_words, n_repeat, of_classes, of_words in zip(*(batch[c].to_pylist() for c in ("lang", "n_words", "n_repeat_words", "classes", "common")), strict=True):
            if n_words < limits.min_common_words or 100 * n_repeat > limits.max_repeat_percent * n_words:
                continue
            classes, common = _histograms_of(of_classes, of_words)
            if classes.sum() < limits.min_class_chars:
                continue
            s = total.setdefault(lang, [0, np.zeros(N_CLASSES), np.zeros(N_WORDS)])
            s[0] += 1
            s[1] += classes / classes.sum()
            s[2] += common / common.sum()
    if total:
        rows = [(lang, n, classes.tolist(), words.tolist()) for lang, (n, classes, words) in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SUMS, strict=True)], schema=SUMS)


@dataclass(frozen=True)
class References:
    """Mean histograms, a row a language, and which rows a language's documents are held against."""

    classes: np.ndarray
    words: np.ndarray
    rows: dict[str | None, list[int]]


def language_references(counts: DataFrame, limits: RuleLimits = RuleLimits(), least_docs: int = 5, least_share: float = 0.001) -> References:
    """Mean histograms of each language over all documents that count, of the rows of `counted`: a few numbers a task, summed in Spark.

    Rounded, so that the order in which tasks end has no effect. A language has a reference
    from `least_docs` documents on. One with `least_share` of them is widespread: its
    reference serves the documents of all languages, as labels can be wrong. A row a language
    reaches the driver.
    """
    narrow = counts.select("lang", "n_words", "n_repeat_words", "classes", "common")
    sums = narrow.mapInArrow(lambda it: _sums(it, limits), SUMS_DDL)
    add = [F.sum(F.col("classes")[k]) for k in range(N_CLASSES)] + [F.sum(F.col("words")[k]) for k in range(N_WORDS)]
    total = sums.groupBy("lang").agg(F.sum("n"), F.array(*add)).where(F.col("sum(n)") >= least_docs).orderBy(F.desc("sum(n)"), "lang").collect()
    if not total:
        return References(np.zeros((0, N_CLASSES)), np.zeros((0, N_WORDS)), {})
    n = sum(r[1] for r in total)
    wide = [k for k, r in enumerate(total) if r[1] >= least_share * n]
    both = np.stack([np.round(np.array(r[2]) / r[1], 9) for r in total])
    classes, words = both[:, :N_CLASSES], both[:, N_CLASSES:]
    held = {r[0]: wide if k < len(wide) else [k, *wide] for k, r in enumerate(total)}
    return References(classes / classes.sum(axis=1, keepdims=True), words / words.sum(axis=1, keepdims=True), held)


VERDICT_DDL = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, class_distance double, word_distance double"
VERDICT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("class_distance", pa.float64()), ("word_distance", pa.float64())])


def _verdicts(stream: Iterator[pa.RecordBatch], references: References, limits: RuleLimits) -> Iterator[pa.RecordBatch]:
    held = {lang: (references.classes[at], references.words[at]) for lang, at in references.rows.items()}
    for batch in stream:

        def rows(batch: pa.RecordBatch = batch) -> Iterator[tuple]:
            for doc_id, lang, *counts, of_classes, of_words in zip(*(batch[c].to_pylist() for c in COUNTED.names), strict=True):
                failed = base_failed(counts, limits)
                classes, common = _histograms_of(of_classes, of_words)
                by_class = by_word = None
                own = held.get(lang)
                if own and classes.sum() >= limits.min_class_chars:
                    by_class = round(float(distance(classes, own[0]).min()), 6)
                if own and counts[0] >= limits.min_common_words:
                    by_word = round(float(distance(common, own[1]).min()), 6)
                kept = not failed and (by_class or 0) <= limits.max_class_distance and (by_word or 0) <= limits.max_word_distance(counts[0])
                yield doc_id, *counts, failed, kept, by_class, by_word

        yield from batches(rows(), VERDICT)


def rule_verdicts(docs: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """The base counts and the verdict of every document; one pass over the texts, no shuffle."""
    counts = counted(docs)
    references = language_references(counts, limits)
    return counts.mapInArrow(lambda it: _verdicts(it, references, limits), VERDICT_DDL)
