"""SentencePiece encoding and decoding by a merge-type prefix table.

In a merge vocabulary the encoding of a text is the one sequence whose neighbouring
tokens are all compatible: u, t are compatible if the text of u followed by t encodes
to u, t. So every prefix has a unique last token: among the vocabulary's matches that
end there (from an automaton), the one compatible with the last token of the prefix
before it. The table is filled from the left and the ids are read from it backwards.

Two characters that stand together in no token are never merged. No token has a
white-space mark behind another character, and none has, for instance, a comma behind a
letter; so a text falls into runs that begin at marks and at such punctuation, each
encoded on its own and kept in a cache of bounded bytes.

Defined cases: null text counts as empty and has no ids; characters outside the
vocabulary become their UTF-8 bytes' ids; repeated rows are all returned; texts and runs
of any length are encoded whole (the table of a run is as long as the run); an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import text_or_empty
from quernstone.llm.tokens import ByteCache

MARK = "▁"
_LOADED: dict[str, PieceTokens] = {}


class PieceTokens:
    MOST_PAIRS = 400_000

    def __init__(self, path: str, cache_bytes: int = 128 << 20):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.surface: list[str | int | None] = []  # of each id: text, a byte, or None for none
        self.unknown = " ⁇ "
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(int(piece[3:5], 16))
            elif model.is_unknown(i):
                self.surface.append(self.unknown)
            elif model.is_control(i):
                self.surface.append(None)
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.surface.append(piece.replace(MARK, " "))
        if any(MARK in p.lstrip(MARK) for p in self.ids) or len(self.bytes) != 256:
            raise ValueError("the vocabulary has pieces across white space, or no bytes")
        if model.encode("  a") != self._library_way(MARK * 3 + "a"):
            raise ValueError("the model does not keep white space as it is, with one mark before the text")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i, self._merged(list(piece)) == [piece]))
        self.automaton.make_automaton()
        self.names = {i: p for p, i in self.ids.items()}
        self.known = frozenset(p for p in self.ids if len(p) == 1)  # other characters are never part of a merge
        inside = "".join(map(re.escape, sorted(self.known)))
        self.known_parts = re.compile(f"[{inside}]+|[^{inside}]+")
        self.pairs: dict[int, bool] = {}
        self.cache = ByteCache(self._joined, cache_bytes)
        self.odd: dict[str, str] = {}  # decoded text of the runs that do not come back as they were
        self.run = self._run_pattern()

    def _run_pattern(self) -> re.Pattern:
        """Runs begin at white-space marks, and at characters that stand in no token behind anything but marks and such characters."""
        before: dict[str, set[str]] = {c: set() for c in self.known if not (c.isalpha() or c.isdecimal() or c == MARK)}
        for piece in self.ids:
            for x, y in zip(piece, piece[1:], strict=False):
                if y in before:
                    before[y].add(x)
        cutting = set(before)
        while True:
            wrong = {c for c in cutting if before[c] - cutting - {MARK}}
            if not wrong:
                break
            cutting -= wrong
        c = "".join(map(re.escape, sorted(cutting)))
        return re.compile(f"{MARK}*[^{MARK}{c}]+|{MARK}*[{c}]+[^{MARK}{c}]*|{MARK}+" if c else f"{MARK}*[^{MARK}]+|{MARK}+")

    @classmethod
    def load(cls, path: str) -> PieceTokens:
        """One instance a worker process."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merging by score, the leftmost of equals first; for pairs of tokens only."""
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                s = self.score.get(symbols[k] + symbols[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _library_way(self, run: str) -> list[int]:
        return [i for s in self._merged(list(run)) for i in ([self.ids[s]] if s in self.ids else [self.bytes[b] for b in s.encode()])]

    def _pair(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their text is encoded."""
        a, b = self.names[left], self.names[right]
        known = self._merged(list(a + b)) == [a, b]
        if len(self.pairs) >= self.MOST_PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = known
        return known

    def _tokens(self, run: str) -> list[int]:
        """The ids of a run of known characters, by the table of last tokens."""
        last = [-1] * len(run)
        pairs, pair = self.pairs, self._pair
        for end, (length, token, whole) in self.automaton.iter(run):
            if last[end] >= 0:
                continue
            before = end - length
            if before < 0:
                if whole:
                    last[end] = token
            elif (u := last[before]) >= 0:
                known = pairs.get(u << 32 | token)
                if known or (known is None and pair(u, token)):
                    last[end] = token
        out, end = [], len(run) - 1
        while end >= 0:
            token = last[end]
            if token < 0:
                raise ValueError(f"no token ends at {end} of {run!r}")
            out.append(token)
            end -= len(self.names[token])
        return out[::-1]

    def run_ids(self, run: str) -> list[int]:
        if self.known.issuperset(run):
            return self._tokens(run)
        out: list[int] = []
        for part in self.known_parts.findall(run):
            out += self._tokens(part) if part[0] in self.known else [self.bytes[b] for b in part.encode()]
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes that are no UTF-8 become U+FFFD each, and the mark before the text goes."""
        out: list[str] = []
        held = bytearray()
        for i in ids:
            s = self.surface[i]
            if isinstance(s, int):
                held.append(s)
                continue
            if held:
                out.append(_utf8(held))
                held = bytearray()
            if s is not None:
                out.append(s)
        if held:
            out.append(_utf8(held))
        text = "".join(out)
        return text[1:] if ids and text.startswith(" ") and self._first_is_mark(ids) else text

    def _first_is_mark(self, ids: list[int]) -> bool:
        for i in ids:
            if self.surface[i] is not None:
                return isinstance(self.surface[i], str) and self.surface[i] != self.unknown
        return False

    def _joined(self, run: str) -> str:
        """The decimal ids of a run, joined by commas. They are decoded as well; runs that come back as they were need no entry of their own for that."""
        ids = self.run_ids(run)
        decoded = self.decode([self.ids[MARK], *ids])
        if decoded != run.replace(MARK, " "):
            self.odd[run] = decoded
        return ",".join(map(str, ids))

    def joined(self, text: str) -> tuple[str, str]:
        """The decimal ids of a text joined by commas, and the text that they decode to."""
        if not text:
            return "", ""
        runs = self.run.findall(MARK + text.replace(" ", MARK))
        ids = ",".join(map(self.cache.__getitem__, runs))
        if self.odd and not self.odd.keys().isdisjoint(runs):
            return ids, "".join([self.odd.get(r) or r.replace(MARK, " ") for r in runs])[1:]
        return ids, text.replace(MARK, " ")

    def encode(self, text: str) -> list[int]:
        ids, _ = self.joined(text)
        return [int(i) for i in ids.split(",")] if ids else []


def _utf8(held: bytearray) -> str:
    """Python replaces a broken sequence as a whole; here every byte of it is replaced by itself."""
    out, k = [], 0
    while k < len(held):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(held[k : k + n]).decode())
                k += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


DIGEST_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
IDS_DDL = "doc_id long, ids array<int>, decoded string"
IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _digests(stream: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = PieceTokens.load(path)
    for batch in stream:
        n, ids, decoded = [], [], []
        for text in batch["text"].to_pylist():
            joined, back = tokens.joined(text)
            n.append(joined.count(",") + 1 if joined else 0)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded.append(hashlib.sha256(back.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], schema=DIGEST)


def _ids(stream: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = PieceTokens.load(path)
    for batch in stream:
        ids = [tokens.encode(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array([tokens.decode(i) for i in ids], pa.string())], schema=IDS)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids, decoded of every document; no shuffle."""
    return _input(docs).mapInArrow(lambda it: _ids(it, model_path), IDS_DDL)


def encoding_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: of the ids and decoded texts, without moving these."""
    return _input(docs).mapInArrow(lambda it: _digests(it, model_path), DIGEST_DDL)
