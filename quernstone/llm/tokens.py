"""Token ids with a word-level cache, for tokenizers that never merge across white space."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


def _byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: itself where it prints, else the next from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}


BYTE_SYMBOLS = _byte_symbols()
_LOADED: dict[str, WordTokens] = {}


class ByteCache(dict):
    """Values by text, made where there is none yet, within about `limit` bytes.

    Two generations: when the younger, this dictionary itself, is full, the older is dropped,
    and what is used meanwhile moves up, so it lives on. Texts of over `longest` characters
    are not kept.
    """

    ENTRY = 230  # two objects' heads and their place in the dictionary

    def __init__(self, make: Callable, limit: int, longest: int = 64):
        super().__init__()
        self.make, self.half, self.longest, self.used = make, limit // 2, longest, 0
        self.old: dict = {}

    def __missing__(self, key: str):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        self.used += self.ENTRY + 2 * len(key) + len(value)
        if self.used > self.half:
            self.old, self.used = dict(self), 0
            self.clear()
        self[key] = value
        return value


class KeepingCache(ByteCache):
    """A cache whose values that were used again after a generation stay in the younger one, up to `share` of it, so that common words are not moved up in each."""

    def __init__(self, make: Callable, limit: int, longest: int = 64, share: float = 0.3):
        super().__init__(make, limit, longest)
        self.kept, self.kept_used, self.most = {}, 0, share * self.half

    def __missing__(self, key: str):
        value = self.old.pop(key, None)
        again = value is not None
        if not again:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        size = self.ENTRY + 2 * len(key) + len(value)
        if again and self.kept_used + size <= self.most:
            self.kept[key] = value
            self.kept_used += size
        self.used += size
        if self.used > self.half:
            self.old, self.used = dict(self), self.kept_used
            self.clear()
            self.update(self.kept)
        self[key] = value
        return value


class WordTokens:
    """Ids of whole texts, as the tokenizers library gives them.

    The pre-tokenizer drops white space and splits there, its normaliser acts on single
    characters and combining sequences, and neither spans a blank, tab or line end. In a
    text of ASCII and Latin-1 letters the normaliser only lower-cases, so it is split into
    words by the tokenizer file's own pattern, narrowed to these characters, and new words
    go to the library's model. Any other text is cut at blanks, tabs and line ends, and those
    of its pieces that have other characters go through the whole library. Ids are kept
    packed, by word and by piece, in caches of bounded bytes.
    """

    SPACE = re.compile("[^ \t\n\r]+")
    PLAIN = re.compile("[\t\n\r\x20-\x7e\u00c0-\u00ff]*")
    #: What the classes of the pattern are among plain characters.
    CLASSES = {r"\p{L}": "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"\p{N}": "0-9", r"\s": r"\t\n\r "}

    def __init__(self, path: str, cache_bytes: int = 96 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = ByteCache(self._piece, cache_bytes // 8)
        self.words = KeepingCache(self._word, cache_bytes - cache_bytes // 8)
        vocabulary = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.pattern = self._pattern()
        self.added = tuple({t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.dtype = np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    @classmethod
    def load(cls, path: str) -> WordTokens:
        """One instance a worker process."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        of_word, of_piece = self.words.__getitem__, self.pieces.__getitem__
        for text in texts:
            found = map(of_word, self.pattern.findall(text.lower())) if self._plain(text) else map(of_piece, self.SPACE.findall(text))
            yield np.frombuffer(b"".join(found), self.dtype)

    def _plain(self, text: str) -> bool:
        return self.pattern is not None and self.PLAIN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def _pattern(self) -> re.Pattern | None:
        """The split pattern for plain characters, if the file's steps are those that the short way relies on."""
        spec = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if normal != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            return None
        if steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
            return None
        pattern = steps[0]["pattern"]["Regex"]
        for name, characters in self.CLASSES.items():
            pattern = pattern.replace(name, characters)
        if r"\p" in pattern or "(?" in pattern:
            return None
        return re.compile(pattern)

    def _word(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(BYTE_SYMBOLS))]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self._plain(piece):
            return b"".join(map(self.words.__getitem__, self.pattern.findall(piece.lower())))
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, self.dtype).tobytes()
