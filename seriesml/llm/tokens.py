"""Token ids of whole texts with a public tokenizer file."""

from __future__ import annotations

import functools
import re

import numpy as np
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Words kept between batches in a Python worker, about 100 MB; then the memory starts anew.
CACHED_WORDS = 500_000
# What the word tokenizer's own pattern cuts a lower-case word of these characters into (fixed values of its file): printable
# ASCII and the composed letters of Latin-1, which no normalisation changes. Words with other characters are asked whole.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_PLAIN = re.compile(r"[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Memory(dict):
    """Word to ids as little-endian unsigned 32-bit integers; unknown words go to the tokenizer."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        made = self[word] = self.make(word)
        return made


class Encoder:
    """Encodes texts word by word and remembers words: the tokenizer never joins across a blank or a line end.

    That holds when the file's normaliser works within words and its pre-tokenizer drops white space, which is checked
    by the pattern; any other file is asked text by text.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _WORD_PATTERN in _patterns(self.tokenizer)
        self.model = self.tokenizer.model
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = _Memory(self._piece)
        self.words = _Memory(self._word)

    def _asked(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else self.bytes.pre_tokenize_str(piece)[0][0]
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(word.lower())))
        return self._asked(word)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, four bytes each."""
        if not self.by_word:
            return self._asked(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def forget(self) -> None:
        """Empties the memory, for a worker that goes on to other work."""
        self.words.clear()
        self.pieces.clear()

    def trim(self) -> None:
        """To be called between batches: bounds the memory."""
        for memory in (self.words, self.pieces):
            if len(memory) > self.cached:
                memory.clear()


def _packed(ids) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def _patterns(tokenizer) -> list[str]:
    import json
    found, todo = [], [json.loads(tokenizer.to_str()).get("pre_tokenizer") or {}]
    while todo:
        node = todo.pop()
        todo += node.get("pretokenizers") or []
        pattern = node.get("pattern")
        if isinstance(pattern, dict) and node.get("behavior") == "Removed" and node.get("invert"):
            found += [v for v in pattern.values() if isinstance(v, str)]
    return found


@functools.lru_cache(maxsize=4)
def encoder(path: str, cached: int = CACHED_WORDS) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path, cached)
