"""Token ids of a ``tokenizers`` file with word ends, one word at a time.

The tokenizer's pattern never matches across white space, so the ids of a text are those of
its words in order. Words repeat, so each process keeps the ids of words it has seen, up to a
bound; words of Latin letters with or without punctuation behind go straight to the merge
table, all others through the whole tokenizer.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

MOST_WORDS = 400_000


class WordIds(dict):
    """ids of a word (UTF-8 bytes) as little-endian 16-bit numbers, found on first use."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.letters = byte_letters()
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

    def __missing__(self, word: bytes) -> bytes:
        ids = self._ids(word.decode())
        value = np.array(ids, "<u2").tobytes()
        self[word] = value
        return value

    def _ids(self, word: str) -> list[int]:
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        if "<|" in word:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        low = word.lower()
        units = [low] if low.isalpha() else self.units.findall(low)
        return [t.id for u in units for t in self.model.tokenize(u.encode().decode("latin-1").translate(self.letters))]

    def text_ids(self, text: str) -> np.ndarray:
        if len(self) > MOST_WORDS:
            self.clear()
        # bytes.split() cuts at ASCII white space alone.
        return np.frombuffer(b"".join(map(self.__getitem__, text.encode().split())), "<u2")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@functools.cache
def word_ids(path: str) -> WordIds:
    """One per process and file."""
    return WordIds(path)
