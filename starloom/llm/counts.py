"""Token counts without token ids: pieces counted once per distinct pre-token.

Each document becomes frequencies of its pre-tokens over the dictionary of its block. The
distinct pre-tokens of all blocks are counted once each, the counts are joined to the blocks'
dictionaries, and a document's tokens are the sum of frequency times pieces.

A pre-token is what the tokenizer's own normalizer and pattern make of a text, written in the
letters of byte-level vocabularies. The pattern drops white space, so no pre-token reaches from
one word (a run without ASCII white space) into the next. Words of Latin-1 letters are lowered
and cut here by the same pattern; any other word goes through the library's normalizer and
pattern. A special string inside a word is a pre-token of its own, marked by a blank before it.
"""

from __future__ import annotations

import functools
import itertools
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import blocks
from starloom.llm.common import id_of, in_tasks, pieces_of, stored, text_rows
from starloom.llm.tokens import byte_letters

LIMIT = 2048
FULL = 1 << 18  # pre-tokens in the dictionary of a block
BLANK = " "


class PreTokens:
    """Cuts words into pre-tokens, and counts the pieces of a pre-token."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.normalizer, self.cutter, self.model = (
            self.library.normalizer, self.library.pre_tokenizer, self.library.model)
        if self.cutter is None or self.cutter.pre_tokenize_str(" a  b ") != [("a", (1, 2)), ("b", (4, 5))]:
            raise ValueError("the pattern keeps white space, so a text cannot be cut into words")
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.letters = byte_letters()

    def cut(self, word: str) -> tuple[str, ...]:
        if self.special is None or not self.special.search(word):
            return self._plain(word)
        parts = self.special.split(word)  # special strings at odd places
        return tuple(itertools.chain.from_iterable(
            (BLANK + part,) if i % 2 else self._plain(part) for i, part in enumerate(parts) if part))

    def _plain(self, word: str) -> tuple[str, ...]:
        try:
            word.encode("latin-1")
        except UnicodeEncodeError:
            text = self.normalizer.normalize_str(word) if self.normalizer else word
            return tuple(t for t, _ in self.cutter.pre_tokenize_str(text))
        low = word.lower()
        if low.isalpha():
            return (low if low.isascii() else self._lettered(low),)
        return tuple(map(self._lettered, self.units.findall(low)))

    def _lettered(self, unit: str) -> str:
        return unit.encode().decode("latin-1").translate(self.letters)

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token[0] == BLANK else len(self.model.tokenize(pre_token))


@functools.cache
def pre_tokens(path: str) -> PreTokens:
    """One per process and file."""
    return PreTokens(path)


class _Numbers(dict):
    """Consecutive numbers of values, given on first use."""

    def __missing__(self, value):
        self[value] = n = len(self)
        return n


class _Dictionary:
    """The words and pre-tokens of a block so far, each with its number."""

    def __init__(self, known: PreTokens):
        self.known, self.words, self.places = known, _Numbers(), _Numbers()
        self.flat, self.begin = array("q"), array("q", [0])  # pre-tokens of word i: flat[begin[i]:begin[i + 1]]

    def occurrences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, pre-token) of every occurrence, as numbers."""
        # bytes.split() cuts at ASCII white space alone.
        found = [np.fromiter(map(self.words.__getitem__, text.encode().split()), np.int64) for text in texts]
        for word in itertools.islice(self.words, len(self.begin) - 1, None):
            self.flat.extend(map(self.places.__getitem__, self.known.cut(word.decode())))
            self.begin.append(len(self.flat))
        begin, flat = np.array(self.begin), np.array(self.flat)
        word = np.concatenate(found)
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        # Every occurrence of a word stands for its pre-tokens.
        many = begin[word + 1] - begin[word]
        nth = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(owner, many), flat[np.repeat(begin[word], many) + nth]


def frequencies(rows: DataFrame, path: str) -> DataFrame:
    """(key, text) rows as blocks of pre-token frequencies, with each text's UTF-8 bytes."""
    measures = [("key", pa.int64()), ("n_bytes", pa.int64())]

    def work(batches):
        known = pre_tokens(path)
        out = blocks.Blocks(pa.string(), measures)
        held = _Dictionary(known)
        for batch in batches:
            for part in pieces_of(batch, "text", blocks.SLICE_BYTES):
                owner, at = held.occurrences(part.column(1).to_pylist())
                yield out.documents(
                    *blocks.frequencies(owner, at, len(held.places), part.num_rows),
                    [part.column(0), pc.binary_length(part.column(1)).cast(pa.int64())])
                if len(held.places) >= FULL:
                    yield from out.dictionary(list(held.places))
                    held = _Dictionary(known)
        yield from out.dictionary(list(held.places))

    return in_tasks(rows, work, blocks.LAYOUT.format("string") + ", key long, n_bytes long")


def piece_counts(found: DataFrame, path: str) -> DataFrame:
    """(entry, pieces) of each distinct pre-token."""
    def work(batches):
        known = pre_tokens(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([known.pieces(p) for p in batch.column(0).to_pylist()], pa.int64())],
                ["entry", "pieces"])

    return in_tasks(found.select("entry").distinct(), work, "entry string, pieces long")


def _sum(times, values):
    return [int(times @ values[0])]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Equal to the length of the library's encoding without added tokens. A null text counts as
    empty, and an empty one has no tokens; a null id stays null; rows that repeat an id are
    counted each; other columns are passed over; an empty table gives no rows.
    """
    rows = stored(frequencies(text_rows(docs, id_col, text_col), tokenizer_path))
    found = blocks.entries(rows)
    pieces = stored(piece_counts(found, tokenizer_path))
    # Stored, so that the shuffle of the entries is gone before that of the documents begins.
    values = stored(found.join(pieces, "entry").select("block", "place", "pieces"))
    counted = blocks.with_values(rows, values, ["pieces"], ["key", "n_bytes"], _sum,
                                 "key long, n_bytes long, n_tokens long")
    return counted.select(id_of(F.col("key")).alias("doc_id"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
