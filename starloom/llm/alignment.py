"""Alignment of two tokenizations by merge paths over the byte ends of their tokens.

Tokenizer A reads a space and the text, tokenizer B adds that space itself, so the tokens of
both cover the same bytes. Their ends, those of a whole slice of documents in one ascending
sequence each, are merged. Binary searches along the diagonals of the merge grid cut the merge
into pieces of equal work, whatever the lengths of the documents; each piece is merged on its
own. Every new end closes one overlap of an A and a B token, an end of both closes a group as
well; ends met at the border of two pieces are stitched, and the pieces' group counts run on by
a prefix sum.

No token of either kind reaches from a character that is no white space into a following
space or line feed, so texts are cut there into units. Each process keeps the ids of units it
has seen.

Counts of id pairs are added up per block, then over the corpus; the sums come back to the
documents through the dictionaries of their blocks.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import blocks
from starloom.llm.common import id_of, in_tasks, pieces_of, stored, text_rows
from starloom.llm.tokens import byte_letters

WORK = 4096
MOST_UNITS = 400_000
LONGEST_KEPT = 64
MARK = "▁"
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
# Fixed value: the pattern of byte-level tokenizers.
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SEPARATORS = np.frombuffer(b",|;", np.uint8)
_NOTHING = 3


class _APieces(dict):
    """Ids (16-bit numbers in bytes) of tokenizer A's own pre-tokens, found on first use."""

    def __init__(self, model, letters: dict[int, str]):
        super().__init__()
        self.model, self.letters = model, letters

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode().decode("latin-1").translate(self.letters)
        value = array("H", [t.id for t in self.model.tokenize(raw)]).tobytes()
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_UNITS:
                self.clear()
            self[piece] = value
        return value


class Units(dict):
    """(A ids, B ids, whether both spell the unit) of a unit, found on first use.

    A unit is written without its leading space, except where white space follows that; ids
    are 16-bit numbers in bytes.
    """

    def __init__(self, a_path: str, b_path: str):
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        super().__init__()
        a = Tokenizer.from_file(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        n_a, n_b = a.get_vocab_size(with_added_tokens=True), self.b.vocab_size()
        if max(n_a, n_b) > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        if a.normalizer is not None or not str(a.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False"):
            raise ValueError("tokenizer A is no plain byte-level one")
        letters = byte_letters()
        self.cut = regex.compile(A_PATTERN).findall
        # The model alone knows no special strings: in a text they are ordinary text.
        self.a = _APieces(a.model, letters)
        known = {c: b for b, c in letters.items()}
        names = {i: p for p, i in a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [_spelled(names.get(i, ""), known) for i in range(n_a)]
        self.b_bytes = [self._piece(i) for i in range(n_b)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        if any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces reach over spaces or lines, so a text cannot be cut into units")
        self.space = self.b.piece_to_id(MARK)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        if self.b.is_control(i):
            return b""
        return self.b.id_to_piece(i).replace(MARK, " ").encode()

    def __missing__(self, unit: str) -> tuple[bytes, bytes, bool]:
        whole = unit if unit[0] in " \n" else " " + unit
        a = b"".join(map(self.a.__getitem__, self.cut(whole)))
        # B adds a space: it stands for the unit's own, or goes again before a line feed.
        if whole == " ":
            b = [self.space]
        elif whole[0] == "\n":
            b = self.b.encode(whole)[1:]
        else:
            b = self.b.encode(whole[1:])
        spelled = [b"".join(map(table.__getitem__, ids)) for table, ids in
                   ((self.a_bytes, array("H", a)), (self.b_bytes, b))]
        value = a, array("H", b).tobytes(), spelled[0] == whole.encode() == spelled[1]
        if len(unit) <= LONGEST_KEPT:
            if len(self) >= MOST_UNITS:
                self.clear()
            self[unit] = value
        return value

    def ids(self, text: str) -> tuple[bytes, bytes]:
        """Ids of A and of B; none where a side does not spell the text."""
        if not text:
            return b"", b""
        if " ".join(text.split()) == text.replace("\n", " "):
            found = text.replace("\n", " \n").split(" ")  # white space stands alone everywhere
        else:
            found = [u[1:] if u[0] == " " and u[1:2] not in ("", " ", "\n") else u for u in _CUT.split(" " + text)]
        a, b, same = zip(*map(self.__getitem__, found))
        # A unit spelled otherwise is not made up for by the next, which begins with white space.
        return (b"".join(a), b"".join(b)) if all(same) else (b"", b"")


def _spelled(entry: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()


@functools.cache
def units(a_path: str, b_path: str) -> Units:
    """One per process and pair of files."""
    return Units(a_path, b_path)


# --- merge paths ----------------------------------------------------------------------


def merge_paths(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending sequences crosses each diagonal: (places in a, in b).

    Diagonals lie ``work`` elements apart, the last one at the end. Of equal values those of
    ``a`` go first. All diagonals are searched side by side.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        before = a[middle] <= b[diagonal[open_] - 1 - middle]
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]
        open_ = open_[low[open_] < high[open_]]
    return low, diagonal - low


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """(a token, b token, closes) of every overlap of two tokenizations, in order.

    ``a`` and ``b`` are the ascending ends of tokens that cover the same bytes; ``closes`` tells
    the overlaps that end where an A and a B token both end. Tokens hold a byte at least.
    """
    total = len(a) + len(b)
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    i, j = merge_paths(a, b, work)
    # One row per piece, its part of A and then its part of B; each row is merged on its own.
    rows = np.full((len(i) - 1, work), np.iinfo(np.int64).max)
    for ends, at, kind in ((a, i, 0), (b, j, 1)):
        many = np.diff(at)
        piece = np.repeat(np.arange(len(many)), many)
        column = np.arange(len(ends)) - np.repeat(at[:-1], many) + (np.diff(i)[piece] if kind else 0)
        rows[piece, column] = ends * 2 + kind
    rows.sort(axis=1, kind="stable")
    merged = rows.ravel()[:total]
    ends, from_b = merged >> 1, merged & 1
    # Inside a row an end is new if the one before differs; a row's first is stitched to the
    # last of the row before.
    new = np.ones((len(rows), work), bool)
    values = rows >> 1
    new[:, 1:] = values[:, 1:] != values[:, :-1]
    new[1:, 0] = values[1:, 0] != values[:-1, -1]
    new = new.ravel()[:total]
    at = np.flatnonzero(new)
    b_before = np.cumsum(from_b) - from_b
    of_b = b_before[at]
    follows = np.append(at[1:], total) - at  # two ends in one place: one of A, one of B
    return at - of_b, of_b, follows == 2


def group_texts(a_ids, b_ids, a_ends, b_ends, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3`` for all groups, and where each group's text ends.

    ``a_ends`` and ``b_ends`` are the tokens up to the end of each group; a group marked in
    ``last`` has no mark behind it.
    """
    n_a, n_b = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    place_a = np.arange(len(a_ids)) + np.repeat(b_ends - n_b, n_a)
    place_b = np.arange(len(b_ids)) + np.repeat(a_ends, n_b)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[place_a], ids[place_b] = a_ids, b_ids
    mark = np.zeros(len(ids), np.uint8)
    mark[place_a[a_ends - 1]] = 1
    mark[place_b[b_ends - 1]] = np.where(last, _NOTHING, 2)
    digits, width = _digits()
    text = np.empty((len(ids), digits.shape[1] + 1), np.uint8)
    text[:, :-1] = digits[ids]
    size = width[ids]
    text[np.arange(len(ids)), size] = np.append(_SEPARATORS, 0)[mark]
    size = size + (mark != _NOTHING)
    ends = np.cumsum(size)[place_b[b_ends - 1]]
    return text[np.arange(text.shape[1]) < size[:, None]], ends


@functools.cache
def _digits() -> tuple[np.ndarray, np.ndarray]:
    names = [str(i).encode() for i in range(1 << 16)]
    return (np.frombuffer(b"".join(n.ljust(5) for n in names), np.uint8).reshape(-1, 5),
            np.array([len(n) for n in names], np.int64))


_MEASURES = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def aligned(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(key, text) rows as blocks of id-pair frequencies, with each document's own figures."""
    measures = [(m, pa.int64()) for m in _MEASURES[:-1]] + [(_MEASURES[-1], pa.string())]

    def work(batches):
        known = units(a_path, b_path)
        out = blocks.Blocks(pa.int64(), measures)
        for batch in batches:
            for part in pieces_of(batch, "text", blocks.SLICE_BYTES):
                yield from _block(part, known, out)

    return in_tasks(rows, work, blocks.LAYOUT.format("long")
                    + ", key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")


def _block(part: pa.RecordBatch, known: Units, out: blocks.Blocks):
    found = [known.ids(t) for t in part.column(1).to_pylist()]
    a_ids, b_ids = (np.frombuffer(b"".join(f[side] for f in found), "<u2").astype(np.int64) for side in (0, 1))
    n_a, n_b = (np.array([len(f[side]) // 2 for f in found], np.int64) for side in (0, 1))
    del found
    of_a, of_b, closes = overlaps(np.cumsum(known.a_sizes[a_ids]), np.cumsum(known.b_sizes[b_ids]))
    owner = np.repeat(np.arange(len(n_a)), n_a)[of_a]
    n_links = np.bincount(owner, minlength=len(n_a))
    n_groups = np.bincount(owner[closes], minlength=len(n_a))
    digests = [""] * len(n_a)
    if len(owner):
        closing = owner[closes]
        text, ends = group_texts(a_ids, b_ids, of_a[closes] + 1, of_b[closes] + 1,
                                 np.append(np.diff(closing) != 0, True))
        text = memoryview(text)
        at = 0
        for d, end in zip(np.flatnonzero(n_groups), ends[np.cumsum(n_groups)[n_groups > 0] - 1]):
            digests[d] = hashlib.sha256(text[at:end]).hexdigest()
            at = end
    pairs, which, often = np.unique((a_ids[of_a] << 16) | b_ids[of_b], return_inverse=True, return_counts=True)
    yield out.documents(*blocks.frequencies(owner, which, len(pairs), len(n_a)),
                        [part.column(0), n_a, n_b, n_groups, n_links, digests])
    yield from out.dictionary(pairs, often)


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): links of every id pair, and whether no other A id has more with its B id.

    The highest counts are one row per B id, so at most the size of its vocabulary.
    """
    total = stored(blocks.weighted_entries(found).groupBy("entry").agg(F.sum("weight").alias("n")))
    total = total.select("entry", F.shiftright("entry", 16).alias("a"),
                         F.col("entry").bitwiseAND((1 << 16) - 1).alias("b"), "n")
    highest = total.groupBy("b").agg(F.max("n").alias("most"))
    return total.join(F.broadcast(highest), "b").select("entry", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _score(often, values):
    return [int(often @ values[1]), int(often @ values[0])]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its tokens, groups and links, and how its links score.

    n_best counts links whose id pair is the most frequent of its B id in the corpus, ties
    included; count_sum adds the corpus counts of all links. A text that is null or empty, or
    that a tokenizer does not spell exactly, has zeros and an empty groups_sha256; a null id
    stays null; rows that repeat an id count each, also in the corpus; other columns are passed
    over; an empty table gives no rows.
    """
    found = stored(aligned(text_rows(docs, id_col, text_col), a_path, b_path))
    counts = stored(pair_counts(found).select("entry", "n", F.col("best").cast("long").alias("best")))
    values = blocks.entries(found).join(counts, "entry")
    scored = blocks.with_values(
        found, values, ["n", "best"], _MEASURES, _score,
        "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return scored.withColumn("key", id_of(F.col("key"))).withColumnRenamed("key", "doc_id")
