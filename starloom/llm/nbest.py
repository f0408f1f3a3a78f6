"""N-best segmentation over the pieces of a SentencePiece model, and back to text.

A text's lattice has an edge for every piece that matches, with the piece's score; a character
that is no piece of its own is spelled in byte pieces at the price of an unknown one. The score
of a segmentation is the sum over its edges. Forward Viterbi scores are the exact value of the
best way to reach a position, so a backward A-star search with them as heuristics returns
segmentations in the order of their scores.

No piece crosses from other characters into a space mark or a line feed, so the lattice of a
text is a chain of the lattices of its units. Each unit's best score and the loss of its second
best (from the two best ways to each position) are kept per process, up to a bound. The n best of a
text can differ from its best only in the n - 1 units with the smallest losses: A-star runs
there alone, and their lists are merged.

Spaces become the mark U+2581, with one before the text; a literal U+2581 is spelled in bytes,
so each segmentation decodes to the text it came from.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import operator
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import as_batch, id_of, in_tasks, pieces_of, text_rows

MARK = "▁"
_LITERAL = "\ud800"  # stands for a literal mark; cannot occur in a valid text
UNKNOWN_LOSS = 10.0
MOST_UNITS = 1_200_000
N_BEST = 4
_NOTHING = (0.0, None, None)


class _Known(dict):
    """(best score, loss of the second best, ids) of units, found on first use."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, unit: str) -> tuple[float, float, bytes]:
        found = self[unit] = self.pieces._learn(unit)
        return found


class Pieces:
    """The pieces of one model and the units seen so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, tuple[int, float]] = {}
        self.raw: list[bytes] = []
        self.bytes = [-1] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.scores[piece] = (i, model.get_score(i))
                self.raw.append(piece.replace(MARK, " ").encode())
        if -1 in self.bytes:
            raise ValueError("the model has no byte pieces to spell unknown characters with")
        if len(self.raw) > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.sizes = np.array([len(r) for r in self.raw], np.int64)
        self.longest = max(map(len, self.scores))
        real = [s for _, s in self.scores.values() if s > -1e5]
        self.unknown = min(real) - UNKNOWN_LOSS
        if any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in self.scores):
            raise ValueError("pieces cross spaces or lines: a text cannot be cut into units")
        self.units = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.pairs = {p[k:k + 2] for p in self.scores for k in range(len(p) - 1)}
        # Pieces by their characters: (score, id or None for what only begins a piece, next characters or None).
        self.first: dict[str, tuple] = {}
        self._grow(self.first, sorted(self.scores), 0)
        self.known = _Known(self)

    def _grow(self, into: dict[str, tuple], pieces: list[str], depth: int) -> None:
        """Fill ``into`` with the characters that follow the first ``depth`` of ``pieces`` (sorted)."""
        for char, group in itertools.groupby(pieces, lambda p: p[depth]):
            same = list(group)
            own = same.pop(0) if len(same[0]) == depth + 1 else None
            after = None
            if same:
                self._grow(after := {}, same, depth + 1)
            number, score = self.scores[own] if own else (None, 0.0)
            into[char] = score, None if own is None else number.to_bytes(2, "little"), after

    def edges(self, unit: str) -> list[list[tuple]]:
        """By start: (end, score, ids) of every edge, in order of length."""
        out, n, scores = [], len(unit), self.scores
        for i in range(n):
            here = []
            for j in range(i + 1, min(n, i + self.longest) + 1):
                found = scores.get(unit[i:j])
                if found:
                    here.append((j, found[1], (found[0],)))
                elif j == i + 1:
                    spelled = (MARK if unit[i] == _LITERAL else unit[i]).encode()
                    here.append((j, self.unknown, tuple(self.bytes[b] for b in spelled)))
            out.append(here)
        return out

    @staticmethod
    def forward(edges: list[list[tuple]]) -> tuple[list[float], list]:
        """Best score up to each position, and the edge it comes by."""
        n = len(edges)
        best, by = [0.0] + [-np.inf] * n, [None] * (n + 1)
        for i, here in enumerate(edges):
            base = best[i]
            for edge in here:
                value = base + edge[1]
                if value > best[edge[0]]:
                    best[edge[0]] = value
                    by[edge[0]] = (i, edge)
        return best, by

    def n_best(self, unit: str, n: int) -> list[tuple[float, bytes]]:
        """The n best (score, ids as 16-bit numbers) of one unit, by A-star from its end."""
        edges = self.edges(unit)
        ahead, _ = self.forward(edges)
        into: list[list[tuple]] = [[] for _ in range(len(unit) + 1)]
        for i, here in enumerate(edges):
            for j, score, ids in here:
                into[j].append((i, score, ids))
        # Of equal values the one nearest to the start goes first, so ties do not fan out.
        heap = [(-ahead[-1], len(unit), 0, 0.0, ())]
        out, count = [], 0
        while heap and len(out) < n:
            _, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    ids.extend(path[0])
                    path = path[1]
                out.append((behind, np.array(ids, "<u2").tobytes()))
                continue
            for i, score, ids in into[at]:
                count += 1
                total = behind + score
                heapq.heappush(heap, (-(ahead[i] + total), i, -count, total, (ids, path)))
        return out

    def _learn(self, unit: str) -> tuple[float, float, bytes]:
        """A new unit: the sum over its parts, which no piece crosses."""
        pairs, known = self.pairs, self.known
        cuts = [i for i, pair in enumerate(map(operator.add, unit, unit[1:]), 1) if pair not in pairs]
        if not cuts:
            return self._solve(unit)
        found = []
        for part in map(unit.__getitem__, map(slice, [0, *cuts], [*cuts, len(unit)])):
            one = known.get(part)
            if one is None:
                one = known[part] = self._solve(part)
            found.append(one)
        best, loss, ids = zip(*found)
        return sum(best), min(loss), b"".join(ids)

    def _solve(self, unit: str) -> tuple[float, float, bytes]:
        """Best score of a unit and the loss of its second best, from the two best ways to each position."""
        n, first, none = len(unit), self.first, -np.inf
        best, second, by = [0.0] + [none] * n, [none] * (n + 1), [None] * (n + 1)
        for i, char in enumerate(unit):
            base, other, j = best[i], second[i], i + 1
            score, ids, after = first.get(char, _NOTHING)
            if ids is None:
                score, ids = self.unknown, self._spelled(char)
            while True:
                if ids is not None:
                    value = base + score
                    if value > best[j]:
                        second[j], best[j], by[j] = best[j], value, (i, ids)
                    elif value > second[j]:
                        second[j] = value
                    if other > none and other + score > second[j]:
                        second[j] = other + score
                if after is None or j == n or (found := after.get(unit[j])) is None:
                    break
                score, ids, after = found
                j += 1
        at, path = n, []
        while at:
            at, ids = by[at]
            path.append(ids)
        path.reverse()
        return best[n], best[n] - second[n], b"".join(path)

    def _spelled(self, char: str) -> bytes:
        return np.array([self.bytes[b] for b in (MARK if char == _LITERAL else char).encode()], "<u2").tobytes()

    def units_of(self, text: str) -> list[str]:
        if not text:
            return []
        return self.units.findall(MARK + text.replace(MARK, _LITERAL).replace(" ", MARK))

    def segmentations(self, text: str, n: int = N_BEST) -> list[tuple[float, bytes]]:
        """The n best (score, ids as little-endian 16-bit numbers) of a text, best first."""
        if len(self.known) > MOST_UNITS:
            self.known = _Known(self)
        units = self.units_of(text)
        scores, losses, parts = zip(*map(self.known.__getitem__, units)) if units else ((), (), ())
        base, losses = float(sum(scores)), np.array(losses, np.float64)
        out = [(base, b"".join(parts))]
        if n == 1 or not units:
            return out
        near = np.argsort(losses, kind="stable")[:n - 1] if len(losses) <= 64 else _least(losses, n - 1)
        merged: list[tuple[float, tuple]] = [(0.0, ())]
        for at in near.tolist():
            if not np.isfinite(losses[at]):
                continue
            ways = _n_best_of(self, units[at], n)
            merged = heapq.nsmallest(n, ((lost + ways[0][0] - score, changes + ((at, ids),) if k else changes)
                                         for lost, changes in merged for k, (score, ids) in enumerate(ways)),
                                     key=lambda m: m[0])
        for lost, changes in merged[1:]:
            changed = list(parts)
            for at, ids in changes:
                changed[at] = ids
            out.append((base - lost, b"".join(changed)))
        return out

    def decode(self, ids) -> str:
        """The text of a sequence of ids; bytes that are no UTF-8 become U+FFFD."""
        return _text_of(b"".join(map(self.raw.__getitem__, ids)))

    def round_trips(self, text: str, found: list[np.ndarray]) -> int:
        """How many of the segmentations decode to the text.

        The first is decoded as a whole. Of the others the ids between the first and the last
        difference are, and their bytes set between those of the first on either side.
        """
        first = found[0]
        whole = b"".join(map(self.raw.__getitem__, first.tolist()))
        count, ends = int(_text_of(whole) == text), None
        for ids in found[1:]:
            if ends is None:
                ends = np.concatenate(([0], np.cumsum(self.sizes[first])))
            least = min(len(first), len(ids))
            differ = np.flatnonzero(first[:least] != ids[:least])
            head = int(differ[0]) if len(differ) else least
            differ = np.flatnonzero(first[::-1][:least - head] != ids[::-1][:least - head])
            tail = int(differ[0]) if len(differ) else least - head
            changed = b"".join(map(self.raw.__getitem__, ids[head:len(ids) - tail].tolist()))
            count += _text_of(whole[:ends[head]] + changed + whole[ends[len(first) - tail]:]) == text
        return count


def _text_of(spelled: bytes) -> str:
    text = spelled.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n least values, the earlier of equal ones first."""
    limit = np.partition(values, n - 1)[n - 1]
    at = np.flatnonzero(values <= limit)
    return at[np.argsort(values[at], kind="stable")][:n]


@functools.lru_cache(50_000)
def _n_best_of(pieces: Pieces, unit: str, n: int) -> list[tuple[float, bytes]]:
    return pieces.n_best(unit, n)


@functools.cache
def pieces_of_model(path: str) -> Pieces:
    """One per process and model."""
    return Pieces(path)


def encode_n_best(docs: DataFrame, model_path: str, n: int = N_BEST, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Up to n rows per document, best first: doc_id, rank (from 1), score, ids.

    Equal scores come in a fixed order. A null or empty text has one segmentation without
    ids; texts with fewer than n segmentations give them all; repeated rows and null ids are
    kept; an empty table gives no rows.
    """
    def work(batches):
        pieces = pieces_of_model(model_path)
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 19):
                keys, ranks, values, ids = [], [], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for rank, (score, found) in enumerate(pieces.segmentations(text, n), 1):
                        keys.append(key)
                        ranks.append(rank)
                        values.append(score)
                        ids.append(np.frombuffer(found, "<u2").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(ranks, pa.int32()), pa.array(values, pa.float64()),
                     pa.array(ids, pa.list_(pa.int32()))], ["key", "rank", "score", "ids"])

    rows = in_tasks(text_rows(docs, id_col, text_col), work, "key long, rank int, score double, ids array<int>")
    return rows.select(id_of(F.col("key")).alias("doc_id"), "rank", "score", "ids")


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of each array of ids; null for a null array.

    Null or unknown ids in an array add nothing.
    """
    at = rows.columns.index(ids_col)
    names = [f"c{i}" for i in range(len(rows.columns))]

    def work(batches):
        pieces = pieces_of_model(model_path)
        size = len(pieces.raw)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(i for i in ids if i is not None and 0 <= i < size)
                     for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    out = in_tasks(rows.toDF(*names), work, ", ".join(f"{n} {t}" for n, (_, t) in zip(names, rows.dtypes)) + ", decoded string")
    return out.toDF(*rows.columns, "decoded")


_REPORT = pa.schema([
    ("key", pa.int64()), ("n_chars", pa.int64()), ("n_found", pa.int64()), ("n_pieces", pa.int64()),
    ("best_score", pa.float64()), ("last_score", pa.float64()), ("ids_crc32", pa.int64()),
    ("all_crc32", pa.int64()), ("n_round_trips", pa.int64()), ("round_trip", pa.bool_())])


def _report(pieces: Pieces, key: int, text: str, n: int) -> tuple:
    found = pieces.segmentations(text, n)
    ids = [np.frombuffer(raw, "<u2") for _, raw in found]
    wide = [i.astype("<u4").tobytes() for i in ids]
    every = 0
    for w in wide:
        every = zlib.crc32(w, every)
    trips = pieces.round_trips(text, ids)
    return (key, len(text), len(found), len(ids[0]), found[0][0], found[-1][0], zlib.crc32(wide[0]), every,
            trips, trips == len(found))


def report_n_best(docs: DataFrame, model_path: str, n: int = N_BEST, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document about its n best segmentations, as ``encode_n_best`` finds them.

    doc_id, n_chars, n_found, n_pieces (of the best), best_score, last_score, ids_crc32 (of the
    best), all_crc32 (of all, best first; unsigned, ids as little-endian 32-bit numbers),
    n_round_trips: how many of them decode to the text, and round_trip: whether all do.
    """
    def work(batches):
        pieces = pieces_of_model(model_path)
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                rows = [_report(pieces, key, text, n)
                        for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield as_batch(_REPORT, list(zip(*rows)))

    out = in_tasks(text_rows(docs, id_col, text_col), work,
                   "key long, n_chars long, n_found long, n_pieces long, best_score double, last_score double, "
                   "ids_crc32 long, all_crc32 long, n_round_trips long, round_trip boolean")
    return out.withColumn("doc_id", id_of(F.col("key"))).select("doc_id", *[f.name for f in _REPORT][1:])
