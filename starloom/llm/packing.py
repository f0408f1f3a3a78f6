"""Packing of token sequences: window-filling length combinations by non-negative least squares.

A document of n tokens (its ids and the end id) gives whole windows, a main piece of a multiple
of ``UNIT`` tokens, and a tail of less than a unit. Main lengths in units form a bounded
histogram. Combinations of up to three lengths, and repeats of one length with a rest, that
fill the window exactly are enumerated; non-negative least squares finds how often to use each;
the counts are rounded down and topped up while a combination still fits the histogram. Main
pieces left over are cut at powers of two and packed largest first, where none crosses a
window; tails are packed by length into what is open and then into windows of their own.

The driver sees histograms only. A piece finds its place from its rank among the pieces of its
length: its rank in the stored part it lies in, plus the counts of the parts before.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import in_tasks, pieces_of, stored
from starloom.llm.tokens import word_ids

WINDOW = 2048
UNIT = 16
END_ID = 1
FULL, MAIN, BIT, TAIL = range(4)
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def combinations(units: int) -> np.ndarray:
    """Columns of counts by length (rows 0..units): what fills a window of ``units`` exactly."""
    found = set()
    for a in range(1, units):
        if a <= units - a:
            found.add((a, units - a))
        for b in range(a, (units - a) // 2 + 1):
            found.add((a, b, units - a - b))
        times, rest = divmod(units, a)
        if times <= 64:
            found.add(tuple(sorted([a] * times + [rest] * (rest > 0))))
    columns = sorted(found, key=lambda c: (len(c), c))
    matrix = np.zeros((units + 1, len(columns)))
    for j, c in enumerate(columns):
        for a in c:
            matrix[a, j] += 1
    return matrix


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets on the normal equations."""
    n = a.shape[1]
    gram, goal = a.T @ a, a.T @ b
    gram[np.diag_indices(n)] += 1e-9
    x = np.zeros(n)
    free = np.zeros(n, bool)
    tolerance = 1e-5 * float(np.abs(goal).max(initial=0))
    for _ in range(rounds):
        slope = goal - gram @ x
        slope[free] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= tolerance:
            break
        free[j] = True
        while free.any():
            at = np.flatnonzero(free)
            s = np.linalg.solve(gram[np.ix_(at, at)], goal[at])
            if (s > 0).all():
                x[at] = s
                break
            low, here = s <= 0, x[at]
            step = np.min(here[low] / np.maximum(here[low] - s[low], 1e-300))
            x[at] = np.maximum(0, here + step * (s - here))
            drop = at[low & (x[at] <= 1e-9 * (1 + x.max()))]
            if not len(drop):
                drop = at[low][[int(np.argmin(x[at][low]))]]
            x[drop] = 0
            free[drop] = False
    return x


class Plan:
    """Where the pieces of each length go, as runs of equal sequences."""

    def __init__(self, fulls: int, mains: np.ndarray, tails: np.ndarray, window: int = WINDOW, unit: int = UNIT):
        self.window, self.unit = window, unit
        units = window // unit
        # a run: class, value, first rank, first sequence, pieces a sequence, offset, length
        runs: list[tuple] = [(FULL, 0, 0, 0, 1, 0, window)]
        self.next = fulls
        left = mains.astype(np.int64).copy()
        left[0] = 0
        columns = combinations(units)
        solved = nonnegative_least_squares(columns[1:], left[1:].astype(np.float64)) if left.any() else None
        used = np.zeros(units + 1, np.int64)
        if solved is not None:
            share = np.argsort(-solved, kind="stable")
            for top_up in (False, True):
                for j in share:
                    column = columns[:, j].astype(np.int64)
                    at = np.flatnonzero(column)
                    times = int((left[at] // column[at]).min())
                    if not top_up:
                        times = min(times, int(solved[j] + 1e-9))
                    if times <= 0:
                        continue
                    offset = 0
                    for q in at[::-1]:
                        runs.append((MAIN, int(q), int(used[q]), self.next, int(column[q]), offset, int(q) * unit))
                        used[q] += times * column[q]
                        offset += int(q * column[q]) * unit
                    left[at] -= times * column[at]
                    self.next += times
        self.planned = used
        # Rest of the main pieces: cut at powers of two, the largest first.
        bits = units.bit_length() - 1
        self.bit_rank = np.zeros((bits, units + 1), np.int64)
        at_unit, first = 0, self.next
        for b in reversed(range(bits)):
            has = left * ((np.arange(units + 1) >> b) & 1)
            self.bit_rank[b] = np.cumsum(has) - has
            n = int(has.sum())
            # Ranks count on from the unit reached, so that one division finds sequence and offset.
            runs.append((BIT, b, -(at_unit >> b), first, units >> b, 0, unit << b))
            at_unit += n << b
        self.next += at_unit // units
        at = at_unit % units * unit
        for t in range(unit - 1, 0, -1):
            n, rank = int(tails[t]), 0
            fit = min(n, (window - at) // t) if at else 0
            if fit:
                runs.append((TAIL, t, rank, self.next, fit, at, t))
                n, rank, at = n - fit, rank + fit, at + fit * t
            if n:
                self.next += at > 0
                each = window // t
                runs.append((TAIL, t, rank, self.next, each, 0, t))
                self.next += n // each
                at = n % each * t
        self.sequences = self.next + (at > 0)
        runs.sort(key=lambda r: r[:3])
        self.runs = np.array(runs, np.int64)
        self._start = self._code(self.runs[:, 0], self.runs[:, 1]) + self.runs[:, 2]

    @staticmethod
    def _code(kind, value):
        return ((np.asarray(kind, np.int64) * 256 + value) << 48) + (1 << 47)

    def place(self, kind: int, value: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by class, value and rank."""
        run = self.runs[np.searchsorted(self._start, self._code(kind, value) + rank, "right") - 1]
        since = rank - run[:, 2]
        return run[:, 3] + since // run[:, 4], run[:, 5] + since % run[:, 4] * run[:, 6]


def _lists(values: list[list[int]]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _measured(docs: DataFrame, path: str, window: int, unit: int) -> DataFrame:
    """One row per document: its tokens, checksums of its pieces, its ranks in the stored part."""
    bits = (window // unit).bit_length() - 1

    def work(batches):
        vocabulary = word_ids(path)
        part = TaskContext.get().partitionId()
        n_full = 0
        n_main = np.zeros(window // unit + 1, np.int64)
        n_tail = np.zeros(unit, np.int64)
        crc = zlib.crc32
        for batch in batches:
            for rows in pieces_of(batch, "text", 4 << 20):
                out: list[list] = [[] for _ in range(11)]
                for text in rows.column(1).to_pylist():
                    ids = vocabulary.text_ids(text)
                    raw = memoryview(np.append(ids, END_ID).astype("<u4").tobytes())
                    n = len(ids) + 1
                    full, rest = divmod(n, window)
                    main, tail = divmod(rest, unit)
                    at = full * window
                    ends, cuts = at, []
                    for b in reversed(range(bits)):
                        if main >> b & 1:
                            cuts.append(crc(raw[4 * ends:4 * (ends + (unit << b))]))
                            ends += unit << b
                    row = (n, [crc(raw[4 * window * i:4 * window * (i + 1)]) for i in range(full)], n_full,
                           main, crc(raw[4 * at:4 * ends]), cuts, int(n_main[main]),
                           tail, crc(raw[4 * ends:]), int(n_tail[tail]), part)
                    for column, value in zip(out, row):
                        column.append(value)
                    n_full += full
                    n_main[main] += 1
                    n_tail[tail] += 1
                columns = [_lists(c) if i in (1, 5) else pa.array(c, pa.int64()) for i, c in enumerate(out)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], [
                    "doc_id", "tokens", "full_crcs", "full_rank", "main", "main_crc", "cut_crcs", "main_rank",
                    "tail", "tail_crc", "tail_rank", "part"])

    return in_tasks(docs, work, "doc_id long, tokens long, full_crcs array<long>, full_rank long, main long, "
                                "main_crc long, cut_crcs array<long>, main_rank long, tail long, tail_crc long, "
                                "tail_rank long, part long")


def _before(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Per part and value, the count of earlier parts; a window of one row per part."""
    order = Window.partitionBy(value).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("part", value, F.coalesce(F.sum("n").over(order), F.lit(0)).alias(name))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, with the end id, lies in exactly one piece; sequences hold at
    most ``window`` tokens without gaps. A null or empty text is the end id alone; rows that
    repeat an id are packed each; a null id stays null; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    measured = stored(_measured(rows, tokenizer_path, window, unit))
    counts = stored(measured.groupBy("part", "main", "tail").agg(
        F.count("*").alias("n"), F.sum(F.size("full_crcs")).alias("fulls")))
    mains = np.zeros(window // unit + 1, np.int64)
    tails = np.zeros(unit, np.int64)
    fulls = 0
    for r in counts.groupBy("main", "tail").agg(F.sum("n").alias("n"), F.sum("fulls").alias("fulls")).toLocalIterator():
        mains[r["main"]] += r["n"]
        tails[r["tail"]] += r["n"]
        fulls += r["fulls"]
    plan = Plan(fulls, mains, tails, window, unit)
    by_main = counts.groupBy("part", "main").agg(F.sum("n").alias("n"))
    by_tail = counts.groupBy("part", "tail").agg(F.sum("n").alias("n"))
    by_part = counts.groupBy("part").agg(F.sum("fulls").alias("n")).withColumn("all", F.lit(0))
    placed = (measured.join(_before(by_main, "main", "main_before"), ["part", "main"])
              .join(_before(by_tail, "tail", "tail_before"), ["part", "tail"])
              .join(_before(by_part, "all", "full_before").drop("all"), "part"))

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                yield _pieces(batch, plan)

    return in_tasks(placed.select(
        "doc_id", "tokens", "full_crcs", (F.col("full_rank") + F.col("full_before")).alias("full_rank"),
        "main", "main_crc", "cut_crcs", (F.col("main_rank") + F.col("main_before")).alias("main_rank"),
        "tail", "tail_crc", (F.col("tail_rank") + F.col("tail_before")).alias("tail_rank")), work, _PIECE)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)


def _pieces(batch: pa.RecordBatch, plan: Plan) -> pa.RecordBatch:
    c = {n: batch.column(i) if n == "doc_id" else batch.column(i).to_numpy(zero_copy_only=False)
         for i, n in enumerate(batch.schema.names) if not n.endswith("crcs")}
    window, unit = plan.window, plan.unit
    every = np.arange(batch.num_rows)
    parts = []  # document, start, length, crc, sequence, offset

    crcs, sizes = _flat(batch, "full_crcs")
    owner = np.repeat(every, sizes)
    nth = np.arange(len(crcs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sequence, offset = plan.place(FULL, 0, c["full_rank"][owner] + nth)
    parts.append((owner, nth * window, np.full(len(crcs), window), crcs, sequence, offset))

    base = c["tokens"] // window * window
    whole = np.flatnonzero((c["main"] > 0) & (c["main_rank"] < plan.planned[c["main"]]))
    sequence, offset = plan.place(MAIN, c["main"][whole], c["main_rank"][whole])
    parts.append((whole, base[whole], c["main"][whole] * unit, c["main_crc"][whole], sequence, offset))

    crcs, sizes = _flat(batch, "cut_crcs")
    first = np.cumsum(sizes) - sizes
    rest = np.flatnonzero((c["main"] > 0) & (c["main_rank"] >= plan.planned[c["main"]]))
    start, nth = base[rest].copy(), first[rest].copy()
    main = c["main"][rest]
    beyond = c["main_rank"][rest] - plan.planned[main]
    for b in reversed(range(len(plan.bit_rank))):
        has = np.flatnonzero(main >> b & 1)
        sequence, offset = plan.place(BIT, b, plan.bit_rank[b][main[has]] + beyond[has])
        parts.append((rest[has], start[has], np.full(len(has), unit << b), crcs[nth[has]], sequence, offset))
        start[has] += unit << b
        nth[has] += 1

    tail = np.flatnonzero(c["tail"] > 0)
    sequence, offset = plan.place(TAIL, c["tail"][tail], c["tail_rank"][tail])
    parts.append((tail, c["tokens"][tail] - c["tail"][tail], c["tail"][tail], c["tail_crc"][tail], sequence, offset))

    owner, start, length, crc, sequence, offset = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
    take = pa.array(owner)
    return pa.RecordBatch.from_arrays(
        [c["doc_id"].take(take), pa.array(start), pa.array(length), pa.array(crc), pa.array(c["tokens"][owner]),
         pa.array(sequence), pa.array(offset)],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
