"""Per-document frequencies over the dictionary of a block, and values joined to its entries.

A block is a run of documents of one task. It is stored as rows of two kinds: its distinct
entries, which are joined once per block however many documents hold them, and its documents,
each with the places of its entries in that dictionary and their numbers of occurrences. A block
ends when its dictionary is full, so what a task holds is bounded. ``with_values`` brings the
joined values back to the documents of their block.

A block's number comes from its task and place and is fixed when the rows are stored, so
everything after that agrees on it, whatever is computed again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import in_tasks

DICTIONARY, DOCUMENT = 0, 1
ENTRIES_A_ROW = 4096
SLICE_BYTES = 2 << 20
LAYOUT = "block long, kind int, first int, entries array<{}>, weights array<long>, at binary, times binary"


class Blocks:
    """Numbers the blocks of one task and makes their rows."""

    def __init__(self, entry: pa.DataType, measures: list[tuple[str, pa.DataType]]):
        self.next = TaskContext.get().partitionId() << 32
        self.schema = pa.schema([
            ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.int32()), ("entries", pa.list_(entry)),
            ("weights", pa.list_(pa.int64())), ("at", pa.binary()), ("times", pa.binary()), *measures])
        self.measures = measures

    def documents(self, at: np.ndarray, times: np.ndarray, ends: np.ndarray, columns: list) -> pa.RecordBatch:
        """Documents of the block in hand: ``at[ends[i - 1]:ends[i]]`` are the entries of document i."""
        bounds = list(zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()))
        return self._batch(len(ends), self.next, DOCUMENT, None, None, None,
                           [packed_places(at[a:b]) for a, b in bounds], [packed(times[a:b]) for a, b in bounds], columns)

    def dictionary(self, entries, weights=None):
        """The entries of the block in hand, which ends here."""
        firsts = range(0, len(entries), ENTRIES_A_ROW)
        block, self.next = self.next, self.next + 1
        if firsts:
            cut = [slice(f, f + ENTRIES_A_ROW) for f in firsts]
            yield self._batch(len(firsts), block, DICTIONARY, list(firsts), [entries[c] for c in cut],
                              None if weights is None else [weights[c] for c in cut], None, None,
                              [pa.nulls(len(firsts), kind) for _, kind in self.measures])

    def _batch(self, n, block, kind, first, entries, weights, at, times, columns) -> pa.RecordBatch:
        values = [[block] * n, [kind] * n, first, entries, weights, at, times]
        arrays = [pa.nulls(n, f.type) if v is None else pa.array(v, f.type) for v, f in zip(values, self.schema)]
        return pa.RecordBatch.from_arrays(arrays + [
            c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, self.measures)],
            schema=self.schema)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the least width of 1, 2 or 4 bytes, which goes before them."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def packed_places(values: np.ndarray) -> bytes:
    """Ascending numbers by their steps: single bytes, and four bytes for each step above 254."""
    steps = np.diff(values, prepend=0)
    wide = steps[steps > 254]
    plain = packed(values)
    if len(values) + 4 * len(wide) + 5 >= len(plain):
        return plain
    return (b"\0" + len(values).to_bytes(4, "little") + np.minimum(steps, 255).astype(np.uint8).tobytes()
            + wide.astype("<u4").tobytes())


def unpacked_places(raw: bytes) -> np.ndarray:
    if raw[0]:
        return unpacked(raw)
    n = int.from_bytes(raw[1:5], "little")
    steps = np.frombuffer(raw, np.uint8, n, 5).astype(np.int64)
    steps[steps == 255] = np.frombuffer(raw, "<u4", offset=5 + n)
    return np.cumsum(steps)


def frequencies(owner: np.ndarray, at: np.ndarray, size: int, owners: int):
    """(at, times, ends) per owner from one (owner, entry) pair per occurrence."""
    codes, times = np.unique(owner * np.int64(max(size, 1)) + at, return_counts=True)
    who, at = np.divmod(codes, max(size, 1))
    return at, times, np.searchsorted(who, np.arange(owners), "right")


def entries(blocks: DataFrame) -> DataFrame:
    """(block, place, entry): the dictionary of every block."""
    return blocks.where(F.col("kind") == DICTIONARY).select(
        "block", "first", F.posexplode("entries").alias("nth", "entry")).select(
        "block", (F.col("first") + F.col("nth")).alias("place"), "entry")


def weighted_entries(blocks: DataFrame) -> DataFrame:
    """(entry, weight): each block's entries with their weights there."""
    return blocks.where(F.col("kind") == DICTIONARY).select(
        F.explode(F.arrays_zip("entries", "weights")).alias("e")).select(
        F.col("e.entries").alias("entry"), F.col("e.weights").alias("weight"))


def with_values(blocks: DataFrame, values: DataFrame, names: list[str], measures: list[str], total, schema: str):
    """Documents with what ``total`` makes of their entries' values.

    ``values`` is (block, place, *names), one long per name. ``total(times, columns)`` gets a
    document's occurrences and the values at its entries and returns a list of whole numbers;
    they follow the ``measures`` in the result, whose DDL is ``schema``. The documents of a
    block meet its dictionary in one task, sorted behind it; a block is bounded, so is what a
    task holds.
    """
    docs = blocks.where(F.col("kind") == DOCUMENT).select("block", "kind", "at", "times", *measures)
    known = values.select("block", F.lit(DICTIONARY).alias("kind"), "place", *names)
    met = known.unionByName(docs, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")

    def work(batches):
        block, held, table = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            numbers = column["block"].to_numpy(zero_copy_only=False)
            kinds = column["kind"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if numbers[a] != block:
                    block, held, table = numbers[a], [], None
                if kinds[a] == DICTIONARY:
                    held.append(np.array([column[n].slice(a, b - a).to_numpy(zero_copy_only=False)
                                          for n in ("place", *names)], np.int64))
                    continue
                if table is None:
                    table = _dense(held, len(names))
                    held = []
                out = []
                for raw, often in zip(column["at"].slice(a, b - a).to_pylist(),
                                      column["times"].slice(a, b - a).to_pylist()):
                    out.append(total(unpacked(often).astype(np.int64), table[:, unpacked_places(raw)]))
                yield pa.RecordBatch.from_arrays(
                    [column[m].slice(a, b - a) for m in measures]
                    + [pa.array(list(c), pa.int64()) for c in zip(*out)],
                    [f.split()[0] for f in schema.split(", ")])

    return in_tasks(met, work, schema)


def _dense(held: list[np.ndarray], width: int) -> np.ndarray:
    if not held:
        return np.zeros((width, 0), np.int64)
    place, *values = np.concatenate(held, axis=1)
    table = np.zeros((width, int(place.max()) + 1), np.int64)
    table[:, place] = values
    return table
