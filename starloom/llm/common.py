"""What the operators of this subpackage share: stored tables, shipped code, row streams."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import cut_lineage

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LEAST = -(1 << 63)
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "starloom_tasks.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there; its shuffle files go at once."""
    with _shuffles_removed(df.sparkSession):
        return cut_lineage(df)


def in_tasks(df: DataFrame, work, schema: str) -> DataFrame:
    """mapInArrow with a schema written as DDL; ``work`` maps a stream of batches.

    Python processes live on after a task, so each gives back the memory it no longer uses.
    """
    def tidy(batches):
        yield from work(batches)
        give_back()

    ship(df.sparkSession)
    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return freed memory of Arrow and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, text): the two columns an operator needs, whatever else the frame holds.

    ``key`` is the id, or the least long where it is null; a null text is empty.
    """
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST)).alias("key"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def id_of(key):
    """The id that ``text_rows`` made a key from."""
    return F.when(key != LEAST, key)


def pieces_of(batch: pa.RecordBatch, column: str, most: int = 2 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of text and ``rows`` rows at most.

    A longer text is a slice of its own.
    """
    if batch.num_rows == 0:
        return
    array = batch.column(batch.schema.get_field_index(column))
    ends = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False).astype("int64").cumsum()
    start, base = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, min(start + rows, int(ends.searchsorted(base + most, "right"))))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def as_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream of batches that is sorted by ``keys``, one at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys)))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
