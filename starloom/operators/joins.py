"""Joins of a long frame with a lookup, safe for hot keys and large lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot from this part of an average partition on; it is cut into shares of that size.
HOT_PART = 0.25


def frame_bytes(df: DataFrame) -> int:
    """Measured size of a narrow frame: text by its length, other values by 8 bytes."""
    per_row = [
        F.coalesce(F.octet_length(c), F.lit(0)) + 16 if t == "string" else F.lit(8)
        for c, t in df.dtypes
    ]
    total = F.sum(reduce(lambda a, b: a + b, per_row).cast("long"))
    return df.agg(F.coalesce(total, F.lit(0)).alias("n")).first().n


def fits_broadcast(df: DataFrame) -> bool:
    return frame_bytes(df) <= BROADCAST_BYTES


def attach(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a lookup without running anything first.

    It is broadcast if the optimizer's own size estimate, an upper bound for stored tables
    read as they are, stays below the limit; otherwise the join is left to adaptive
    execution, which splits hot keys.
    """
    estimate = int(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.join(F.broadcast(lookup) if estimate <= BROADCAST_BYTES else lookup, on, how)


def _same(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    tests = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs
    ]
    return reduce(lambda a, b: a & b, tests)


def hot_keys(df: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """(h, shares): hashes of the keys that hold more than ``HOT_PART`` of an average partition.

    From exact counts per key, added up in the tasks first. At most ``partitions / HOT_PART``
    keys can be that large, so the frame has a size bound that does not depend on the rows.
    """
    counts = cut_lineage(df.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n")))
    part = HOT_PART * (counts.agg(F.sum("n").alias("n")).first().n or 0) / partitions
    return cut_lineage(counts.where(F.col("n") > max(part, 1)).select(
        "h", F.least(F.ceil(F.col("n") / max(part, 1)), F.lit(partitions)).cast("int").alias("shares")))


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: list[str], null_safe: bool = False,
    how: str = "left", broadcast_ok: bool | None = None,
) -> DataFrame:
    """Attach the other columns of ``lookup`` to every row of ``df``.

    A lookup whose measured size is small is broadcast. A larger one is shuffled
    on the key; rows of hot keys are then spread over salted copies of their
    lookup rows, so no task receives all rows of one key. The salt is a hash of
    the row itself: a repeated task computes the same one (rows equal in all
    columns stay together).
    """
    types = dict(df.dtypes)
    values = [c for c in lookup.columns if c not in on]
    right = lookup.select(
        *[F.col(k).cast(types[k]).alias(f"_on_{k}") for k in on], *values
    )
    pairs = [(k, f"_on_{k}") for k in on]
    if fits_broadcast(lookup) if broadcast_ok is None else broadcast_ok:
        joined = df.join(F.broadcast(right), _same(df, right, pairs, null_safe), how)
        return joined.select(*df.columns, *values)

    hot = hot_keys(df, on, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in on])
    left = df.withColumn("_h", hashed).join(F.broadcast(hot), F.col("_h") == F.col("h"), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col("shares")), F.lit(0)).cast("int"))
    right = right.withColumn("_h", F.xxhash64(*[b for _, b in pairs])).join(
        F.broadcast(hot), F.col("_h") == F.col("h"), "left").withColumn(
        "_salt_copy", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).drop("_h", "h", "shares")
    same = _same(left, right, pairs, null_safe) & (left["_salt"] == right["_salt_copy"])
    return left.join(right, same, how).select(*[left[c] for c in df.columns], *values)


def _renamed(df: DataFrame, on: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    pairs = [(k, f"_on_{k}") for k in on]
    return df.select(*[F.col(a).alias(b) for a, b in pairs]), pairs


def _with_keys(df: DataFrame, absent: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is among ``absent``, the stored keys of some of its rows."""
    count = absent.count()
    if not count:
        return df.where(F.lit(False))
    if count == df.count():
        return df
    wanted, pairs = _renamed(absent, on)
    return df.join(F.broadcast(wanted) if fits_broadcast(absent) else wanted, _same(df, wanted, pairs, True), "left_semi")


def without_matches(df: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``; null keys match each other.

    A small ``df`` against a long ``existing`` first narrows ``existing`` to the
    keys in question, so the long side is scanned but never shuffled. Of a long ``df`` only
    the keys are compared; its rows are moved where some, but not all, are left and their
    keys are too many to broadcast.
    """
    if existing.isEmpty():
        return df
    present, pairs = _renamed(existing, on)
    keys = df.select(*on)
    if fits_broadcast(keys):
        wanted = keys.withColumnsRenamed({k: f"_want_{k}" for k in on})
        same = _same(present, wanted, [(b, f"_want_{a}") for a, b in pairs], True)
        present = present.join(F.broadcast(wanted), same, "left_semi")
        return df.join(present, _same(df, present, pairs, True), "left_anti")
    return _with_keys(df, cut_lineage(keys.join(present, _same(keys, present, pairs, True), "left_anti")), on)


# Up to so many keys are looked for by value, so Parquet can pass over most of the stored ones.
FEW_KEYS = 1000


def without_bucketed(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys``, which lie in buckets of those columns.

    Only the keys of ``df`` are exchanged, by the buckets; its rows are moved as ``without_matches``
    says. A null key equals nothing. The keys of a small ``df`` narrow the scan by their values:
    exactly through the Bloom filters where they are few, else by their range.
    """
    if keys.isEmpty():
        return df
    few = df.select(*on).limit(FEW_KEYS + 1).collect()
    narrow = len(few) <= FEW_KEYS or set(df.columns) <= set(on)
    if len(few) <= FEW_KEYS:
        for column in on:
            keys = keys.where(F.col(column).isin(sorted({r[column] for r in few if r[column] is not None})))
    present, pairs = _renamed(keys, on)
    offered = df if narrow else df.select(*on)
    absent = offered.join(present.hint("merge"), _same(offered, present, pairs, False), "left_anti")
    return absent if narrow else _with_keys(df, cut_lineage(absent), on)
