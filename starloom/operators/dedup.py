"""First-wins removal of repeated rows and key preconditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.bits import bit_set, most_bits, with_bit
from starloom.operators.keys import number_rows
from starloom.session import cut_lineage


def keep_first(df: DataFrame, key: list[str], order: list[str], stored: bool = False) -> DataFrame:
    """Keep the row that comes first by ``order`` among rows with an equal key; exactly one.

    Null keys are equal to each other; of rows that tie on ``order`` the one with the least
    row hash stays, and of rows equal in every column any. The rows are written once, unless
    ``stored`` says they already are, and never shuffled: a row is known by its place. Hashes
    of the keys are counted, with partial results before the shuffle; the rows whose hash
    occurs more than once, and a few others, are compared by their exact keys, and the places
    of the surplus ones are left out of the scan.
    """
    frame = df if stored else cut_lineage(df)
    placed = number_rows(frame, "_number", stored=True)
    hashes = F.xxhash64(*[F.col(f"`{c}`") for c in key])
    counted = frame.groupBy(hashes.alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    size = min(2 ** max(frame.count() - 1, 1).bit_length(), most_bits())
    again = bit_set(counted.where("_n > 1").select(F.pmod("_hash", F.lit(size)).alias("_bit")))
    asked = with_bit(placed, F.pmod(hashes, F.lit(size)), again)
    columns = [F.col(f"`{c}`") for c in df.columns]
    first = asked.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.min(F.struct(
        *[F.col(f"`{c}`") for c in order], F.xxhash64(*columns).alias("_hash"), "_number")).alias("_first"))
    # Every place asked for is there once, those of first rows twice: the odd ones are surplus.
    surplus = bit_set(
        asked.select(F.col("_number").alias("_bit")).unionByName(first.select(F.col("_first._number").alias("_bit"))), odd=True)
    return with_bit(placed, F.col("_number"), surplus, unset=True).select(*columns)


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many keys repeat, and how many rows are surplus."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.count(F.when(F.col("n") > 1, 1)).alias("key_groups"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def require_unique(df: DataFrame, key: list[str], what: str) -> None:
    surplus = repeated_keys(df, key).first().surplus_rows
    if surplus:
        raise ValueError(f"{what}: {surplus} repeated value(s) of {tuple(key)}")


def mixed_keys(df: DataFrame, key: str, value: str) -> int:
    """How many keys carry several values."""
    worst = df.groupBy(key).agg(F.min(value).alias("a"), F.max(value).alias("b"))
    return worst.where("a <> b").count()


def require_dependency(df: DataFrame, key: str, value: str, what: str) -> None:
    """Every ``key`` must carry a single ``value``."""
    mixed = mixed_keys(df, key, value)
    if mixed:
        raise ValueError(f"{what}: {mixed} {key} value(s) map to several {value} values")
