"""Sets of whole numbers as rows of bits, small enough to be broadcast.

A set over n numbers takes n bits and a little more, however many members it has: rows that
are chosen by their place or by a hash are then found without moving any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators import joins
from starloom.session import cut_lineage

# A row holds the bits of 2,048 neighbouring numbers, in words of 64.
WORDS = 32
ROW_BITS = 11


def most_bits() -> int:
    """The largest power of two whose bits may be broadcast."""
    rows = max(joins.BROADCAST_BYTES // (8 * (WORDS + 1)), 1)
    return 2 ** ((rows << ROW_BITS).bit_length() - 1)


def bit_set(numbers: DataFrame, odd: bool = False) -> DataFrame:
    """The numbers of the column ``_bit`` as stored rows of bits; with ``odd`` those that occur oddly often.

    The numbers are dealt by row, which bounds what a task adds up.
    """
    at = F.col("_bit")
    row, word = F.shiftright(at, ROW_BITS), F.shiftright(at, 6).bitwiseAND(F.lit(WORDS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    total, none = F.bit_xor if odd else F.bit_or, F.lit(0).cast("long")
    dealt = numbers.select(at).where(at.isNotNull()).repartition(row)
    words = [total(F.when(word == i, bit).otherwise(none)) for i in range(WORDS)]
    return cut_lineage(dealt.groupBy(row.alias("_row")).agg(F.array(*words).alias("_words")))


def with_bit(df: DataFrame, number: Column, bits: DataFrame, unset: bool = False) -> DataFrame:
    """The rows of ``df`` whose number is in a set of bits, or with ``unset`` the others.

    The set is broadcast where its size allows it; a larger one is shuffled with the rows it
    meets.
    """
    small = bits.count() * 8 * (WORDS + 1) <= joins.BROADCAST_BYTES
    at = F.col("_bit")
    joined = df.withColumn("_bit", number.cast("long")).join(
        F.broadcast(bits) if small else bits, F.shiftright(at, ROW_BITS) == F.col("_row"), "left" if unset else "inner")
    word = F.get("_words", F.shiftright(at, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int"))
    held = F.coalesce(F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")), F.lit(0)) == 1
    return joined.where(~held if unset else held).select(*[F.col(f"`{c}`") for c in df.columns])
