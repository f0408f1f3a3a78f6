"""Column rules of the cleaning step, on columns that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _try(value: Column, kind: str) -> Column:
    return value.try_cast(kind)


def to_decimal(text: Column, kind: str) -> Column:
    """Number or null; unreadable text becomes null."""
    return _try(text, kind)


def to_whole(text: Column, kind: str = "bigint") -> Column:
    """Whole number or null; '11.0' reads as 11."""
    return F.coalesce(_try(text, kind), _try(F.floor(_try(text, "double")), kind))


def is_fraction(text: Column) -> Column:
    """A readable number that is not whole."""
    number = _try(text, "double")
    return F.coalesce(number != F.floor(number), F.lit(False))


def to_flag(text: Column) -> Column:
    """1, 1.0, true / 0, 0.0, false as booleans; null stays null."""
    number = _try(text, "double")
    word = F.lower(text)
    return (
        F.when((number == 1) | (word == "true"), True)
        .when((number == 0) | (word == "false"), False)
    )


def is_bad_flag(text: Column) -> Column:
    return text.isNotNull() & to_flag(text).isNull()


def to_day(text: Column) -> Column:
    """Date part of a date or timestamp text; null when it cannot be read."""
    return F.to_date(_try(text, "timestamp_ntz"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
