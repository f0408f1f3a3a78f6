"""Column expressions shared by the plans, so every query uses the same rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schemas import LENGTH_BUCKETS, PRICE_BANDS, UNKNOWN

# Characters str.strip() removes from both ends of a text (fixed values).
STRIP_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: str | Column) -> Column:
    return F.btrim(F.col(column) if isinstance(column, str) else column, F.lit(STRIP_CHARACTERS))


def price_band(price: Column) -> Column:
    """Left-closed band of a price; a null or negative price has none."""
    chain = None
    for label, low, high in PRICE_BANDS:
        inside = (price >= low) if high is None else (price >= low) & (price < high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def band_order(band: Column) -> Column:
    chain = None
    for place, (label, _, _) in enumerate(PRICE_BANDS, start=1):
        chain = F.when(band == label, place) if chain is None else chain.when(band == label, place)
    return chain


def length_bucket(length: Column) -> Column:
    chain = F.when(length.isNull(), UNKNOWN)
    for label, limit in LENGTH_BUCKETS:
        chain = chain.otherwise(label) if limit is None else chain.when(length < limit, label)
    return chain


def length_order(length: Column) -> Column:
    chain = F.when(length.isNull(), 0)
    for place, (_, limit) in enumerate(LENGTH_BUCKETS, start=1):
        chain = chain.otherwise(place) if limit is None else chain.when(length < limit, place)
    return chain


def date_key(day: Column) -> Column:
    """yyyymmdd as a number."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Rounded quotient, null when there is nothing to divide by."""
    return F.round(numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return ratio(part * F.lit(100), whole, places)


def weighted_mean(mean: str, weight: str, places: int = 4) -> Column:
    """sum(mean * weight) / sum(weight), with the products summed exactly."""
    exact = F.col(mean).cast("decimal(10,4)") * F.col(weight).cast("decimal(18,0)")
    return F.round(F.sum(exact).cast("double") / F.nullif(F.sum(weight), F.lit(0)), places)


def population_stddev(total: Column, squares: Column, n: Column, places: int = 4) -> Column:
    """Population standard deviation from whole-number sums.

    The sums of whole numbers are exact, so partial sums merge in any order.
    """
    wide = "decimal(38,0)"
    spread = n.cast(wide) * squares.cast("decimal(18,0)") - total.cast("decimal(18,0)") * total.cast("decimal(18,0)")
    return F.round(F.sqrt(spread.cast("double")) / n, places)


def tag_list(text: Column) -> Column:
    """Parse a stringified list; anything unreadable becomes an empty list."""
    parsed = F.from_json(text, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def selected(column: str, values) -> Column | None:
    """Membership test; an empty selection means no filter."""
    return F.col(column).isin(list(values)) if values else None


def all_of(*conditions: Column | None) -> Column:
    kept = [c for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, kept) if kept else F.lit(True)


def contains_text(column: str, search: str) -> Column | None:
    """Case-insensitive LIKE %search%; an empty search passes everything.

    The search text keeps its wildcards, as it does in an ILIKE pattern.
    """
    return F.col(column).ilike(f"%{search}%") if search else None


def short_label(text: Column, limit: int = 26) -> Column:
    cut = F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…"))
    return F.when(F.length(text) > limit, cut).otherwise(text)
