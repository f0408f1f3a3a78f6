"""Surrogate numbers and percentile ranks without a window over the whole frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.joins import lookup_join
from starloom.session import cut_lineage

PAGE_BITS = 16


def number_rows(df: DataFrame, name: str, start: int = 0, stored: bool = False) -> DataFrame:
    """Number rows start+1, start+2, ... without gaps, in the order they are stored.

    The frame is written first unless it already is what ``cut_lineage`` returned. A row's
    number is its place in its file plus the rows of the files before, so no row is moved or
    sorted and a repeated task gives equal numbers, at any number of rows. One small row per
    file is ordered in one task and broadcast.
    """
    frame = df if stored else cut_lineage(df)
    placed = frame.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_file")
        .withColumn(name, (F.lit(start) + F.col("_before") + F.col("_place") + 1).cast("long"))
        .drop("_file", "_place", "_before")
    )


def with_percent_rank(df: DataFrame, value: str, name: str, scale: int = 1) -> DataFrame:
    """percent_rank() of ``value`` over all rows, as an unrounded fraction; nulls come last.

    ``value * scale`` must be a whole number of 32 bits. Rows are first counted per
    distinct value, which removes ties; values are then summed up inside pages of
    65,536 neighbouring values, and pages after each other. Neither a page nor
    the list of pages can outgrow one task. Nothing runs before the result is asked for;
    ``df`` is read more than once: pass a stored frame if it is costly.
    """
    code = F.round(F.col(value) * F.lit(scale)).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(code.alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    paged = counts.withColumn("_page", F.shiftright("_code", PAGE_BITS))
    pages = paged.groupBy("_page").agg(F.sum("_n").alias("_page_n"))
    earlier = Window.orderBy("_page").rowsBetween(Window.unboundedPreceding, -1)
    starts = pages.select("_page", F.coalesce(F.sum("_page_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_page").orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    total = df.agg(F.count(F.lit(1))).scalar()
    known = df.agg(F.count(value)).scalar()
    below = paged.withColumn("_below", F.coalesce(F.sum("_n").over(inside), F.lit(0))) \
        .join(F.broadcast(starts), "_page").select(F.col("_code").alias("_on"), (F.col("_start") + F.col("_below")).alias("_less"))
    ranked = df.withColumn("_code", code).join(below, F.col("_code") == F.col("_on"), "left")
    rank = F.when(total > 1, F.coalesce("_less", known) / (total - 1)).otherwise(0.0)
    return ranked.withColumn(name, rank).drop("_code", "_on", "_less")


def with_rank_fraction(df: DataFrame, value: str, name: str) -> DataFrame:
    """percent_rank() of any orderable ``value`` over all rows, unrounded; nulls come last.

    Rows are counted per distinct value, so a hot value is one row from there on. The distinct
    values are dealt into ranges and stored with the number of their range; a window inside a
    range and prefix sums over the ranges' totals say how many rows lie below a value. No range
    holds more than its share of the distinct values. Runs jobs at once, unlike
    ``with_percent_rank``; ``df`` is read more than once: pass a stored frame if it is costly.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = cut_lineage(counts.repartitionByRange(value).withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.sum("_n").alias("_range_n")).select(
        "_range", F.coalesce(F.sum("_range_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = ranged.withColumn("_below", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        F.broadcast(starts), "_range").select(value, (F.col("_start") + F.col("_below")).alias("_less"))
    sizes = df.agg(F.count(F.lit(1)).alias("all"), F.count(value).alias("known")).first()
    ranked = lookup_join(df, cut_lineage(below), [value])
    whole = F.lit(max(sizes["all"] - 1, 1))
    rank = F.coalesce("_less", F.lit(sizes["known"])) / whole if sizes["all"] > 1 else F.lit(0.0)
    return ranked.withColumn(name, rank).drop("_less")
