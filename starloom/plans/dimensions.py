"""Dimensions of the star and their loads."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import count_if, date_key, price_band
from starloom.operators.joins import lookup_join
from starloom.operators.quality import PRODUCT_CHECKS, run_quality_checks
from starloom.operators.reconcile import account_for_rows
from starloom.operators.upsert import Inserted, Prepared, prepare_insert
from starloom.schemas import (
    DIM_BRAND, DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_PROFILE, FACT, PRODUCT_DROP_REASONS,
    PROFILE_ATTRIBUTES, STAGED_PRODUCT, STAGED_REVIEW,
)
from starloom.session import cut_lineage
from starloom.sources import layers

CALENDAR_PADDING_DAYS = 30
STAR_TABLES = (DIM_BRAND, DIM_PRODUCT, DIM_CUSTOMER, DIM_PROFILE, DIM_DATE, FACT)


def brand_rows(products: DataFrame) -> DataFrame:
    return products.select("brand_id", "brand_name").distinct()


def customer_rows(reviews: DataFrame) -> DataFrame:
    return reviews.select(F.col("author_id").alias("customer_id")).distinct()


def profile_rows(reviews: DataFrame) -> DataFrame:
    """The attribute combinations that occur: one dimension for four attributes."""
    return reviews.select(*PROFILE_ATTRIBUTES).distinct()


def resolve_products(products: DataFrame, brand: DataFrame) -> DataFrame:
    """Catalogue rows with brand key, price band and, where unusable, a drop reason."""
    keyed = lookup_join(products, brand.select("brand_id", "brand_key"), ["brand_id"])
    return keyed.withColumns(
        {"price_band": price_band(F.col("price_usd")),
         "drop_reason": F.when(F.col("brand_key").isNull(), PRODUCT_DROP_REASONS[0])}
    )


def product_rows(resolved: DataFrame) -> DataFrame:
    wanted = [c for c in DIM_PRODUCT.names if c != DIM_PRODUCT.surrogate]
    return resolved.where(F.col("drop_reason").isNull()).select(*wanted)


def date_bounds(reviews: DataFrame) -> DataFrame:
    """First and last calendar day: the data's range, padded on both sides."""
    return reviews.agg(
        F.date_sub(F.min("submission_date"), CALENDAR_PADDING_DAYS).alias("start_date"),
        F.date_add(F.max("submission_date"), CALENDAR_PADDING_DAYS).alias("end_date"),
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between start_date and end_date, both included."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    days = bounds.select(F.explode(F.sequence("start_date", "end_date")).alias("full_date"))
    return days.select(
        date_key(day).alias("date_key"), day,
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.weekofyear(day).alias("week"),
        F.day(day).alias("day"), weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"), weekday.isin(6, 7).alias("is_weekend"),
    )


def calendar_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    return calendar(spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date")))


def prepare_products(spark: SparkSession, root: str, brand: DataFrame) -> Prepared:
    """Resolve, account for every row, pass the gate, write new products."""
    products = layers.read_table(spark, root, STAGED_PRODUCT)
    resolved = cut_lineage(resolve_products(products, brand))
    rows = product_rows(resolved)
    counts = resolved.agg(
        F.count(F.lit(1)).alias("all"), count_if(F.col("drop_reason").isNotNull()).alias("dropped")
    ).first()
    account_for_rows(products.count(), counts["all"] - counts.dropped,
                        {PRODUCT_DROP_REASONS[0]: counts.dropped}, "dim_product")
    run_quality_checks(rows, "dim_product", PRODUCT_CHECKS)
    return prepare_insert(rows, root, DIM_PRODUCT, unique=True, stored=True, targets={DIM_BRAND.name: brand})


def prepare_calendar(spark: SparkSession, root: str) -> Prepared:
    bounds = date_bounds(layers.read_table(spark, root, STAGED_REVIEW))
    return prepare_insert(calendar(bounds.where("start_date is not null")), root, DIM_DATE, unique=True)


def load_calendar(spark: SparkSession, root: str) -> Inserted:
    prepared = prepare_calendar(spark, root)
    if prepared.versions:
        layers.put_in_force(spark, root, prepared.versions, keep=True)
    return prepared.done


def load_dimensions(spark: SparkSession, root: str) -> dict[str, Inserted]:
    """Every dimension in full: a review may only refer to members already loaded.

    Only products depend on another dimension, so the branches run side by side. They write
    and count; once all are done their rows are put in force in one step, or none if one fails.
    """
    products = layers.read_table(spark, root, STAGED_PRODUCT)
    reviews = layers.read_table(spark, root, STAGED_REVIEW)
    layers.create_missing(spark, root, list(STAR_TABLES))

    def brand_then_product():
        brand = prepare_insert(brand_rows(products), root, DIM_BRAND)
        try:
            return brand, prepare_products(spark, root, layers.read_with(spark, root, DIM_BRAND, brand.versions))
        except BaseException:
            layers.discard(spark, root, brand.versions)
            raise

    with ThreadPoolExecutor(max_workers=4) as pool:
        branches = {
            "brand, product": pool.submit(brand_then_product),
            "customer": pool.submit(lambda: (prepare_insert(customer_rows(reviews), root, DIM_CUSTOMER, unique=True),)),
            "profile": pool.submit(lambda: (prepare_insert(profile_rows(reviews), root, DIM_PROFILE, unique=True),)),
            "date": pool.submit(lambda: (prepare_calendar(spark, root),)),
        }
    failed = [b.exception() for b in branches.values() if b.exception()]
    found = {name: prepared for names, b in branches.items() if not b.exception()
             for name, prepared in zip(names.split(", "), b.result())}
    versions = [v for prepared in found.values() for v in prepared.versions]
    if failed:
        layers.discard(spark, root, versions)
        raise failed[0]
    if versions:
        layers.put_in_force(spark, root, versions, keep=True)
    return {name: prepared.done for name, prepared in found.items()}
