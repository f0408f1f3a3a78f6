"""Raw rows to third normal form, and back to flat staging rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.joins import lookup_join
from starloom.operators.upsert import Inserted, insert_absent
from starloom.schemas import (
    NF_AUTHOR, NF_BRAND, NF_CATEGORY, NF_LOOKUPS, NF_PRODUCT, NF_REVIEW, PROFILE_ATTRIBUTES,
    RAW_PRODUCT, RAW_REVIEW, STAGED_PRODUCT, STAGED_REVIEW, UNKNOWN,
)
from starloom.sources import layers

CATEGORY_LEVELS = list(NF_CATEGORY.key)


def brands(products: DataFrame) -> DataFrame:
    return products.select("brand_id", "brand_name").distinct()


def categories(products: DataFrame) -> DataFrame:
    return products.select(*CATEGORY_LEVELS).distinct()


def authors(reviews: DataFrame) -> DataFrame:
    return reviews.select("author_id").distinct()


def attribute_values(reviews: DataFrame, attribute: str) -> DataFrame:
    return reviews.select(attribute).where(F.col(attribute).isNotNull()).distinct()


def nf_products(products: DataFrame, category: DataFrame) -> DataFrame:
    """Catalogue rows with their category number; missing levels match each other."""
    lookup = category.select(*CATEGORY_LEVELS, "category_id")
    joined = lookup_join(products, lookup, CATEGORY_LEVELS, null_safe=True)
    return joined.where(F.col("category_id").isNotNull()).select(*NF_PRODUCT.names)


def nf_reviews(reviews: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Reviews with the numbers of their four attributes; a missing attribute stays null."""
    renamed = reviews.withColumnRenamed("submission_time", "submission_date")
    joined = reduce(
        lambda df, a: lookup_join(df, lookups[a].select(a, f"{a}_id"), [a]),
        PROFILE_ATTRIBUTES, renamed,
    )
    return joined.select(*[c for c in NF_REVIEW.names if c != "review_id"])


def staged_products(product: DataFrame, brand: DataFrame, category: DataFrame) -> DataFrame:
    return (
        product.join(brand, "brand_id").join(category, "category_id").select(*STAGED_PRODUCT.names)
    )


def staged_reviews(review: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Flat reviews without their text; a missing attribute becomes a named value."""
    joined = reduce(
        lambda df, a: lookup_join(df, lookups[a].select(f"{a}_id", a), [f"{a}_id"]),
        PROFILE_ATTRIBUTES, review.drop("review_text", "review_title"),
    )
    named = {a: F.coalesce(F.col(a), F.lit(UNKNOWN)) for a in PROFILE_ATTRIBUTES}
    return joined.withColumns(named).select(*STAGED_REVIEW.names)


def rebuild_staging(spark: SparkSession, root: str) -> dict[str, int]:
    """raw -> nf (only new keys) -> staging (rebuilt). Returns rows per staging table."""
    products = layers.read_table(spark, root, RAW_PRODUCT)
    reviews = layers.read_table(spark, root, RAW_REVIEW)

    def brand_category_product():
        insert_absent(brands(products), root, NF_BRAND)
        insert_absent(categories(products), root, NF_CATEGORY)
        insert_absent(nf_products(products, layers.read_table(spark, root, NF_CATEGORY)), root, NF_PRODUCT)

    # Only products and reviews refer to other tables, so the rest is loaded side by side.
    with ThreadPoolExecutor(max_workers=4) as pool:
        branches = [pool.submit(brand_category_product), pool.submit(insert_absent, authors(reviews), root, NF_AUTHOR)]
        branches += [pool.submit(insert_absent, attribute_values(reviews, attribute), root, table)
                     for attribute, table in NF_LOOKUPS.items()]
    for branch in branches:
        branch.result()
    category = layers.read_table(spark, root, NF_CATEGORY)
    lookups = {a: layers.read_table(spark, root, t) for a, t in NF_LOOKUPS.items()}
    load_nf_reviews(spark, root, reviews, lookups)

    flat_products = staged_products(
        layers.read_table(spark, root, NF_PRODUCT),
        layers.read_table(spark, root, NF_BRAND), category,
    )
    flat_reviews = staged_reviews(layers.read_table(spark, root, NF_REVIEW), lookups)
    counts = layers.publish(root, {STAGED_PRODUCT: flat_products, STAGED_REVIEW: flat_reviews})
    return {"product": counts[STAGED_PRODUCT], "review": counts[STAGED_REVIEW]}


def load_nf_reviews(spark, root, reviews, lookups) -> Inserted:
    # The raw key is checked while cleaning, so no row needs to be picked here. The rows are the
    # stored raw layer with small lookups attached: read twice, not copied first.
    return insert_absent(nf_reviews(reviews, lookups), root, NF_REVIEW, unique=True, stored=True)
