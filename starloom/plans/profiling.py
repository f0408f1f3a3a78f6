"""Profiles of the source files, each one or two aggregations over text columns.

Inputs are the frames the CSV readers give: every column is text or null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import cleaning as C
from starloom.functions.columns import count_if, tag_list
from starloom.operators.joins import lookup_join
from starloom.plans.clean import REVIEW_KEY
from starloom.schemas import PROFILE_ATTRIBUTES, UNKNOWN

CATEGORY_LEVELS = ["primary_category", "secondary_category", "tertiary_category"]


def _long(row: DataFrame, names: list[str] | None = None, value: str = "value") -> DataFrame:
    """A one-row frame as (measure, value) rows."""
    return row.unpivot([], names or row.columns, "measure", value)


def _number(column: str):
    return F.col(column).try_cast("double")


# --- sizes ---------------------------------------------------------------------------------


def row_counts(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Rows per source file and in total: source, rows, columns."""
    n = F.count(F.lit(1)).alias("rows")
    catalogue = products.agg(n).select(
        F.lit("product_info").alias("source"), "rows",
        F.lit(len(products.columns)).cast("long").alias("columns"))
    per_file = reviews.groupBy(F.col("source_file").alias("source")).agg(n)
    total = reviews.agg(n).select(F.lit("reviews total").alias("source"), "rows")
    blank = F.lit(None).cast("long").alias("columns")
    return catalogue.unionByName(per_file.select("source", "rows", blank)).unionByName(
        total.select("source", "rows", blank))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column: measure is the column name."""
    return _long(df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in df.columns]), value="nulls")


# --- catalogue -------------------------------------------------------------------------------


def catalogue_summary(products: DataFrame) -> DataFrame:
    price, sale, rating = _number("price_usd"), _number("sale_price_usd"), _number("rating")
    brand = products.groupBy("brand_id").agg(F.countDistinct("brand_name").alias("names"))
    row = products.agg(
        (F.count("product_id") - F.countDistinct("product_id")).cast("double").alias("duplicate_product_ids"),
        F.countDistinct("brand_id").cast("double").alias("brand_ids"),
        F.countDistinct("brand_name").cast("double").alias("brand_names"),
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        count_if(price <= 0).cast("double").alias("price_not_positive"),
        count_if(sale > price).cast("double").alias("sale_above_price"),
        count_if(~rating.between(1, 5)).cast("double").alias("rating_out_of_range"),
    ).select("*", brand.agg(F.max("names").cast("double")).scalar().alias("names_per_brand_id"))
    return _long(row)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; nulls are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


# --- reviews ---------------------------------------------------------------------------------


def review_summary(reviews: DataFrame) -> DataFrame:
    """One row: distinct authors and products, date range, unreadable dates."""
    day = C.to_day(F.col("submission_time"))
    return reviews.agg(
        F.countDistinct("author_id").alias("authors"),
        F.countDistinct("product_id").alias("products"),
        F.min(day).alias("earliest"), F.max(day).alias("latest"),
        count_if(day.isNull()).alias("unreadable_dates"),
    )


def reviews_per_year(reviews: DataFrame) -> DataFrame:
    day = C.to_day(F.col("submission_time"))
    return reviews.where(day.isNotNull()).groupBy(F.year(day).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"))


def text_lengths(reviews: DataFrame, column: str = "review_text") -> DataFrame:
    """One row: lengths of whole texts in characters, missing texts, total volume.

    The median is taken from counts per length, so no task sorts all texts.
    """
    length = F.length(column)
    row = reviews.agg(
        count_if(F.col(column).isNull()).alias("missing"),
        F.min(length).alias("min_length"), F.max(length).alias("max_length"),
        F.round(F.avg(length), 0).alias("mean_length"), F.sum(length).alias("characters"),
        F.percentile(length, F.lit(0.5)).alias("_median"),
    )
    return row.withColumn("median_length", F.floor("_median")).drop("_median")


def duplicate_reviews(reviews: DataFrame) -> DataFrame:
    """One row: surplus rows on author and product, and with the date as well."""
    triple = reviews.groupBy(*REVIEW_KEY).agg(F.count(F.lit(1)).alias("n"))
    pair = triple.groupBy("author_id", "product_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("triples"))
    return pair.agg(
        F.sum(F.col("n") - 1).alias("pair_duplicates"),
        F.sum(F.col("n") - F.col("triples")).alias("triple_duplicates"),
        F.sum(F.col("triples") - 1).alias("difference"),
    )


def orphan_reviews(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: known products, reviewed products, reviews of unknown products."""
    per_product = reviews.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    known = products.select("product_id").distinct().withColumn("_known", F.lit(True))
    joined = per_product.join(known, "product_id", "left")
    row = joined.agg(
        F.count("product_id").alias("products_reviewed"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("orphan_rows"),
    )
    return row.select(
        products.agg(F.countDistinct("product_id")).scalar().alias("products_known"), "*")


def load_key_ranges(reviews: DataFrame) -> DataFrame:
    """Row-number range per file and, on every row, the surplus of the load key."""
    number = F.col("source_row_id").try_cast("bigint")
    surplus = (
        reviews.groupBy("source_row_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    )
    return reviews.groupBy("source_file").agg(
        F.min(number).alias("first_row"), F.max(number).alias("last_row")
    ).withColumn("duplicate_keys", surplus.scalar())


def attribute_consistency(reviews: DataFrame) -> DataFrame:
    """Do the four attributes belong to the author? (measure, value) rows.

    Reviews are first reduced to one row per author and combination, with a count.
    """
    combos = reviews.groupBy("author_id", *PROFILE_ATTRIBUTES).agg(F.count(F.lit(1)).alias("n"))
    per_author = combos.where(F.col("author_id").isNotNull()).groupBy("author_id").agg(
        F.sum("n").alias("reviews"),
        *[F.countDistinct(a).alias(a) for a in PROFILE_ATTRIBUTES],
    )
    mixed = reduce(lambda a, b: a | b, [F.col(a) > 1 for a in PROFILE_ATTRIBUTES])
    return _long(per_author.agg(
        F.count(F.lit(1)).alias("authors"),
        *[count_if(F.col(a) > 1).alias(f"authors_several_{a}") for a in PROFILE_ATTRIBUTES],
        *[F.max(a).alias(f"most_{a}") for a in PROFILE_ATTRIBUTES],
        count_if(mixed).alias("authors_mixed"),
        F.coalesce(F.sum(F.when(mixed, F.col("reviews"))), F.lit(0)).alias("reviews_of_mixed_authors"),
    ))


def attribute_combinations(reviews: DataFrame) -> DataFrame:
    """One row: attribute combinations that occur, and that could occur."""
    named = reviews.select(*[F.coalesce(a, F.lit(UNKNOWN)).alias(a) for a in PROFILE_ATTRIBUTES])
    present = named.distinct()
    counts = present.agg(
        F.count(F.lit(1)).alias("present"),
        *[F.countDistinct(a).alias(a) for a in PROFILE_ATTRIBUTES],
    )
    possible = reduce(lambda a, b: a * b, [F.col(a) for a in PROFILE_ATTRIBUTES])
    return counts.select("present", possible.alias("possible"))


def attribute_values(reviews: DataFrame) -> DataFrame:
    """Distinct values per attribute, to spot spellings and placeholders."""
    combos = reviews.select(*PROFILE_ATTRIBUTES).distinct()
    values = combos.unpivot([], PROFILE_ATTRIBUTES, "attribute", "value")
    return values.where(F.col("value").isNotNull()).distinct()


# --- category, helpfulness, repeated columns -------------------------------------------------


def category_levels(products: DataFrame) -> DataFrame:
    """One row: distinct values per level, distinct triples, most parents of a secondary."""
    triples = products.select(*CATEGORY_LEVELS).distinct()
    parents = category_parents(products).agg(F.max("parents")).scalar()
    return triples.agg(
        *[F.countDistinct(c).alias(c) for c in CATEGORY_LEVELS], F.count(F.lit(1)).alias("triples")
    ).withColumn("most_parents", parents)


def category_parents(products: DataFrame) -> DataFrame:
    named = products.where(F.col("secondary_category").isNotNull())
    return named.groupBy("secondary_category").agg(F.countDistinct("primary_category").alias("parents"))


def shared_secondaries(products: DataFrame, count: int = 10) -> DataFrame:
    """Secondary categories found under several primaries, the worst first."""
    shared = category_parents(products).where("parents > 1")
    return shared.orderBy(F.col("parents").desc(), "secondary_category").limit(count)


def helpfulness_rules(reviews: DataFrame) -> DataFrame:
    """One row: is a missing helpfulness the same as no votes, and do votes add up?"""
    total, up, down = (_number(f"total_{p}feedback_count") for p in ("", "pos_", "neg_"))
    no_votes = F.coalesce(total == 0, F.lit(False))
    unknown = F.col("helpfulness").isNull()
    return reviews.agg(
        count_if(no_votes).alias("no_votes"), count_if(unknown).alias("helpfulness_null"),
        count_if(no_votes != unknown).alias("disagree"),
        count_if(~(up + down).eqNullSafe(total)).alias("split_mismatch"),
    )


def repeated_columns(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: products whose repeated columns differ between reviews and catalogue.

    One review stands for its product: the smallest by the compared columns.
    """
    columns = ["product_name", "brand_name", "price_usd"]
    one = reviews.groupBy("product_id").agg(F.min(F.struct(*columns)).alias("_r"))
    known = products.select("product_id", *columns)
    joined = lookup_join(one, known, ["product_id"])
    tests = {}
    for c in columns:
        ours, theirs = F.col(f"_r.{c}"), F.col(c)
        if c == "price_usd":
            ours, theirs = ours.try_cast("double"), theirs.try_cast("double")
        # A missing value agrees with nothing, not even with another one.
        tests[f"{c}_differs"] = count_if(~F.coalesce(ours == theirs, F.lit(False)))
    return joined.agg(
        F.count(F.lit(1)).alias("products_compared"), *[t.alias(n) for n, t in tests.items()])


# --- multi-valued tags ------------------------------------------------------------------------


def tag_summary(products: DataFrame) -> DataFrame:
    """One row: products without tags, distinct tags, mean and most per product, all pairs."""
    sized = products.select(tag_list(F.col("highlights")).alias("tags")).withColumn("k", F.size("tags"))
    distinct = sized.select(F.explode("tags").alias("tag")).agg(F.countDistinct("tag")).scalar()
    return sized.agg(
        count_if(F.col("k") == 0).alias("products_without"),
        F.round(F.avg(F.when(F.col("k") > 0, F.col("k"))), 1).alias("mean_tags"),
        F.max("k").alias("most_tags"), F.sum("k").alias("pairs"),
    ).withColumn("distinct_tags", distinct)


def top_tags(products: DataFrame, count: int = 15) -> DataFrame:
    tags = products.select(F.explode(tag_list(F.col("highlights"))).alias("tag"))
    counted = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("products"))
    return counted.orderBy(F.col("products").desc(), "tag").limit(count)


# --- cutoff -----------------------------------------------------------------------------------


def cutoff_summary(reviews: DataFrame, cutoff) -> DataFrame:
    """One row: reviews on both sides of the cutoff, and dates with a time of day."""
    moment = F.col("submission_time").try_cast("timestamp_ntz")
    day = F.to_date(moment)
    return reviews.agg(
        count_if(day < F.lit(cutoff)).alias("before_cutoff"),
        count_if(day >= F.lit(cutoff)).alias("from_cutoff"),
        count_if(F.hour(moment) + F.minute(moment) + F.second(moment) > 0).alias("with_time"),
    )


def months_from(reviews: DataFrame, cutoff) -> DataFrame:
    day = C.to_day(F.col("submission_time"))
    return reviews.where(day >= F.lit(cutoff)).groupBy(
        F.date_format(day, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
