"""Cleaning of the catalogue and the reviews: text in, typed and unique rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import cleaning as C
from starloom.functions.columns import count_if, strip
from starloom.operators.dedup import keep_first, require_dependency, require_unique
from starloom.schemas import PRODUCT_FLAGS, PROFILE_ATTRIBUTES, RAW_PRODUCT, RAW_REVIEW
from starloom.session import cut_lineage

# --- fixed values -----------------------------------------------------------
REVIEW_KEY = ["author_id", "product_id", "submission_time"]
REVIEW_ORDER = ["source_file", "source_row_id"]
EYE_COLOR_SPELLING = {"Grey": "gray"}
SKIN_TONE_PLACEHOLDER = "notSureST"

PRODUCT_WHOLE = ["brand_id", "loves_count", "reviews", "child_count"]
PRODUCT_DECIMAL = ["rating", "price_usd", "value_price_usd", "sale_price_usd",
                   "child_max_price", "child_min_price"]
PRODUCT_BLANKS = ["size", "variation_type", "variation_value", "variation_desc", "ingredients",
                  "highlights", "secondary_category", "tertiary_category"]
REVIEW_WHOLE = ["source_row_id", "rating", "total_feedback_count", "total_neg_feedback_count",
                "total_pos_feedback_count"]
REVIEW_DECIMAL = ["helpfulness", "price_usd"]
REVIEW_BLANKS = ["review_text", "review_title", *PROFILE_ATTRIBUTES]
# -----------------------------------------------------------------------------


class CleaningError(ValueError):
    """The source breaks a precondition of the cleaning step."""


def trim_all(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: strip(c) for c, t in raw.dtypes if t == "string"})


def trimmed_cells(raw: DataFrame) -> DataFrame:
    """One row: rows read, and cells that trimming really changes (a null is no change)."""
    changed: Column = F.lit(0)
    for c, t in raw.dtypes:
        if t == "string":
            changed = changed + F.when(~F.col(c).eqNullSafe(strip(c)), 1).otherwise(0)
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.coalesce(F.sum(changed.cast("long")), F.lit(0)).alias("trimmed_cells"),
    )


def _typed(df: DataFrame, table, whole, decimals, flags) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    rules = {c: C.to_whole(F.col(c), kinds[c]) for c in whole}
    rules |= {c: C.to_decimal(F.col(c), kinds[c]) for c in decimals}
    rules |= {c: C.to_flag(F.col(c)) for c in flags}
    return df.withColumns(rules)


def _refuse(df: DataFrame, faults: dict[str, Column], what: str) -> None:
    found = df.agg(*[count_if(test).alias(name) for name, test in faults.items()]).first()
    bad = {name: found[name] for name in faults if found[name]}
    if bad:
        raise CleaningError(f"{what}: " + ", ".join(f"{n} {name}" for name, n in bad.items()))


# --- catalogue ------------------------------------------------------------------------


def distinct_products(raw: DataFrame) -> DataFrame:
    return trim_all(raw).dropDuplicates()


def check_products(products: DataFrame) -> None:
    """Refuse repeated product ids, a brand id with two names, and unusable values."""
    require_unique(products, ["product_id"], "products")
    require_dependency(products, "brand_id", "brand_name", "products")
    faults = {f"fractional {c}": C.is_fraction(F.col(c)) for c in PRODUCT_WHOLE}
    faults |= {f"unreadable {c}": C.is_bad_flag(F.col(c)) for c in PRODUCT_FLAGS}
    _refuse(products, faults, "products")


def type_products(products: DataFrame) -> DataFrame:
    df = _typed(products, RAW_PRODUCT, PRODUCT_WHOLE, PRODUCT_DECIMAL, PRODUCT_FLAGS)
    df = df.withColumns({c: C.blank_to_null(F.col(c)) for c in PRODUCT_BLANKS})
    return df.select(*RAW_PRODUCT.names)


def clean_products(raw: DataFrame) -> DataFrame:
    products = cut_lineage(distinct_products(raw))
    check_products(products)
    return type_products(products)


# --- reviews ----------------------------------------------------------------------------


def distinct_reviews(raw: DataFrame) -> DataFrame:
    """Trimmed reviews, the first of each author, product and date text.

    "First" follows the file name and then the row number inside the file.
    """
    trimmed = trim_all(raw).withColumn("source_row_id", C.to_whole(F.col("source_row_id")))
    return keep_first(trimmed, REVIEW_KEY, REVIEW_ORDER)


def check_reviews(reviews: DataFrame) -> None:
    """Refuse a repeated load key, unreadable dates, and unusable values."""
    require_unique(reviews, ["source_row_id", "product_id"], "reviews")
    faults = {"unreadable submission_time": C.to_day(F.col("submission_time")).isNull()}
    faults |= {f"fractional {c}": C.is_fraction(F.col(c).cast("string")) for c in REVIEW_WHOLE}
    faults["unreadable is_recommended"] = C.is_bad_flag(F.col("is_recommended"))
    _refuse(reviews, faults, "reviews")


def normalise_values(reviews: DataFrame) -> DataFrame:
    return reviews.replace(EYE_COLOR_SPELLING, subset=["eye_color"]).withColumn(
        "skin_tone", F.nullif(F.col("skin_tone"), F.lit(SKIN_TONE_PLACEHOLDER))
    )


def type_reviews(reviews: DataFrame) -> DataFrame:
    df = normalise_values(reviews).withColumns(
        {"source_row_id": F.col("source_row_id").cast("string"),
         "review_length": F.length("review_text"),
         "submission_time": C.to_day(F.col("submission_time"))}
    )
    df = _typed(df, RAW_REVIEW, REVIEW_WHOLE, REVIEW_DECIMAL, ["is_recommended"])
    df = df.withColumns({c: C.blank_to_null(F.col(c)) for c in REVIEW_BLANKS})
    return df.select(*RAW_REVIEW.names)


def clean_reviews(raw: DataFrame) -> DataFrame:
    # The trimmed rows are stored: the checks read a few of their columns, not the source again.
    reviews = distinct_reviews(raw)
    check_reviews(reviews)
    return type_reviews(reviews)


def review_steps(raw: DataFrame) -> DataFrame:
    """Row and cell accounting of the review cleaning: step, rows."""
    kept = cut_lineage(distinct_reviews(raw).agg(
        F.count(F.lit(1)).alias("rows_out"),
        count_if(F.col("eye_color").isin(list(EYE_COLOR_SPELLING))).alias("eye_color_respelled"),
        count_if(F.col("skin_tone") == SKIN_TONE_PLACEHOLDER).alias("skin_tone_placeholder"),
    ))
    steps = trimmed_cells(raw).select("*", kept.select("rows_out").scalar().alias("rows_out"))
    first = steps.withColumn("duplicates_dropped", F.col("rows_in") - F.col("rows_out"))
    return first.unpivot([], first.columns, "step", "rows").unionByName(
        kept.unpivot([], ["eye_color_respelled", "skin_tone_placeholder"], "step", "rows")
    )


def product_steps(raw: DataFrame) -> DataFrame:
    """Row and cell accounting of the catalogue cleaning: step, rows."""
    kept = distinct_products(raw).agg(F.count(F.lit(1)).alias("rows_out"))
    steps = trimmed_cells(raw).select("*", kept.scalar().alias("rows_out"))
    steps = steps.withColumn("duplicates_dropped", F.col("rows_in") - F.col("rows_out"))
    return steps.unpivot([], steps.columns, "step", "rows")
