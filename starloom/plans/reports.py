"""Parameterised questions on the views. An empty selection always means no filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import (
    all_of, contains_text, selected, short_label, weighted_mean,
)
from starloom.plans import views
from starloom.plans.star import Star
from starloom.schemas import UNKNOWN
from starloom.session import cut_lineage

SKIN_TYPE_MIN_REVIEWS = 1000


def _down(column: str):
    return F.col(column).desc_nulls_last()


def _up(column: str):
    return F.col(column).asc_nulls_last()


# --- brands and categories ------------------------------------------------------------


def brand_ranking(star: Star, min_reviews: int = 500, categories=(), brands=()) -> DataFrame:
    """Brands by rating. A category selection re-weights the brand's categories."""
    if not categories:
        ranked = views.rating_by_brand(star).select("brand_name", "review_count", "avg_rating")
        keep = all_of(F.col("review_count") >= min_reviews, selected("brand_name", brands))
        return ranked.where(keep).orderBy(_down("avg_rating"), "brand_name")
    scope = all_of(selected("secondary_category", categories), selected("brand_name", brands))
    ranked = views.rating_by_brand_category(star).where(scope).groupBy("brand_name").agg(
        weighted_mean("avg_rating", "review_count").alias("avg_rating"),
        F.sum("review_count").alias("review_count"),
    )
    return ranked.where(F.col("review_count") >= min_reviews).orderBy(_down("avg_rating"), "brand_name")


def brand_extremes(star: Star, ends: int = 10, **filters) -> DataFrame:
    """The best and the worst brands with their distance from the overall average."""
    # One row per brand, read three times below.
    ranking = cut_lineage(brand_ranking(star, **filters))
    best = ranking.orderBy(_down("avg_rating"), "brand_name").limit(ends)
    worst = ranking.orderBy(_up("avg_rating"), F.col("brand_name").desc()).limit(ends)
    overall = views.kpi_summary(star).select("avg_rating").scalar()
    spread = ranking.agg(F.max("avg_rating") - F.min("avg_rating")).scalar()
    return (
        best.unionByName(worst).dropDuplicates(["brand_name"])
        .withColumns({
            "delta": F.round(F.col("avg_rating") - overall, 4),
            "spread": F.round(spread, 4),
        })
        .orderBy("delta", "brand_name")
    )


def top_brands(star: Star, count: int = 5, min_reviews: int = 500, best: bool = True) -> DataFrame:
    rows = views.rating_by_brand(star).where(F.col("review_count") >= min_reviews).select(
        "brand_name", "review_count", "avg_rating", "recommend_pct", "avg_price_usd")
    first = _down("avg_rating") if best else _up("avg_rating")
    return rows.orderBy(first, "brand_name").limit(count)


def category_ranking(star: Star, categories=()) -> DataFrame:
    scope = all_of(selected("secondary_category", categories))
    ranked = views.rating_by_category(star).where(scope).groupBy("secondary_category").agg(
        F.sum("review_count").alias("reviews"),
        weighted_mean("avg_rating", "review_count").alias("avg_rating"),
    )
    return ranked.orderBy(_up("avg_rating"), "secondary_category")


# --- price --------------------------------------------------------------------------------


def price_band_series(star: Star) -> DataFrame:
    return views.rating_by_price_band(star).select(
        "price_band", "band_order", "review_count", "product_count", "avg_rating",
        "recommend_pct", "rating_stddev",
    ).orderBy(_up("band_order"))


def band_peaks(star: Star) -> DataFrame:
    """One row: the best rated band, the most consistent one, and whether they agree."""
    bands = views.rating_by_price_band(star)
    place = F.col("band_order")
    # Bands are few; the earlier band wins a tie, as the first row would.
    peak = F.min_by("price_band", F.struct(-F.col("avg_rating"), place))
    tight = F.min_by("price_band", F.struct(F.col("rating_stddev"), place))
    return bands.agg(
        peak.alias("peak_band"), F.max("avg_rating").alias("peak_rating"),
        tight.alias("tightest_band"), F.min("rating_stddev").alias("tightest_stddev"),
        F.max_by("price_band", "band_order").alias("top_band"),
        F.max_by("rating_stddev", "band_order").alias("top_band_stddev"),
    ).withColumn("same_band", F.col("peak_band") == F.col("tightest_band"))


# --- popularity against rating --------------------------------------------------------------


def hype_list(star: Star, categories=(), brands=(), min_reviews: int = views.HYPE_MIN_REVIEWS) -> DataFrame:
    keep = all_of(selected("secondary_category", categories), selected("brand_name", brands))
    return views.hype_vs_reality(star, min_reviews).where(keep).select(
        "product_id", "product_name", "brand_name", "secondary_category", "price_usd",
        "loves_count", "review_count", "avg_rating", "hype_gap",
    )


def overhyped(rows: DataFrame, count: int = 10) -> DataFrame:
    return rows.orderBy(_down("hype_gap"), "product_id").limit(count)


def sleeper_hits(rows: DataFrame, count: int = 10) -> DataFrame:
    return rows.orderBy(_up("hype_gap"), "product_id").limit(count)


def hype_top_bottom(star: Star, count: int = 10, **filters) -> DataFrame:
    """Both ends of the hype list, told apart by ``side``."""
    rows = hype_list(star, **filters)
    return overhyped(rows, count).withColumn("side", F.lit("overhyped")).unionByName(
        sleeper_hits(rows, count).withColumn("side", F.lit("sleeper hit")))


def hype_labels(star: Star, count: int = 3, **filters) -> DataFrame:
    """Chart labels of the most overhyped products."""
    label = F.concat_ws(" · ", "brand_name", short_label(F.col("product_name")))
    return overhyped(hype_list(star, **filters), count).select(
        "product_id", "loves_count", "avg_rating", label.alias("label"))


def product_explorer(
    star: Star, categories=(), brands=(), search: str = "",
    min_reviews: int = views.HYPE_MIN_REVIEWS,
) -> DataFrame:
    keep = all_of(selected("secondary_category", categories), selected("brand_name", brands),
                  contains_text("product_name", search))
    return views.hype_vs_reality(star, min_reviews).where(keep).select(
        "brand_name", "product_name", "secondary_category", "price_usd", "review_count",
        "avg_rating", "recommend_pct", "loves_count", "hype_gap",
    ).orderBy(_down("review_count"), "product_name")


# --- reviewers and review length --------------------------------------------------------------


def skin_type_ranking(
    star: Star, categories=(), primary_category: str = views.SKINCARE,
    min_reviews: int = SKIN_TYPE_MIN_REVIEWS,
) -> DataFrame:
    scope = all_of(selected("secondary_category", categories))
    ranked = views.rating_by_skin_type(star, primary_category).where(scope).groupBy("skin_type").agg(
        F.sum("review_count").alias("reviews"),
        weighted_mean("avg_rating", "review_count").alias("avg_rating"),
    )
    return ranked.where(F.col("reviews") >= min_reviews).orderBy(_down("avg_rating"), "skin_type")


def skin_tone_totals(star: Star) -> DataFrame:
    return views.rating_by_skin_tone(star).groupBy("skin_tone").agg(
        F.sum("review_count").alias("reviews"),
        weighted_mean("avg_rating", "review_count").alias("avg_rating"),
    ).orderBy(_down("reviews"), "skin_tone")


def length_shares(star: Star) -> DataFrame:
    """Length buckets in order; a missing length is no length and stays out."""
    return views.rating_by_review_length(star).where(F.col("length_bucket") != UNKNOWN).select(
        "length_bucket", "bucket_order", "review_count", "avg_rating", "rating_stddev",
        "pct_1_star", "pct_5_star",
    ).orderBy("bucket_order")


def length_contrast(star: Star) -> DataFrame:
    """One row: the shares of the shortest and of the longest bucket."""
    shares = length_shares(star)
    ends = []
    for end, pick in (("shortest", F.min_by), ("longest", F.max_by)):
        ends += [pick(c, "bucket_order").alias(f"{end}_{c}")
                 for c in ("length_bucket", "pct_1_star", "pct_5_star", "rating_stddev")]
    return shares.agg(*ends, F.round(F.max("avg_rating") - F.min("avg_rating"), 4).alias("rating_spread"))


# --- time ------------------------------------------------------------------------------------


def trend_series(star: Star) -> DataFrame:
    return views.volume_by_month(star).select(
        "month_start", "review_count", "avg_rating", "rolling_3m_avg_rating", "is_partial_month",
    ).orderBy("month_start")


def trend_peaks(star: Star) -> DataFrame:
    """One row: the busiest month and the month rated lowest; the earlier wins a tie."""
    months = views.volume_by_month(star)
    busiest = F.struct(-F.col("review_count"), F.col("month_start"))
    lowest = F.struct(F.col("avg_rating"), F.col("month_start"))
    return months.agg(
        F.min_by("month_start", busiest).alias("peak_month"),
        F.max("review_count").alias("peak_reviews"),
        F.min_by("month_start", lowest).alias("lowest_month"),
        F.min("avg_rating").alias("lowest_rating"),
    )


def yearly_trend(star: Star) -> DataFrame:
    return views.volume_by_month(star).groupBy("year").agg(
        F.sum("review_count").alias("reviews"),
        weighted_mean("avg_rating", "review_count").alias("avg_rating"),
    ).orderBy("year")


def latest_months(star: Star, count: int = 3) -> DataFrame:
    return views.volume_by_month(star).select(
        "month_start", "review_count", "is_partial_month"
    ).orderBy(F.col("month_start").desc()).limit(count)


# --- selections and headline ----------------------------------------------------------------


def category_options(star: Star) -> DataFrame:
    named = views.rating_by_category(star).where(F.col("secondary_category").isNotNull())
    return named.select("secondary_category").distinct().orderBy("secondary_category")


def brand_options(star: Star, categories=()) -> DataFrame:
    scope = all_of(selected("secondary_category", categories))
    rows = views.rating_by_brand_category(star).where(scope)
    return rows.select("brand_name").distinct().orderBy("brand_name")


def kpi_with_delta(star: Star, baseline: int | None = None) -> DataFrame:
    """Headline figures and the reviews added since a remembered total."""
    delta = F.col("total_reviews") - F.lit(baseline) if baseline is not None else F.lit(None).cast("long")
    return views.kpi_summary(star).withColumn("reviews_added", delta)
