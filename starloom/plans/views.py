"""The eleven analytic views over the star.

Views that need nothing finer than a product first total the facts per product and
only then meet the dimensions. The fact table is therefore scanned once, shuffled
only as partial sums, and joined at one row per product: a product holding a third
of all reviews costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.columns import (
    band_order, count_if, length_bucket, length_order, percent, population_stddev, ratio,
)
from starloom.operators.joins import attach
from starloom.operators.keys import with_percent_rank
from starloom.plans.star import Star, read_star

SKINCARE = "Skincare"
HYPE_MIN_REVIEWS = 50


def _recommended() -> tuple[Column, Column]:
    """Yes answers, and answers given; an unanswered review counts in neither."""
    answer = F.col("is_recommended")
    return F.coalesce(F.sum(answer.cast("int")), F.lit(0)), F.count(answer)


def _totals(facts: DataFrame, *by: str) -> DataFrame:
    """Whole-number totals per group, from which every average is taken later."""
    yes, answered = _recommended()
    rating = F.col("rating").cast("long")
    return facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(rating).alias("stars"),
        F.sum(rating * rating).alias("stars_squared"),
        yes.alias("yes"), answered.alias("answered"),
        count_if(F.col("rating") == 5).alias("five"),
        count_if(F.col("rating") == 1).alias("one"),
    )


def _dated(star: Star) -> DataFrame:
    # The calendar has one row per day of the data, so every task can hold it.
    return star.fact.join(F.broadcast(star.date), "date_key")


def product_totals(star: Star) -> DataFrame:
    return _totals(star.fact, "product_key")


def _rolled_up(groups: DataFrame, *by: str, price: bool = False, spread: bool = False,
               extremes: bool = False) -> DataFrame:
    """Add up per-product totals. A group holds at most one row per product."""
    n = F.sum("n")
    measures = [
        n.alias("review_count"),
        F.count(F.lit(1)).alias("product_count"),
        ratio(F.sum("stars"), n, 4).alias("avg_rating"),
        percent(F.sum("yes"), F.sum("answered")).alias("recommend_pct"),
    ]
    if price:
        paid = F.sum(F.col("price_usd").cast("decimal(20,2)") * F.col("n").cast("decimal(12,0)"))
        priced = F.sum(F.when(F.col("price_usd").isNotNull(), F.col("n")))
        measures.append(ratio(paid, priced, 2).alias("avg_price_usd"))
    if spread:
        measures.append(
            population_stddev(F.sum("stars"), F.sum("stars_squared"), n).alias("rating_stddev"))
    if extremes:
        measures += [F.sum("five").alias("five_star"), F.sum("one").alias("one_star")]
    return groups.groupBy(*by).agg(*measures)


def rating_by_brand(star: Star) -> DataFrame:
    groups = product_totals(star).join(star.product, "product_key").join(star.brand, "brand_key")
    return _rolled_up(groups, "brand_key", "brand_name", price=True, extremes=True)


def rating_by_category(star: Star) -> DataFrame:
    groups = product_totals(star).join(star.product, "product_key")
    return _rolled_up(groups, "primary_category", "secondary_category", "tertiary_category", price=True)


def rating_by_brand_category(star: Star) -> DataFrame:
    groups = product_totals(star).join(star.product, "product_key").join(star.brand, "brand_key")
    return _rolled_up(groups, "brand_key", "brand_name", "secondary_category", price=True)


def rating_by_price_band(star: Star) -> DataFrame:
    groups = product_totals(star).join(star.product, "product_key")
    bands = _rolled_up(groups, "price_band", price=True, spread=True)
    return bands.withColumn("band_order", band_order(F.col("price_band")))


def _by_month(star: Star, *by: str) -> DataFrame:
    """Totals, reviewers and products per month.

    Distinct counts come from rows reduced to one per month and customer, and to one per month
    and product, so no fact row is copied for them.
    """
    yes, answered = _recommended()
    facts = _dated(star)
    customers = facts.groupBy(*by, "customer_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), yes.alias("yes"), answered.alias("answered"),
        F.sum("review_length").alias("length"), F.count("review_length").alias("lengths"),
        F.max("submission_date").alias("last"))
    months = customers.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n", "stars", "yes", "answered", "length", "lengths")],
        F.max("last").alias("last"), F.count("customer_key").alias("reviewer_count"))
    products = facts.select(*by, "product_key").distinct().groupBy(*by).agg(
        F.count("product_key").alias("product_count"))
    return months.join(products, list(by))


def review_trend_monthly(star: Star) -> DataFrame:
    return _by_month(star, "year", "month", "month_name").select(
        "year", "month", "month_name", F.col("n").alias("review_count"),
        ratio(F.col("stars"), F.col("n"), 4).alias("avg_rating"),
        percent(F.col("yes"), F.col("answered")).alias("recommend_pct"),
        "reviewer_count", "product_count",
        ratio(F.col("length"), F.col("lengths"), 1).alias("avg_review_length"),
        F.make_date("year", "month", F.lit(1)).alias("month_start"))


def rating_by_skin_type(star: Star, primary_category: str = SKINCARE) -> DataFrame:
    """Skin type by category, for one primary category only."""
    typed = attach(star.fact, star.profile.select("reviewer_profile_key", "skin_type"), ["reviewer_profile_key"])
    scope = star.product.where(F.col("primary_category") == primary_category)
    groups = _totals(typed, "skin_type", "product_key").join(scope, "product_key")
    return _rolled_up(groups, "skin_type", "primary_category", "secondary_category")


def rating_by_skin_tone(star: Star) -> DataFrame:
    by = ["skin_tone", "primary_category", "secondary_category"]
    toned = attach(star.fact, star.profile.select("reviewer_profile_key", "skin_tone"), ["reviewer_profile_key"])
    groups = _totals(toned, "skin_tone", "product_key").join(star.product, "product_key")
    ratings = _rolled_up(groups, *by, spread=True)

    # A reviewer counts once per group, so this part needs the reviewers themselves.
    levels = star.product.select("product_key", "primary_category", "secondary_category")
    reviewers = (
        attach(toned.select("skin_tone", "product_key", "customer_key"), levels, ["product_key"])
        .select(*by, "customer_key").distinct()
        .groupBy(*by).agg(F.count("customer_key").alias("reviewer_count"))
    )
    same = [ratings[c].eqNullSafe(reviewers[c]) for c in by]
    return ratings.join(reviewers, same[0] & same[1] & same[2]).select(
        *[ratings[c] for c in ratings.columns], reviewers["reviewer_count"]
    )


def kpi_summary(star: Star) -> DataFrame:
    """One row. Helpfulness is averaged over reviews that received votes only."""
    yes, answered = _recommended()
    voted = F.col("total_feedback_count") > 0
    helpful = F.when(voted, F.col("helpfulness"))
    customers = star.fact.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("stars"), yes.alias("yes"), answered.alias("answered"),
        F.sum(helpful).alias("helpful"), F.count(helpful).alias("rated"), count_if(voted).alias("voted"),
        F.min("submission_date").alias("first"), F.max("submission_date").alias("last"))
    products = star.fact.select("product_key").distinct()
    n = F.coalesce(F.sum("n"), F.lit(0))
    return customers.agg(
        n.alias("total_reviews"),
        F.count("customer_key").alias("total_reviewers"),
        ratio(F.sum("stars"), F.sum("n"), 4).alias("avg_rating"),
        percent(F.sum("yes"), F.sum("answered")).alias("recommend_pct"),
        F.round((F.sum("helpful") / F.nullif(F.sum("rated"), F.lit(0))).cast("double"), 4).alias("avg_helpfulness"),
        F.coalesce(F.sum("voted"), F.lit(0)).alias("reviews_with_feedback"),
        F.min("first").alias("earliest_review"),
        F.max("last").alias("latest_review"),
    ).select(
        "*",
        products.agg(F.count("product_key")).scalar().alias("products_reviewed"),
        star.product.agg(F.count(F.lit(1))).scalar().alias("products_in_catalogue"),
        star.brand.agg(F.count(F.lit(1))).scalar().alias("total_brands"),
    )


def hype_vs_reality(star: Star, min_reviews: int = HYPE_MIN_REVIEWS) -> DataFrame:
    """Percentile of popularity against percentile of rating, per product.

    hype_gap > 0 is more wanted than liked. The rating rank is taken on the rounded
    average, the gap on the unrounded ranks.
    """
    totals = product_totals(star).where(F.col("n") >= min_reviews)
    stats = totals.join(star.product, "product_key").join(star.brand, "brand_key").select(
        "product_key", "product_id", "product_name", "brand_name", "primary_category",
        "secondary_category", "price_usd", "price_band", "loves_count",
        F.col("n").alias("review_count"),
        ratio(F.col("stars"), F.col("n"), 4).alias("avg_rating"),
        percent(F.col("yes"), F.col("answered")).alias("recommend_pct"),
    )
    ranked = with_percent_rank(stats, "loves_count", "_loves")
    ranked = with_percent_rank(ranked, "avg_rating", "_rating", scale=10_000)
    return ranked.select(
        *stats.columns,
        F.round("_loves", 4).alias("loves_percentile"),
        F.round("_rating", 4).alias("rating_percentile"),
        F.round(F.col("_loves") - F.col("_rating"), 4).alias("hype_gap"),
    )


def volume_by_month(star: Star) -> DataFrame:
    """Monthly volume with rolling, cumulative and month-over-month figures.

    Frames count the months that occur, not calendar months. The cumulative
    rating is the plain mean of monthly means.
    """
    monthly = _by_month(star, "year", "month").select(
        "year", "month", F.col("n").alias("review_count"), "reviewer_count", "product_count",
        (F.col("stars") / F.col("n")).alias("_mean"),
        percent(F.col("yes"), F.col("answered")).alias("recommend_pct"),
        F.col("last").alias("_last"), F.make_date("year", "month", F.lit(1)).alias("month_start"))
    # One row per month from here on, so an undivided window is small.
    by_month = Window.orderBy("month_start")
    last_three = by_month.rowsBetween(-2, Window.currentRow)
    so_far = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous = F.lag("review_count").over(by_month)
    return monthly.select(
        "year", "month", "month_start", "review_count", "reviewer_count", "product_count",
        F.round("_mean", 4).alias("avg_rating"),
        "recommend_pct",
        F.round(F.avg("_mean").over(last_three), 4).alias("rolling_3m_avg_rating"),
        F.round(F.avg("_mean").over(so_far), 4).alias("cumulative_avg_rating"),
        F.sum("review_count").over(so_far).alias("cumulative_reviews"),
        previous.alias("prev_month_reviews"),
        percent(F.col("review_count") - previous, previous).alias("mom_growth_pct"),
        (F.trunc(F.max("_last").over(everything), "month") == F.col("month_start"))
        .alias("is_partial_month"),
    )


def rating_by_review_length(star: Star) -> DataFrame:
    length = F.col("review_length")
    n = F.count(F.lit(1))
    yes, answered = _recommended()
    rating = F.col("rating").cast("long")
    return star.fact.groupBy(
        length_bucket(length).alias("length_bucket"), length_order(length).alias("bucket_order")
    ).agg(
        n.alias("review_count"),
        ratio(F.sum(length), F.count(length), 1).alias("avg_review_length"),
        ratio(F.sum(rating), n, 4).alias("avg_rating"),
        percent(yes, answered).alias("recommend_pct"),
        population_stddev(F.sum(rating), F.sum(rating * rating), n).alias("rating_stddev"),
        percent(count_if(rating == 1), n).alias("pct_1_star"),
        percent(count_if(rating == 5), n).alias("pct_5_star"),
        percent(count_if(rating.isin(1, 5)), n).alias("pct_extreme"),
    )


VIEWS = {
    "vw_rating_by_brand": rating_by_brand,
    "vw_rating_by_category": rating_by_category,
    "vw_review_trend_monthly": review_trend_monthly,
    "vw_rating_by_price_band": rating_by_price_band,
    "vw_rating_by_skin_type": rating_by_skin_type,
    "vw_kpi_summary": kpi_summary,
    "vw_hype_vs_reality": hype_vs_reality,
    "vw_review_volume_by_month": volume_by_month,
    "vw_rating_by_skin_tone": rating_by_skin_tone,
    "vw_rating_by_review_length": rating_by_review_length,
    "vw_rating_by_brand_category": rating_by_brand_category,
}

# Views that cover every fact row, so their counts must add up to the fact count.
FULL_POPULATION = [
    "vw_kpi_summary", "vw_rating_by_brand", "vw_rating_by_category",
    "vw_rating_by_brand_category", "vw_rating_by_price_band", "vw_review_trend_monthly",
    "vw_review_volume_by_month", "vw_rating_by_skin_tone", "vw_rating_by_review_length",
]


# Warehouses whose views are registered, by session: the load refreshes them.
_live: dict[str, tuple[str, dict]] = {}


def register_views(spark: SparkSession, source: Star | str, **parameters) -> list[str]:
    """Make every view available to SQL under its name. No job runs.

    ``source`` is a star, or the root of a stored warehouse; the views of a warehouse follow
    every later load of this session. ``parameters`` (primary_category, min_reviews) go to
    the views that take them.
    """
    star = read_star(spark, source) if isinstance(source, str) else source
    if isinstance(source, str):
        _live[spark.sparkContext.applicationId] = source, parameters
    for name, view in VIEWS.items():
        wanted = {k: v for k, v in parameters.items() if k in view.__code__.co_varnames[:view.__code__.co_argcount]}
        view(star, **wanted).createOrReplaceTempView(name)
    return list(VIEWS)


def refresh_views(spark: SparkSession, root: str) -> None:
    """Point the registered views of a warehouse at its tables as they are now."""
    live = _live.get(spark.sparkContext.applicationId)
    if live and live[0] == root:
        register_views(spark, root, **live[1])
