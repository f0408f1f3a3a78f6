"""Reports that show whether the layers and the views agree with each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import count_if
from starloom.operators.dedup import repeated_keys
from starloom.operators.joins import lookup_join
from starloom.plans import views
from starloom.plans.star import Star
from starloom.schemas import FACT_DROP_REASONS, FACT_KEYS, PROFILE_ATTRIBUTES
from starloom.session import cut_lineage


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _rows(df: DataFrame):
    return df.agg(F.count(F.lit(1)).alias("n"))


# --- layers -------------------------------------------------------------------------------


def layer_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Rows per table next to the expected count, where one is known."""
    known = expected or {}
    return _stack([
        _rows(df).select(
            F.lit(name).alias("table_name"), F.col("n").alias("rows"),
            F.lit(known.get(name)).cast("long").alias("expected"),
        )
        for name, df in tables.items()
    ])


def layer_gaps(raw: DataFrame, nf: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: an entity's rows in the three layers and the rows lost on the way."""
    return _rows(raw).select(
        F.col("n").alias("raw_rows"), _rows(nf).scalar().alias("nf_rows"),
        _rows(staged).scalar().alias("staged_rows"),
        (F.col("n") - _rows(staged).scalar()).alias("gap"),
    )


def _unmatched(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent; counted per key before the join."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    present = parent.select(F.col(key).alias("_parent"))
    return per_key.join(present, per_key[key] == present["_parent"], "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("bad"))


def integrity_checks(review, product, author, brand, category, staged) -> DataFrame:
    """Six counts that must all be zero: check_name, bad."""
    no_attribute = reduce(lambda a, b: a | b, [F.col(a).isNull() for a in PROFILE_ATTRIBUTES])
    checks = {
        "reviews without product": _unmatched(review, product, "product_id"),
        "reviews without author": _unmatched(review, author, "author_id"),
        "products without brand": _unmatched(product, brand, "brand_id"),
        "products without category": _unmatched(product, category, "category_id"),
        "staged reviews without attribute": staged.agg(count_if(no_attribute).alias("bad")),
        "repeated load keys": repeated_keys(review, ["source_row_id", "product_id"])
        .select(F.col("key_groups").alias("bad")),
    }
    return _stack([df.select(F.lit(name).alias("check_name"), "bad") for name, df in checks.items()])


def cutoff_split(staged: DataFrame, cutoff) -> DataFrame:
    day = F.col("submission_date")
    return staged.agg(
        count_if(day < F.lit(cutoff)).alias("full_load_rows"),
        count_if(day >= F.lit(cutoff)).alias("incremental_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        F.min(day).alias("earliest"), F.max(day).alias("latest"),
    )


# --- star -----------------------------------------------------------------------------------


def view_totals(star: Star) -> DataFrame:
    """Every full-population view added up, against the fact count."""
    fact_rows = _rows(star.fact)
    sources = [fact_rows.select(F.lit("fact_reviews").alias("source"), F.col("n").alias("reviews"))]
    for name in views.FULL_POPULATION:
        measure = "total_reviews" if name == "vw_kpi_summary" else "review_count"
        total = views.VIEWS[name](star).agg(F.sum(measure).alias("reviews"))
        sources.append(total.select(F.lit(name).alias("source"), "reviews"))
    diff = F.col("reviews") - fact_rows.scalar()
    return _stack(sources).withColumns({
        "diff_from_fact": diff,
        "status": F.when(diff == 0, "OK").otherwise("MISMATCH"),
    })


def views_matching(totals: DataFrame) -> DataFrame:
    """One row: how many views agree with the fact table, of how many."""
    only_views = totals.where(F.col("source") != "fact_reviews")
    return only_views.agg(
        count_if(F.col("status") == "OK").alias("matching"), F.count(F.lit(1)).alias("views"))


def subset_totals(star: Star, primary_category=views.SKINCARE, min_reviews=views.HYPE_MIN_REVIEWS) -> DataFrame:
    """The two views that leave rows out on purpose, beside the fact total."""
    subsets = {
        "vw_rating_by_skin_type": views.rating_by_skin_type(star, primary_category),
        # The ranks do not change the total, so they are left out of this sum.
        "vw_hype_vs_reality": views.product_totals(star).where(F.col("n") >= min_reviews)
        .join(star.product, "product_key").join(star.brand, "brand_key")
        .withColumnRenamed("n", "review_count"),
    }
    return _stack([
        df.agg(F.coalesce(F.sum("review_count"), F.lit(0)).alias("reviews"))
        .select(F.lit(name).alias("view_name"), "reviews")
        for name, df in subsets.items()
    ]).withColumn("fact_total", _rows(star.fact).scalar())


def fact_range(star: Star) -> DataFrame:
    return star.fact.agg(
        F.count(F.lit(1)).alias("fact_rows"), F.max("submission_date").alias("watermark"),
        F.min("submission_date").alias("earliest"),
    )


def orphan_rows(star: Star) -> DataFrame:
    """Fact rows whose key is missing from a dimension: reason, rows.

    Keys are counted first, so each dimension meets one row per key.
    """
    dims = dict(zip(FACT_KEYS, (star.product, star.customer, star.profile, star.date)))
    found = []
    for (key, dim), reason in zip(dims.items(), FACT_DROP_REASONS):
        bad = _unmatched(star.fact, dim, key)
        found.append(bad.select(F.lit(reason).alias("reason"), F.col("bad").alias("rows")))
    return _stack(found)


def orphan_total(star: Star) -> DataFrame:
    """Fact rows with at least one key that does not resolve.

    The unknown keys, usually none, are found among the distinct keys; the facts
    are then only compared with those.
    """
    marked = star.fact.select(*FACT_KEYS)
    for key, dim in zip(FACT_KEYS, (star.product, star.customer, star.profile, star.date)):
        unknown = star.fact.select(key).distinct().join(dim.select(key), key, "left_anti")
        flagged = cut_lineage(unknown.withColumn(f"_bad_{key}", F.lit(True)))
        marked = lookup_join(marked, flagged, [key])
    bad = reduce(lambda a, b: a | b, [F.col(f"_bad_{k}").isNotNull() for k in FACT_KEYS])
    return marked.agg(count_if(bad).alias("orphan_rows"))


def duplicate_keys(star: Star) -> DataFrame:
    """Repeated load keys, as key groups and as surplus rows."""
    return repeated_keys(star.fact, ["source_row_id", "product_id"])


def dimension_counts(star: Star) -> DataFrame:
    return _rows(star.brand).select(
        F.col("n").alias("brands"), _rows(star.product).scalar().alias("products"),
        _rows(star.customer).scalar().alias("customers"),
        _rows(star.profile).scalar().alias("reviewer_profiles"),
        _rows(star.date).scalar().alias("dates"),
    )


def row_accounting(raw, nf, staged, fact) -> DataFrame:
    """Reviews per layer, in the order they pass: place, stage, rows.

    A layer that does not exist (None) is listed without a count.
    """
    stages = {"raw.reviews": raw, "nf.review": nf, "staging.review": staged, "dw.fact_reviews": fact}
    rows = []
    for place, (name, df) in enumerate(stages.items(), start=1):
        if df is None:
            counted = fact.agg(F.lit(None).cast("long").alias("n"))
        else:
            counted = _rows(df)
        rows.append(counted.select(
            F.lit(place).alias("place"), F.lit(name).alias("stage"), F.col("n").alias("rows")))
    return _stack(rows)
