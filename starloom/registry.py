"""Every query by name, over the mapped test tables: (spark, folder) -> DataFrame.

Decimals and dates leave as doubles and ISO texts so that another engine's results
compare value by value. Surrogate numbers are never compared; business keys are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality, upsert
from starloom.operators.dedup import keep_first, mixed_keys, repeated_keys, require_dependency, require_unique
from starloom.operators.keys import number_rows, with_percent_rank, with_rank_fraction
from starloom.plans import (
    clean, dimensions, fact, load, normalize, profiling, reports, validation, views,
)
from starloom.schemas import (
    DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT, FACT_DROP_REASONS, NF_AUTHOR, NF_BRAND, NF_CATEGORY,
    NF_LOOKUPS, NF_PRODUCT, NF_REVIEW, PROFILE_ATTRIBUTES, RAW_PRODUCT, RAW_REVIEW, STAGED_PRODUCT,
    STAGED_REVIEW, STG_FACT_EXTRACT,
)
from starloom.session import cut_lineage, scratch_path
from starloom.sources import csv_files, layers
from starloom.sources import tpch_reviews as mapped
from starloom.streaming import incremental as inc

Query = Callable[[SparkSession, str], DataFrame]

# Parameters the registered queries are run with.
CATEGORIES = ["S1", "S4", "S7"]
BRANDS = ["Brand#3", "Brand#11", "Brand#20"]
SEARCH = "GEAR"
KPI_BASELINE = 50_000
BATCH_ID = "manual__2026-01-01T00:00:00+00:00"
# Members left out of the lookups, so that every drop reason fires.
LARGEST_KNOWN_SIZE = 48
LAST_KNOWN_DAY = date(2001, 6, 30)

_queries: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    out = []
    for c, kind in df.dtypes:
        column = F.col(f"`{c}`")
        if kind.startswith("decimal"):
            column = F.round(column.cast("double"), 6)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("long")
        out.append(column.alias(c))
    return df.select(*out)


def query(name: str):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _plain(build(spark, folder))

        _queries[name] = run
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _on_star(name: str, build, reviewers=False, profiles=False, dates=False) -> None:
    query(name)(lambda s, d: build(mapped.star(s, d, reviewers, profiles, dates)))


# --- views -----------------------------------------------------------------------------------

_on_star("rating_by_brand", views.rating_by_brand)
_on_star("rating_by_category", views.rating_by_category)
_on_star("review_trend_monthly", views.review_trend_monthly, reviewers=True, dates=True)
_on_star("rating_by_price_band", views.rating_by_price_band)
_on_star("rating_by_profile_type",
         lambda s: views.rating_by_skin_type(s, mapped.PRIMARY_CATEGORY), profiles=True)
_on_star("kpi_summary", views.kpi_summary, reviewers=True)
_on_star("hype_vs_reality", lambda s: views.hype_vs_reality(s, mapped.MIN_REVIEWS).drop("product_key"))
_on_star("volume_by_month", views.volume_by_month, reviewers=True, dates=True)
_on_star("rating_by_profile_tone", views.rating_by_skin_tone, profiles=True)
_on_star("rating_by_length", views.rating_by_review_length)
_on_star("rating_by_brand_category", views.rating_by_brand_category)


@query("views_by_name")
def _views_by_name(spark, folder):
    views.register_views(spark, mapped.star(spark, folder, profiles=True, dates=True))
    return spark.sql(
        "select brand_name, review_count, avg_rating from vw_rating_by_brand "
        "where review_count >= :floor", args={"floor": 100})


# --- parameterised reports -------------------------------------------------------------------

_HYPE = {"min_reviews": mapped.MIN_REVIEWS}

_on_star("brand_ranking", lambda s: reports.brand_ranking(s, 100, brands=BRANDS))
_on_star("brand_ranking_scoped", lambda s: reports.brand_ranking(s, 100, CATEGORIES))
_on_star("brand_extremes", lambda s: reports.brand_extremes(s, min_reviews=100), reviewers=True)
_on_star("top_brands", lambda s: reports.top_brands(s, min_reviews=100))
_on_star("bottom_brands", lambda s: reports.top_brands(s, min_reviews=100, best=False))
_on_star("category_ranking", lambda s: reports.category_ranking(s, CATEGORIES))
_on_star("category_totals", reports.category_ranking)
_on_star("price_band_series", reports.price_band_series)
_on_star("band_peaks", reports.band_peaks)
_on_star("hype_top_bottom", lambda s: reports.hype_top_bottom(s, categories=CATEGORIES, **_HYPE))
_on_star("hype_labels", lambda s: reports.hype_labels(s, **_HYPE))
_on_star("product_explorer",
         lambda s: reports.product_explorer(s, CATEGORIES, BRANDS, SEARCH, **_HYPE))
_on_star("profile_ranking",
         lambda s: reports.skin_type_ranking(s, CATEGORIES, mapped.PRIMARY_CATEGORY, 100), profiles=True)
_on_star("tone_totals", reports.skin_tone_totals, profiles=True)
_on_star("length_shares", reports.length_shares)
_on_star("length_contrast", reports.length_contrast)
_on_star("trend_series", reports.trend_series, reviewers=True, dates=True)
_on_star("trend_peaks", reports.trend_peaks, reviewers=True, dates=True)
_on_star("yearly_trend", reports.yearly_trend, reviewers=True, dates=True)
_on_star("latest_months", reports.latest_months, reviewers=True, dates=True)
_on_star("filter_options", reports.category_options)
_on_star("brand_options", lambda s: reports.brand_options(s, CATEGORIES))
_on_star("kpi_with_delta", lambda s: reports.kpi_with_delta(s, KPI_BASELINE), reviewers=True)


# --- validation ------------------------------------------------------------------------------

_on_star("view_totals", validation.view_totals, profiles=True, dates=True)
_on_star("views_matching", lambda s: validation.views_matching(validation.view_totals(s)), profiles=True,
         dates=True)
_on_star("subset_totals",
         lambda s: validation.subset_totals(s, mapped.PRIMARY_CATEGORY, mapped.MIN_REVIEWS), profiles=True)
_on_star("fact_range", validation.fact_range)
_on_star("duplicate_keys", validation.duplicate_keys)
_on_star("dimension_counts", validation.dimension_counts, profiles=True, dates=True)


def _star_with_gaps(spark, folder):
    star = mapped.star(spark, folder, profiles=True, dates=True)
    return star._replace(
        product=star.product.where(F.col("loves_count") < (LARGEST_KNOWN_SIZE + 1) * 1000),
        profile=star.profile.where("skin_type <> 'P' or hair_color <> 'F'"),
        date=star.date.where(F.col("full_date") <= F.lit(LAST_KNOWN_DAY)),
    )


@query("orphans_by_reason")
def _orphans(spark, folder):
    return validation.orphan_rows(_star_with_gaps(spark, folder))


@query("orphan_total")
def _orphan_total(spark, folder):
    return validation.orphan_total(_star_with_gaps(spark, folder))


class _Layers(dict):
    """The reviews and the catalogue at every layer, from their uncleaned text; made when asked for."""

    NAMES = ["raw.product_info", "raw.reviews", "nf.brand", "nf.category", "nf.product", "nf.author",
             *[f"nf.{a}" for a in PROFILE_ATTRIBUTES], "nf.review", "staging.product", "staging.review"]

    def __init__(self, spark, folder):
        super().__init__()
        self.source = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        self[name] = made = self._make(name)
        return made

    def _make(self, name: str) -> DataFrame:
        lookups = PROFILE_ATTRIBUTES if name in ("nf.review", "staging.review") else []
        lookups = {a: self[f"nf.{a}"] for a in lookups}
        match name:
            case "raw.product_info":
                return cut_lineage(clean.type_products(clean.distinct_products(mapped.raw_catalogue(*self.source))))
            case "raw.reviews":
                # The trimmed rows are stored already; their readers type the few columns they need.
                return clean.type_reviews(clean.distinct_reviews(mapped.raw_reviews(*self.source)))
            case "nf.brand":
                return normalize.brands(self["raw.product_info"])
            case "nf.category":
                return number_rows(normalize.categories(self["raw.product_info"]), "category_id")
            case "nf.product":
                return normalize.nf_products(self["raw.product_info"], self["nf.category"])
            case "nf.author":
                return normalize.authors(self["raw.reviews"])
            case "nf.review":
                found = normalize.nf_reviews(self["raw.reviews"], lookups)
                return found.withColumn("review_id", F.col("source_row_id"))
            case "staging.product":
                return normalize.staged_products(self["nf.product"], self["nf.brand"], self["nf.category"])
            case "staging.review":
                return normalize.staged_reviews(self["nf.review"], lookups)
        attribute = name.removeprefix("nf.")
        return number_rows(normalize.attribute_values(self["raw.reviews"], attribute), f"{attribute}_id")


def _layers(spark, folder) -> _Layers:
    return _Layers(spark, folder)


@query("layer_counts")
def _layer_counts(spark, folder):
    at = _layers(spark, folder)
    return validation.layer_counts({name: at[name] for name in at.NAMES}, {"nf.brand": 25})


@query("layer_gaps")
def _layer_gaps(spark, folder):
    """Both entities; some rows are kept from staging on purpose."""
    at = _layers(spark, folder)
    reviews = validation.layer_gaps(
        at["raw.reviews"], at["nf.review"], at["staging.review"].where("source_row_id % 43 <> 0"))
    products = validation.layer_gaps(
        at["raw.product_info"], at["nf.product"], at["staging.product"].where("secondary_category <> 'S3'"))
    return reviews.withColumn("entity", F.lit("review")).unionByName(products.withColumn("entity", F.lit("product")))


@query("row_accounting")
def _row_accounting(spark, folder):
    at = _layers(spark, folder)
    staged = at["staging.review"]
    loaded = staged.where(F.col("submission_date") < F.lit(mapped.CUTOFF))
    return validation.row_accounting(at["raw.reviews"], at["nf.review"], staged, loaded)


@query("integrity_checks")
def _integrity(spark, folder):
    at = _layers(spark, folder)
    # Faults of every kind: members left out, reviews repeated, an attribute blanked.
    known = at["nf.product"].where(F.col("loves_count") < (LARGEST_KNOWN_SIZE + 1) * 1000)
    review = at["nf.review"].unionByName(at["nf.review"].where("source_row_id % 41 = 0"))
    staged = at["staging.review"].withColumn("skin_tone", F.when(F.col("source_row_id") % 37 != 0, F.col("skin_tone")))
    return validation.integrity_checks(
        review, known, at["nf.author"].where("cast(author_id as long) % 7 <> 0"),
        at["nf.brand"].where("brand_id <> 25"), at["nf.category"].where("secondary_category <> 'S3'"), staged)


@query("cutoff_split")
def _cutoff(spark, folder):
    return validation.cutoff_split(mapped.reviews(spark, folder), mapped.CUTOFF)


@query("backlog_status")
def _backlog(spark, folder):
    """The same staged reviews against a complete, a held-back and a short fact table."""
    staged = mapped.reviews(spark, folder)
    facts = {
        "full": staged,
        "historical": staged.where(F.col("submission_date") < F.lit(mapped.CUTOFF)),
        "short": staged.where("rating < 5"),
    }
    found = None
    for name, rows in facts.items():
        one = inc.backlog(staged, rows).withColumn("loaded", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


# --- cleaning --------------------------------------------------------------------------------


@query("cleaned_reviews")
def _cleaned_reviews(spark, folder):
    return clean.clean_reviews(mapped.raw_reviews(spark, folder))


@query("cleaned_catalogue")
def _cleaned_catalogue(spark, folder):
    return clean.clean_products(mapped.raw_catalogue(spark, folder))


@query("review_cleaning_steps")
def _review_steps(spark, folder):
    return clean.review_steps(mapped.raw_reviews(spark, folder))


@query("catalogue_cleaning_steps")
def _product_steps(spark, folder):
    return clean.product_steps(mapped.raw_catalogue(spark, folder))


@query("dedup_first")
def _dedup(spark, folder):
    lines = mapped.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    kept = keep_first(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return kept.withColumn("l_shipdate", F.to_date("l_shipdate"))


@query("csv_reviews")
def _csv_reviews(spark, folder):
    """Review text written as CSV files and read back, quotes and line breaks included."""
    files = scratch_path(spark, "csv-reviews")
    raw = mapped.raw_reviews(spark, folder)
    columns = [c for c in raw.columns if c not in ("source_row_id", "source_file")]
    # One folder per source file; the file names Spark gives are replaced by the folder's.
    csv_files.write_csv(raw.select(F.col("source_row_id").alias(""), *columns, "source_file"), files, "source_file")
    read = csv_files.read_reviews(spark, f"{files}/*/*.csv", with_path=True)
    named = F.regexp_extract("source_path", r"source_file=([^/]*)/", 1)
    return clean.type_reviews(clean.trim_all(read.withColumn("source_file", named).drop("source_path")))


@query("csv_catalogue")
def _csv_catalogue(spark, folder):
    """Catalogue text written as CSV and read back with only the price columns."""
    files = scratch_path(spark, "csv-catalogue")
    csv_files.write_csv(mapped.raw_catalogue(spark, folder), files)
    return csv_files.read_catalogue(spark, f"{files}/*.csv", ["product_id", "price_usd", "sale_price_usd"])


# --- normalisation and dimensions ------------------------------------------------------------


@query("category_nullsafe")
def _category(spark, folder):
    at = _layers(spark, folder)
    keyed = at["nf.product"].select("product_id", "category_id")
    return keyed.join(at["nf.category"], "category_id").drop("category_id")


@query("unknown_defaults")
def _unknown(spark, folder):
    staged = _layers(spark, folder)["staging.review"]
    return staged.select("source_row_id", "product_id", *PROFILE_ATTRIBUTES)


@query("staged_catalogue")
def _staged_catalogue(spark, folder):
    return _layers(spark, folder)["staging.product"]


@query("brand_dimension")
def _brand_dimension(spark, folder):
    return dimensions.brand_rows(mapped.catalogue(spark, folder))


@query("customer_dimension")
def _customer_dimension(spark, folder):
    return dimensions.customer_rows(mapped.reviews(spark, folder))


@query("junk_dimension")
def _junk_dimension(spark, folder):
    return dimensions.profile_rows(mapped.reviews(spark, folder))


@query("product_dimension")
def _product_dimension(spark, folder):
    """Product members whose brand is known; one brand is missing on purpose."""
    products = mapped.catalogue(spark, folder)
    known = dimensions.brand_rows(products).where("brand_id <> 25")
    brand = number_rows(known, "brand_key")
    rows = dimensions.product_rows(dimensions.resolve_products(products, brand))
    return rows.join(brand.select("brand_key", "brand_id"), "brand_key").drop("brand_key")


@query("calendar")
def _calendar(spark, folder):
    return dimensions.calendar(dimensions.date_bounds(mapped.reviews(spark, folder)))


@query("surrogate_keys")
def _surrogate_keys(spark, folder):
    """Numbers given to all customers after 1,000 used ones: dense and without repeats."""
    rows = mapped.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("customer_id"))
    numbered = number_rows(rows, "customer_key", start=1000)
    return numbered.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_key").alias("numbers"),
        F.min("customer_key").alias("first"), F.max("customer_key").alias("last"),
    )


@query("percent_rank")
def _percent_rank(spark, folder):
    rows = cut_lineage(mapped.catalogue(spark, folder).select("product_id", "loves_count"))
    ranked = with_percent_rank(rows, "loves_count", "loves_percentile")
    return ranked.withColumn("loves_percentile", F.round("loves_percentile", 6))


# --- fact load -------------------------------------------------------------------------------


def _lookups_with_gaps(spark, folder) -> dict[str, DataFrame]:
    products = mapped.catalogue(spark, folder)
    known = products.where(F.col("loves_count") < (LARGEST_KNOWN_SIZE + 1) * 1000)
    customers = mapped.table(spark, folder, "customer").where("c_acctbal >= 0")
    profiles = dimensions.profile_rows(mapped.reviews(spark, folder))
    days = dimensions.calendar(dimensions.date_bounds(mapped.star(spark, folder).fact))
    lookups = {
        "product": number_rows(known.select("product_id"), "product_key"),
        "customer": number_rows(
            customers.select(F.col("c_custkey").cast("string").alias("customer_id")), "customer_key"),
        "reviewer_profile": number_rows(
            profiles.where("skin_type <> 'P' or hair_color <> 'F'"), "reviewer_profile_key"),
        "date": days.where(F.col("full_date") <= F.lit(LAST_KNOWN_DAY)).select("full_date", "date_key"),
    }
    return {name: cut_lineage(df) for name, df in lookups.items()}


def _resolved(spark, folder):
    lookups = _lookups_with_gaps(spark, folder)
    return fact.resolve_facts(mapped.reviews(spark, folder), lookups), lookups


@query("fact_resolved")
def _fact_resolved(spark, folder):
    """Fact rows with their keys translated back to business keys."""
    resolved, lookups = _resolved(spark, folder)
    rows = fact.fact_rows(resolved).drop("product_id", "submission_date")
    for name, key in (("product", "product_key"), ("customer", "customer_key"),
                      ("reviewer_profile", "reviewer_profile_key"), ("date", "date_key")):
        rows = rows.join(lookups[name], key)
    return rows.drop("product_key", "customer_key", "reviewer_profile_key")


@query("drops_by_reason")
def _drops(spark, folder):
    return fact.drops_by_reason(_resolved(spark, folder)[0])


@query("load_modes")
def _load_modes(spark, folder):
    """Rows and date range each mode selects, with the historical cutoff of the test data."""
    reviews = mapped.reviews(spark, folder)
    historical = inc.select_batch(reviews, inc.HISTORICAL, cutoff=mapped.CUTOFF)
    after = inc.watermark(historical)
    found = None
    for mode in inc.LOAD_MODES:
        one = inc.select_batch(reviews, mode, after, mapped.CUTOFF).agg(
            F.count(F.lit(1)).alias("rows"), F.min("submission_date").alias("earliest"),
            F.max("submission_date").alias("latest"),
        ).withColumn("mode", F.lit(mode))
        found = one if found is None else found.unionByName(one)
    return found


@query("incremental_batch")
def _incremental(spark, folder):
    reviews = mapped.reviews(spark, folder)
    loaded = reviews.where(F.col("submission_date") < F.lit(mapped.CUTOFF))
    return inc.select_batch(reviews, inc.INCREMENTAL, inc.watermark(loaded))


@query("watermark")
def _watermark(spark, folder):
    """Watermark of a loaded and of an empty fact table."""
    reviews = mapped.reviews(spark, folder)
    found = {"loaded": inc.watermark(reviews), "empty": inc.watermark(reviews.where("rating > 5"))}
    return mapped.table(spark, folder, "lineitem").agg(
        F.max(F.to_date("l_shipdate")).alias("latest"),
        *[F.max(F.lit(day)).alias(name) for name, day in found.items()])


@query("insert_absent")
def _insert_absent(spark, folder):
    """All customers offered to a table that holds the ones with a negative balance."""
    root = scratch_path(spark, "insert-absent")
    customers = mapped.table(spark, folder, "customer")
    ids = F.col("c_custkey").cast("string").alias("customer_id")
    offers = {"first": customers.where("c_acctbal < 0"), "second": customers, "third": customers}
    done = {
        step: upsert.insert_absent(rows.select(ids), root, DIM_CUSTOMER) for step, rows in offers.items()
    }
    stored = layers.read_table(spark, root, DIM_CUSTOMER)
    counts = [
        F.lit(getattr(result, measure)).cast("long").alias(f"{step}_{measure}")
        for step, result in done.items() for measure in ("offered", "inserted", "already_present")
    ]
    return stored.agg(
        F.count(F.lit(1)).alias("stored"), F.countDistinct("customer_key").alias("numbers"),
        F.max("customer_key").alias("last_number"),
    ).select("*", *counts)


@query("absent_rows")
def _absent_rows(spark, folder):
    """Reviews not yet in a fact table that stops at the cutoff."""
    reviews = cut_lineage(mapped.reviews(spark, folder))
    loaded = reviews.where(F.col("submission_date") < F.lit(mapped.CUTOFF))
    return upsert.absent_rows(reviews, loaded, FACT).select("source_row_id", "product_id", "submission_date")


@query("batch_hand_over")
def _batch_hand_over(spark, folder):
    """A batch staged twice, read back, and removed: rows at every step."""
    root = scratch_path(spark, "hand-over")
    rows = inc.select_batch(mapped.reviews(spark, folder), inc.FULL)
    first = layers.stage_batch(rows, root, STG_FACT_EXTRACT, BATCH_ID)
    again = layers.stage_batch(rows, root, STG_FACT_EXTRACT, BATCH_ID)
    other = layers.stage_batch(rows.where("rating = 5"), root, STG_FACT_EXTRACT, "other")
    held = layers.read_batch(spark, root, STG_FACT_EXTRACT, BATCH_ID).count()
    removed = load.clean_up_batch(spark, root, BATCH_ID)
    left = layers.read_batch(spark, root, STG_FACT_EXTRACT, BATCH_ID).count()
    return layers.read_batch(spark, root, STG_FACT_EXTRACT, "other").agg(
        F.count(F.lit(1)).alias("other_read"),
        *[F.max(F.lit(n).cast("long")).alias(c) for c, n in (
            ("first", first), ("again", again), ("other_staged", other), ("held", held),
            ("removed", removed), ("left", left))],
    )


_RUN_COLUMNS = ["mode", "watermark", "watermark_after", "rows_extracted", "rows_transformed", "rows_dropped",
                *[f"dropped_{r}" for r in FACT_DROP_REASONS], "rows_late", "rows_late_unusable",
                "rows_inserted", "rows_already_present", "brand_inserted",
                "product_inserted", "customer_inserted", "profile_inserted", "date_inserted"]


@query("load_runs")
def _load_runs(spark, folder):
    """A warehouse loaded historical, incremental, incremental, full and staged: a row per run.

    Large products are unknown, so their reviews drop. Every ninth review arrives after the
    second run: the ones before the watermark are late until the full run. Reviews of the last
    days arrive for the staged run.
    """
    root = scratch_path(spark, "warehouse")
    reviews = cut_lineage(mapped.reviews(spark, folder))
    on_time = (F.col("source_row_id") % 9 != 0) & (F.col("submission_date") <= F.lit(LAST_KNOWN_DAY))
    layers.overwrite(mapped.catalogue(spark, folder).where(
        F.col("loves_count") < (LARGEST_KNOWN_SIZE + 1) * 1000), root, STAGED_PRODUCT)
    layers.overwrite(reviews.where(on_time), root, STAGED_REVIEW)
    runs = [load.run_load(spark, root, mode, mapped.CUTOFF) for mode in (inc.HISTORICAL, inc.INCREMENTAL)]
    layers.overwrite(reviews.where(F.col("submission_date") <= F.lit(LAST_KNOWN_DAY)), root, STAGED_REVIEW)
    runs += [load.run_load(spark, root, mode, mapped.CUTOFF) for mode in (inc.INCREMENTAL, inc.FULL)]
    layers.overwrite(reviews, root, STAGED_REVIEW)
    runs.append(load.run_staged_load(spark, root, BATCH_ID, inc.INCREMENTAL))
    found = None
    for place, run in enumerate(runs, start=1):
        # The texts of a run without a watermark stay null.
        one = load.report_row(spark, {c: run[c] for c in _RUN_COLUMNS}).withColumn("run", F.lit(place))
        found = one if found is None else found.unionByName(one)
    return found


@query("views_after_load")
def _views_after_load(spark, folder):
    """All eleven views, registered after a historical load and read after a full one."""
    root = scratch_path(spark, "live-views")
    layers.overwrite(mapped.catalogue(spark, folder), root, STAGED_PRODUCT)
    layers.overwrite(mapped.reviews(spark, folder), root, STAGED_REVIEW)
    load.run_load(spark, root, inc.HISTORICAL, mapped.CUTOFF)
    views.register_views(spark, root, primary_category=mapped.PRIMARY_CATEGORY, min_reviews=mapped.MIN_REVIEWS)
    load.run_load(spark, root, inc.FULL)
    found = None
    for name in views.VIEWS:
        measure = "total_reviews" if name == "vw_kpi_summary" else "review_count"
        one = spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum(measure).alias("reviews")) \
            .withColumn("view_name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


@query("ingest_counts")
def _ingest_counts(spark, folder):
    """Rows of the raw tables after a good, a refused, a repeated and an appending ingest."""
    root = scratch_path(spark, "ingest")
    products = cut_lineage(clean.type_products(clean.distinct_products(mapped.raw_catalogue(spark, folder))))
    reviews = cut_lineage(clean.type_reviews(clean.distinct_reviews(mapped.raw_reviews(spark, folder))))
    n_products, n_reviews = products.count(), reviews.count()
    few = products.where("child_count = 1")

    def stored(step):
        found = {n: layers.read_table(spark, root, t) for n, t in (("products", RAW_PRODUCT), ("reviews", RAW_REVIEW))}
        return found["products"].agg(F.count(F.lit(1)).alias("products")).select(
            F.lit(step).alias("step"), "products",
            found["reviews"].agg(F.count(F.lit(1))).scalar().alias("reviews"))

    def kept(df):
        return cut_lineage(df)

    load.ingest(root, products, reviews, {"products": n_products, "reviews": n_reviews})
    steps = [kept(stored("good"))]
    try:
        # The products would match; the reviews do not, so neither table changes.
        load.ingest(root, few, reviews, {"products": few.count(), "reviews": n_reviews + 1})
    except layers.RowCountError:
        steps.append(kept(stored("refused")))
    load.ingest(root, products, reviews, {"products": n_products, "reviews": n_reviews})
    steps.append(kept(stored("repeated")))
    load.ingest(root, few, reviews.where("rating = 5"), append=True)
    steps.append(kept(stored("appended")))
    found = steps[0]
    for one in steps[1:]:
        found = found.unionByName(one)
    return found


@query("rank_fractions")
def _rank_fractions(spark, folder):
    """Orders ranked by price, by day and by priority; that of open orders is unknown."""
    orders = cut_lineage(mapped.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("priority")))
    for value in ("price", "day", "priority"):
        orders = with_rank_fraction(orders, value, f"{value}_rank")
    return orders.select("o_orderkey", "price_rank", "day_rank", "priority_rank")


@query("layer_presence")
def _layer_presence(spark, folder):
    """What a reader finds of a warehouse that holds its catalogue and nothing else yet."""
    root = scratch_path(spark, "presence")
    layers.overwrite(mapped.catalogue(spark, folder), root, STAGED_PRODUCT)
    found = None
    for table in (STAGED_PRODUCT, STAGED_REVIEW, RAW_REVIEW, DIM_CUSTOMER):
        held = layers.read_if_present(spark, root, table)
        one = spark.range(1).select(F.lit(None).cast("long").alias("rows")) if held is None else held.agg(
            F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(f"{table.layer}.{table.name}").alias("table_name"),
                         F.lit(held is not None).alias("present"), "rows")
        found = one if found is None else found.unionByName(one)
    return found


@query("preconditions")
def _preconditions(spark, folder):
    """Uniqueness and dependency asked of keys that keep them and of keys that do not."""
    def refused(check, *given) -> bool:
        try:
            check(*given)
        except ValueError:
            return True
        return False

    rows = {n: mapped.table(spark, folder, n) for n in ("customer", "lineitem", "part", "orders")}
    asked = [("customer", ["c_custkey"], None), ("lineitem", ["l_orderkey"], None),
             ("part", ["p_partkey"], "p_brand"), ("orders", ["o_custkey"], "o_orderstatus")]
    found = []
    for name, key, value in asked:
        if value is None:
            found.append((f"unique {name}", repeated_keys(rows[name], key).first().surplus_rows,
                          refused(require_unique, rows[name], key, name)))
        else:
            found.append((f"dependency {name}", mixed_keys(rows[name], key[0], value),
                          refused(require_dependency, rows[name], key[0], value, name)))
    return spark.createDataFrame(found, "precondition string, broken long, refused boolean")


@query("stored_layer_counts")
def _stored_layers(spark, folder):
    """Files to raw, nf and staging on disk, twice: rows of every stored table after each landing."""
    root, files = scratch_path(spark, "stored-layers"), scratch_path(spark, "landing")
    raw = mapped.raw_reviews(spark, folder)
    columns = [c for c in raw.columns if c not in ("source_row_id", "source_file")]
    csv_files.write_csv(raw.select(F.col("source_row_id").alias(""), *columns), f"{files}/reviews")
    csv_files.write_csv(mapped.raw_catalogue(spark, folder), f"{files}/catalogue")
    found = None
    for landing in (1, 2):
        load.land_files(spark, root, f"{files}/catalogue/*.csv", f"{files}/reviews/*.csv")
        for table in (RAW_PRODUCT, RAW_REVIEW, NF_BRAND, NF_CATEGORY, NF_PRODUCT, NF_AUTHOR, *NF_LOOKUPS.values(),
                      NF_REVIEW, STAGED_PRODUCT, STAGED_REVIEW):
            one = layers.read_table(spark, root, table).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(landing).alias("landing"), F.lit(f"{table.layer}.{table.name}").alias("table_name"), "rows")
            found = one if found is None else found.unionByName(one)
        found = cut_lineage(found)
    return found


# --- quality ---------------------------------------------------------------------------------


def _with_faults(df: DataFrame, table, number) -> DataFrame:
    """Every 29th row lacks a required value, every 31st has a bad one, by a row's number."""
    kinds = {f.name: f.dataType for f in table.schema}
    rows = df.withColumn("_number", number)
    changed = {}
    bad = mapped.BAD_VALUES[f"{table.layer}.{table.name}"]
    for i, (c, value) in enumerate(bad.items()):
        changed[c] = F.when((F.col("_number") + i) % 31 == 0, F.lit(value).cast(kinds[c])).otherwise(F.col(c))
    for i, c in enumerate(table.required):
        changed[c] = F.when((F.col("_number") + i) % 29 != 0, changed.get(c, F.col(c)))
    return rows.withColumns(changed).drop("_number")


def _gate_rows(spark, folder):
    """Resolved reviews with faults: unknown keys stay null, counts and ratings are off, rows repeat."""
    resolved, _ = _resolved(spark, folder)
    row = F.col("source_row_id")
    faults = {"rating": (11, 9), "total_feedback_count": (13, -1), "total_pos_feedback_count": (17, -1),
              "total_neg_feedback_count": (19, -1)}
    broken = resolved.withColumns({
        c: F.when(row % n == 0, value).otherwise(F.col(c)).cast(resolved.schema[c].dataType)
        for c, (n, value) in faults.items()})
    return broken.unionByName(broken.where(row % 23 == 0))


@query("quality_report")
def _quality(spark, folder):
    return quality.quality_report(_gate_rows(spark, folder), quality.FACT_CHECKS).drop("n")


@query("product_quality_report")
def _product_quality(spark, folder):
    """Products with an unknown brand, negative prices and counts, and repeated rows."""
    products = mapped.catalogue(spark, folder)
    number = F.col("product_id").cast("long")
    brand = number_rows(dimensions.brand_rows(products).where("brand_id <> 25"), "brand_key")
    resolved = dimensions.resolve_products(products, brand).withColumns({
        "price_usd": F.when(number % 10 == 0, -F.col("price_usd")).otherwise(F.col("price_usd")),
        "loves_count": F.when(number % 12 == 0, -F.col("loves_count")).otherwise(F.col("loves_count"))})
    resolved = resolved.unionByName(resolved.where(number % 14 == 0))
    return quality.quality_report(resolved, quality.PRODUCT_CHECKS).drop("n")


@query("constraint_report")
def _constraints(spark, folder):
    """NOT NULL and CHECK of reviews, products and the calendar; every rule is broken somewhere."""
    at = _layers(spark, folder)
    days = dimensions.calendar(dimensions.date_bounds(at["staging.review"]))
    found = None
    for name, df, table, number in (
            ("nf.review", at["nf.review"], NF_REVIEW, F.col("source_row_id")),
            ("nf.product", at["nf.product"], NF_PRODUCT, F.col("product_id").cast("long")),
            ("dw.dim_date", days, DIM_DATE, F.col("date_key").cast("long"))):
        one = quality.constraint_report(_with_faults(df, table, number), table).withColumn("table_name", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


@query("unique_report")
def _unique(spark, folder):
    """Surplus rows per unique key: uncleaned catalogue text, and line numbers within orders."""
    raw = quality.unique_report(mapped.raw_catalogue(spark, folder), RAW_PRODUCT)
    lines = repeated_keys(mapped.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return raw.unionByName(
        lines.select(F.lit("unique_order_line").alias("constraint"), F.col("surplus_rows").alias("bad_rows")))


@query("reference_report")
def _references(spark, folder):
    star = _star_with_gaps(spark, folder)
    known = mapped.table(spark, folder, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_key"))
    star = star._replace(customer=known, brand=star.brand.where("brand_id <> 25"))
    targets = {"dim_product": star.product, "dim_customer": star.customer,
               "dim_reviewer_profile": star.profile, "dim_date": star.date, "dim_brand": star.brand}
    facts = quality.reference_report(star.fact, FACT, targets)
    return facts.unionByName(quality.reference_report(star.product, DIM_PRODUCT, targets))


@query("referential_check")
def _referential(spark, folder):
    star = _star_with_gaps(spark, folder)
    return quality.missing_references(
        star.fact, "product_key", star.product.select("product_key"), "dim_product")


# --- profiling -------------------------------------------------------------------------------


def _profile(name: str, build, catalogue: bool = False, reviews: bool = True) -> None:
    def run(spark, folder):
        inputs = [mapped.raw_catalogue(spark, folder)] if catalogue else []
        inputs += [mapped.raw_reviews(spark, folder)] if reviews else []
        return build(*inputs)

    query(name)(run)


_profile("profile_row_counts", profiling.row_counts, catalogue=True)
_profile("profile_nulls", profiling.null_counts)
_profile("profile_catalogue_nulls", profiling.null_counts, catalogue=True, reviews=False)
_profile("profile_catalogue", profiling.catalogue_summary, catalogue=True, reviews=False)
_profile("profile_categories", lambda p: profiling.value_counts(p, "primary_category"),
         catalogue=True, reviews=False)
_profile("profile_reviews", profiling.review_summary)
_profile("profile_years", profiling.reviews_per_year)
_profile("profile_ratings", lambda r: profiling.value_counts(
    r.withColumn("rating", F.col("rating").try_cast("double")), "rating"))
_profile("profile_duplicates", profiling.duplicate_reviews)
_profile("profile_orphans", lambda p, r: profiling.orphan_reviews(
    p.where(F.col("loves_count").cast("int") < (LARGEST_KNOWN_SIZE + 1) * 1000), r), catalogue=True)
_profile("profile_load_keys", profiling.load_key_ranges)
_profile("profile_attr_consistency", profiling.attribute_consistency)
_profile("profile_attr_combinations", profiling.attribute_combinations)
_profile("profile_attr_values", profiling.attribute_values)
_profile("profile_hierarchy", profiling.category_levels, catalogue=True, reviews=False)
_profile("profile_shared_secondaries", profiling.shared_secondaries, catalogue=True, reviews=False)
_profile("profile_helpfulness", profiling.helpfulness_rules)
_profile("profile_repeated_columns", lambda p, r: profiling.repeated_columns(
    clean.distinct_products(p), r), catalogue=True)
_profile("profile_tags", profiling.tag_summary, catalogue=True, reviews=False)
_profile("profile_top_tags", profiling.top_tags, catalogue=True, reviews=False)
_profile("profile_cutoff", lambda r: profiling.cutoff_summary(r, mapped.CUTOFF))
_profile("profile_cutoff_months", lambda r: profiling.months_from(r, mapped.CUTOFF))


@query("profile_text")
def _profile_text(spark, folder):
    return profiling.text_lengths(mapped.table(spark, folder, "documents"), "text")
