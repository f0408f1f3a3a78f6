"""Table definitions: columns, keys and constraints of every stored layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PRICE_BANDS = (
    ("Under $15", 0, 15),
    ("$15-30", 15, 30),
    ("$30-50", 30, 50),
    ("$50-100", 50, 100),
    ("$100+", 100, None),
)

LENGTH_BUCKETS = (
    ("Very short (<100)", 100),
    ("Short (100-249)", 250),
    ("Medium (250-499)", 500),
    ("Long (500-999)", 1000),
    ("Very long (1000+)", None),
)

UNKNOWN = "Unknown"

PROFILE_ATTRIBUTES = ["skin_tone", "skin_type", "eye_color", "hair_color"]
PRODUCT_FLAGS = ["limited_edition", "new", "online_only", "out_of_stock", "retailer_exclusive"]
FEEDBACK_COUNTS = ["total_feedback_count", "total_pos_feedback_count", "total_neg_feedback_count"]

PRODUCT_DROP_REASONS = ["unresolved_brand"]
FACT_DROP_REASONS = [
    "unresolved_product",
    "unresolved_customer",
    "unresolved_reviewer_profile",
    "out_of_range_date",
]
# -----------------------------------------------------------------------------

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "price": T.DecimalType(10, 2),
    "score": T.DecimalType(6, 4),
    "share": T.DecimalType(18, 16),
    "sum": T.DecimalType(38, 0),
}


@dataclass(frozen=True)
class Table:
    """One stored table. A column written ``name type!`` must not be null.

    A ``keyed`` table can grow large and is asked for its business keys at every insert; its
    key columns must not be null.
    """

    layer: str
    name: str
    columns: str
    key: tuple[str, ...] = ()
    surrogate: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()
    checks: dict[str, str] = field(default_factory=dict, hash=False)
    month_of: str | None = None
    keyed: bool = False

    @staticmethod
    def by_name(layer: str, name: str) -> Table:
        """A declared table of a layer."""
        return next(t for t in globals().values() if isinstance(t, Table) and (t.layer, t.name) == (layer, name))

    def _parsed(self):
        for item in self.columns.split(","):
            name, kind = item.split()
            yield name, _TYPES[kind.rstrip("!")], kind.endswith("!")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t, _ in self._parsed()])

    @property
    def names(self) -> list[str]:
        return [n for n, _, _ in self._parsed()]

    @property
    def required(self) -> list[str]:
        return [n for n, _, needed in self._parsed() if needed]


_FLAGS = ", ".join(f"{f} bool!" for f in PRODUCT_FLAGS)
_ATTRIBUTES = ", ".join(f"{a} string!" for a in PROFILE_ATTRIBUTES)
_COUNTS = ", ".join(f"{c} int!" for c in FEEDBACK_COUNTS)

_MEASURES = f"rating short!, is_recommended bool, helpfulness share, {_COUNTS}, review_length int"

_COUNT_CHECKS = {
    "rating_1_to_5": "rating between 1 and 5",
    "feedback_total_not_negative": "total_feedback_count >= 0",
    "feedback_pos_not_negative": "total_pos_feedback_count >= 0",
    "feedback_neg_not_negative": "total_neg_feedback_count >= 0",
    "length_not_negative": "review_length >= 0",
    "feedback_split": "total_pos_feedback_count + total_neg_feedback_count = total_feedback_count",
}

# --- raw: the cleaned files, nothing projected away --------------------------
RAW_PRODUCT = Table(
    "raw", "product_info",
    "product_id string!, product_name string, brand_id int, brand_name string, loves_count int, "
    "rating score, reviews int, size string, variation_type string, variation_value string, "
    "variation_desc string, ingredients string, price_usd price, value_price_usd price, "
    "sale_price_usd price, limited_edition bool, new bool, online_only bool, out_of_stock bool, "
    "retailer_exclusive bool, highlights string, primary_category string, "
    "secondary_category string, tertiary_category string, child_count int, "
    "child_max_price price, child_min_price price",
    key=("product_id",),
)

RAW_REVIEW = Table(
    "raw", "reviews",
    "source_row_id long!, author_id string!, rating short, is_recommended bool, helpfulness share, "
    "total_feedback_count int, total_neg_feedback_count int, total_pos_feedback_count int, "
    "submission_time date, review_text string, review_title string, skin_tone string, "
    "eye_color string, skin_type string, hair_color string, product_id string!, "
    "product_name string, brand_name string, price_usd price, source_file string!, "
    "review_length int",
    key=("source_row_id", "product_id"),
)

# --- nf: third normal form ------------------------------------------------------
NF_BRAND = Table("nf", "brand", "brand_id int!, brand_name string!", key=("brand_id",),
                 unique=(("brand_name",),))
NF_CATEGORY = Table(
    "nf", "category",
    "category_id long!, primary_category string!, secondary_category string, tertiary_category string",
    key=("primary_category", "secondary_category", "tertiary_category"), surrogate="category_id",
)
NF_PRODUCT = Table(
    "nf", "product",
    "product_id string!, product_name string!, brand_id int!, category_id long!, price_usd price!, "
    "size string, variation_type string, variation_value string, loves_count int!, rating score, "
    f"reviews int, child_count int!, {_FLAGS}",
    key=("product_id",),
    references=(("brand_id", "brand", "brand_id"), ("category_id", "category", "category_id")),
    checks={
        "price_positive": "price_usd > 0",
        "loves_not_negative": "loves_count >= 0",
        "catalogue_rating_1_to_5": "rating between 1 and 5",
        "reviews_not_negative": "reviews >= 0",
        "children_not_negative": "child_count >= 0",
    },
)
NF_AUTHOR = Table("nf", "author", "author_id string!", key=("author_id",))
NF_LOOKUPS = {
    a: Table("nf", a, f"{a}_id long!, {a} string!", key=(a,), surrogate=f"{a}_id")
    for a in PROFILE_ATTRIBUTES
}
NF_REVIEW = Table(
    "nf", "review",
    "review_id long!, source_row_id long!, source_file string!, author_id string!, "
    f"product_id string!, submission_date date!, {_MEASURES}, review_text string, "
    "review_title string, skin_tone_id long, skin_type_id long, eye_color_id long, hair_color_id long",
    key=("source_row_id", "product_id"), surrogate="review_id",
    references=(("author_id", "author", "author_id"), ("product_id", "product", "product_id")),
    checks={
        **_COUNT_CHECKS,
        "helpfulness_0_to_1": "helpfulness between 0 and 1",
        "helpfulness_only_with_votes": "(helpfulness is null) = (total_feedback_count = 0)",
    },
)

# --- staging: flattened, text left behind --------------------------------------
STAGED_PRODUCT = Table(
    "staging", "product",
    "product_id string!, product_name string!, brand_id int!, brand_name string!, "
    "primary_category string!, secondary_category string, tertiary_category string, "
    f"price_usd price!, size string, loves_count int!, {_FLAGS}",
    key=("product_id",),
)
STAGED_REVIEW = Table(
    "staging", "review",
    "review_id long!, source_row_id long!, author_id string!, product_id string!, "
    f"submission_date date!, {_MEASURES}, {_ATTRIBUTES}",
    key=("source_row_id", "product_id"), month_of="submission_date",
)

# --- dw: the star -------------------------------------------------------------------
DIM_DATE = Table(
    "dw", "dim_date",
    "date_key int!, full_date date!, year int!, quarter int!, month int!, month_name string!, "
    "week int!, day int!, day_of_week int!, day_name string!, is_weekend bool!",
    key=("date_key",), unique=(("full_date",),),
    checks={
        "quarter_1_to_4": "quarter between 1 and 4",
        "month_1_to_12": "month between 1 and 12",
        "day_1_to_31": "day between 1 and 31",
        "day_of_week_1_to_7": "day_of_week between 1 and 7",
    },
)
DIM_BRAND = Table("dw", "dim_brand", "brand_key long!, brand_id int!, brand_name string!",
                  key=("brand_id",), surrogate="brand_key")
DIM_PRODUCT = Table(
    "dw", "dim_product",
    "product_key long!, product_id string!, product_name string!, brand_key long!, "
    "primary_category string!, secondary_category string, tertiary_category string, "
    f"price_usd price!, price_band string!, size string, loves_count int!, {_FLAGS}",
    key=("product_id",), surrogate="product_key",
    references=(("brand_key", "dim_brand", "brand_key"),),
)
DIM_CUSTOMER = Table("dw", "dim_customer", "customer_key long!, customer_id string!",
                     key=("customer_id",), surrogate="customer_key", keyed=True)
DIM_PROFILE = Table("dw", "dim_reviewer_profile", f"reviewer_profile_key long!, {_ATTRIBUTES}",
                    key=tuple(PROFILE_ATTRIBUTES), surrogate="reviewer_profile_key")
FACT = Table(
    "dw", "fact_reviews",
    "review_key long!, source_row_id long!, product_id string!, product_key long!, "
    f"customer_key long!, reviewer_profile_key long!, date_key int!, {_MEASURES}, "
    "submission_date date!",
    key=("source_row_id", "product_id"), surrogate="review_key", month_of="submission_date", keyed=True,
    references=(
        ("product_key", "dim_product", "product_key"),
        ("customer_key", "dim_customer", "customer_key"),
        ("reviewer_profile_key", "dim_reviewer_profile", "reviewer_profile_key"),
        ("date_key", "dim_date", "date_key"),
    ),
    checks=_COUNT_CHECKS,
)

FACT_KEYS = ["product_key", "customer_key", "reviewer_profile_key", "date_key"]
FACT_COLUMNS = [c for c in FACT.names if c != "review_key"]
EXTRACT_COLUMNS = [c for c in STAGED_REVIEW.names if c != "review_id"]

# --- batch-scoped hand-over tables ------------------------------------------------


def _batch_table(name: str, source: Table, without: tuple[str, ...] = ()) -> Table:
    kept = [c.strip().rstrip("!") for c in source.columns.split(",")]
    kept = [c for c in kept if c.split()[0] not in without]
    return Table("batch", name, ", ".join(kept))


STG_BRAND = _batch_table("stg_dim_brand", DIM_BRAND, ("brand_key",))
STG_PRODUCT = _batch_table("stg_dim_product", DIM_PRODUCT, ("product_key",))
STG_CUSTOMER = _batch_table("stg_dim_customer", DIM_CUSTOMER, ("customer_key",))
STG_PROFILE = _batch_table("stg_dim_reviewer_profile", DIM_PROFILE, ("reviewer_profile_key",))
STG_FACT_EXTRACT = _batch_table("stg_fact_extract", STAGED_REVIEW, ("review_id",))
STG_FACT_TRANSFORMED = _batch_table("stg_fact_transformed", FACT, ("review_key",))

# What a step of a staged load has reported, as JSON: a restarted load goes on behind it.
STG_STEPS = Table("batch", "stg_steps", "place int!, step string!, report string!")

BATCH_TABLES = [STG_BRAND, STG_PRODUCT, STG_CUSTOMER, STG_PROFILE, STG_FACT_EXTRACT,
                STG_FACT_TRANSFORMED, STG_STEPS]
RAW_PRODUCT_COLUMNS = RAW_PRODUCT.names
RAW_REVIEW_COLUMNS = [c for c in RAW_REVIEW.names if c not in ("source_file", "review_length")]
