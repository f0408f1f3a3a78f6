"""The order tables read as reviews: a line item is a review of a part by a customer.

This is how the analytic queries are exercised on the given test tables. Natural
keys that are already numbers serve as surrogate keys, as a loaded star would
hold them. Line items keep their grain: orders and customers join from the left.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import date_key, price_band
from starloom.plans.dimensions import calendar, date_bounds
from starloom.plans.star import Star
from starloom.schemas import PROFILE_ATTRIBUTES, UNKNOWN
from starloom.session import cut_lineage

CUTOFF = date(2001, 1, 1)
PRIMARY_CATEGORY = "PROMO"
MIN_REVIEWS = 20

# Values that break a check, by column; each is put into every 31st row, shifted per column.
BAD_VALUES = {
    "nf.review": {"rating": 9, "total_feedback_count": -3, "total_pos_feedback_count": -1,
                  "total_neg_feedback_count": -2, "review_length": -5, "helpfulness": 7},
    "nf.product": {"price_usd": 0, "loves_count": -1, "rating": 9, "reviews": -1, "child_count": -1},
    "dw.dim_date": {"quarter": 9, "month": 13, "day": 40, "day_of_week": 0},
}

_ROW_ID = """((l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey) * 10000
             + datediff(l_shipdate, date'1990-01-01')"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _measures() -> dict:
    total = F.expr("cast(round(l_discount * 100) as int)")
    liked = F.floor(total / 2).cast("int")
    flag = F.col("l_returnflag")
    return {
        "source_row_id": F.expr(_ROW_ID),
        "product_id": F.col("l_partkey").cast("string"),
        "submission_date": F.to_date("l_shipdate"),
        "rating": (F.col("l_quantity").cast("int") % 5 + 1).cast("short"),
        "is_recommended": F.when(flag == "N", True).when(flag == "R", False),
        "total_feedback_count": total,
        "total_pos_feedback_count": liked,
        "total_neg_feedback_count": total - liked,
        "helpfulness": (liked / F.nullif(total, F.lit(0))).cast("decimal(18,16)"),
        "review_length": F.when(F.col("l_suppkey") % 50 != 0,
                                F.floor(F.col("l_extendedprice") / 80).cast("int")),
    }


def _lines(spark: SparkSession, folder: str, reviewers: bool = False, profiles: bool = False) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    if not (reviewers or profiles):
        return lines
    orders = table(spark, folder, "orders")
    if profiles:
        # Orders meet their customers first, so the long line items are moved once.
        customers = table(spark, folder, "customer")
        orders = orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")


def _attributes() -> dict:
    """The four attributes before missing ones get a name."""
    return {
        "skin_tone": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")),
        "skin_type": F.col("o_orderstatus"),
        "eye_color": F.col("c_mktsegment"),
        "hair_color": F.col("l_linestatus"),
    }


def _named_attributes() -> dict:
    return {a: F.coalesce(c, F.lit(UNKNOWN)) for a, c in _attributes().items()}


def _columns(parts: dict) -> list:
    return [c.alias(n) for n, c in parts.items()]


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as staged catalogue rows."""
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("product_name"),
        F.substring_index("p_brand", "#", -1).cast("int").alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("primary_category"),
        F.concat(F.lit("S"), size % 8).alias("secondary_category"),
        F.when(size % 5 != 0, F.col("p_name")).alias("tertiary_category"),
        ((F.col("p_retailprice") - 900) * 2 + 3).cast("decimal(10,2)").alias("price_usd"),
        F.concat(size, F.lit(" oz")).alias("size"),
        (size * 1000 + F.col("p_partkey") % 97).cast("int").alias("loves_count"),
        (size % 2 == 0).alias("limited_edition"), (size % 3 == 0).alias("new"),
        (size % 4 == 0).alias("online_only"), (size % 7 == 0).alias("out_of_stock"),
        (size % 5 == 1).alias("retailer_exclusive"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as staged review rows."""
    parts = {**_measures(), "author_id": F.col("o_custkey").cast("string"), **_named_attributes()}
    lines = _lines(spark, folder, profiles=True)
    return lines.select(*_columns(parts)).withColumn("review_id", F.col("source_row_id"))


def star(
    spark: SparkSession, folder: str, reviewers: bool = False, profiles: bool = False,
    dates: bool = False,
) -> Star:
    """The star of the mapped reviews.

    Facts that need no reviewer come from the line items alone; asking for
    reviewers or profiles adds the joins that know them. Dimensions that were not
    asked for are left out.
    """
    parts = {
        **_measures(),
        "product_key": F.col("l_partkey"),
        "date_key": date_key(F.to_date("l_shipdate")),
    }
    if reviewers or profiles:
        parts["customer_key"] = F.col("o_custkey")
    lines = _lines(spark, folder, reviewers, profiles)
    customer = profile = date = None
    if profiles:
        profile_key = F.xxhash64(*PROFILE_ATTRIBUTES)
        named = lines.select(*_columns(_named_attributes())).distinct()
        # Stored, so that its small size is known to every join with the facts.
        profile = cut_lineage(named.withColumn("reviewer_profile_key", profile_key))
        lines = lines.withColumns(_named_attributes())
        parts["reviewer_profile_key"] = profile_key
        customer = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("customer_key"), F.col("c_custkey").cast("string").alias("customer_id"))
    fact = lines.select(*_columns(parts))
    if dates:
        date = calendar(date_bounds(fact))

    products = catalogue(spark, folder)
    key = F.col("brand_id").cast("long").alias("brand_key")
    product = products.select(
        "*", F.col("product_id").cast("long").alias("product_key"), key,
        price_band(F.col("price_usd")).alias("price_band"),
    ).drop("brand_id", "brand_name")
    brand = products.select(key, "brand_id", "brand_name").distinct()
    return Star(fact, product, brand, customer, profile, date)


# --- the same rows as uncleaned text ----------------------------------------------------------


def raw_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as catalogue text: padded names, mixed number formats, repeated rows."""
    part = table(spark, folder, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    pad = F.when(key % 7 == 0, F.lit("  ")).otherwise(F.lit(""))

    def flag(rule):
        return F.when(rule, "1").otherwise("0")

    none = F.lit(None).cast("string")
    price = ((F.col("p_retailprice") - 900) * 2 + 3).cast("decimal(10,2)")
    rows = part.select(
        key.cast("string").alias("product_id"),
        F.concat(pad, F.col("p_name"), pad).alias("product_name"),
        F.concat(F.substring_index("p_brand", "#", -1), F.when(key % 3 == 0, ".0").otherwise(""))
        .alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
        (size * 1000 + key % 97).cast("string").alias("loves_count"),
        F.when(key % 11 == 0, "n.a.").otherwise((F.lit(1) + size % 5).cast("string")).alias("rating"),
        (key % 500).cast("string").alias("reviews"),
        F.when(size % 10 == 0, "").otherwise(F.concat(size, F.lit(" oz"))).alias("size"),
        F.when(key % 2 == 0, "Color").alias("variation_type"),
        F.when(key % 2 == 0, F.split("p_name", " ")[0]).alias("variation_value"),
        none.alias("variation_desc"), F.col("p_type").alias("ingredients"),
        price.cast("string").alias("price_usd"), none.alias("value_price_usd"),
        F.when(key % 9 == 0, (price - 1).cast("string")).alias("sale_price_usd"),
        flag(size % 2 == 0).alias("limited_edition"), flag(size % 3 == 0).alias("new"),
        flag(size % 4 == 0).alias("online_only"), flag(size % 7 == 0).alias("out_of_stock"),
        flag(size % 5 == 1).alias("retailer_exclusive"),
        F.when(size % 10 == 0, "not a list[")
        .when(size % 10 < 9, F.concat(F.lit("['"), F.col("p_type"), F.lit("', \""),
                                      F.col("p_brand"), F.lit("'s\"]"))).alias("highlights"),
        F.col("p_type").alias("primary_category"),
        F.concat(F.lit("S"), size % 8).alias("secondary_category"),
        F.when(size % 5 == 0, "").otherwise(F.col("p_name")).alias("tertiary_category"),
        (size % 4).cast("string").alias("child_count"),
        none.alias("child_max_price"), none.alias("child_min_price"),
    )
    again = rows.where(F.col("product_id").cast("long") % 50 == 0)
    return rows.unionByName(again.withColumn("product_name", F.concat("product_name", F.lit(" \t"))))


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as review text: five files, defects, and a sixth file of repeats."""
    spelled = {
        **_attributes(),
        "skin_tone": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "notSureST")
        .otherwise(F.col("o_orderpriority")),
        "eye_color": F.when(F.col("c_mktsegment") == "FURNITURE", "Grey").otherwise(F.col("c_mktsegment")),
    }
    measures = _measures()
    flag = F.col("l_returnflag")
    text = {n: c.cast("string") for n, c in measures.items()}
    parts = {
        **text, **spelled,
        "author_id": F.col("o_custkey").cast("string"),
        "rating": F.concat(text["rating"], F.when(F.col("l_partkey") % 4 == 0, ".0").otherwise("")),
        "is_recommended": F.when(flag == "N", "1.0").when(flag == "R", "0.0"),
        "submission_time": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "review_text": F.when(F.col("l_suppkey") % 50 != 0, F.concat(
            F.lit("  "), F.col("o_orderpriority"), F.lit(", \""), F.col("l_quantity").cast("int"),
            F.lit("\"\nship "), F.col("l_shipdate").cast("date"), F.lit(" "))),
        "review_title": F.when(F.col("l_linenumber") != 3, F.concat_ws(" ", "l_returnflag", "l_linestatus")),
        "product_name": F.concat(F.lit("part "), F.col("l_partkey")),
        "brand_name": F.lit("any"),
        "price_usd": F.col("l_tax").cast("string"),
        "source_file": F.concat(F.lit("reviews_"), F.col("l_suppkey") % 5, F.lit(".csv")),
    }
    del parts["submission_date"], parts["review_length"]
    rows = _lines(spark, folder, profiles=True).select(*_columns(parts))
    # The repeats are made beside their rows, so the joins run once for both.
    number = F.col("source_row_id").cast("long")
    once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    rows = rows.withColumn("_again", F.explode(F.when(number % 10 == 0, twice).otherwise(once)))
    again = {
        "source_row_id": (F.lit(10**18) + number).cast("string"),
        "source_file": F.lit("reviews_9.csv"),
        "author_id": F.concat("author_id", F.lit(" ")),
    }
    return rows.withColumns({n: F.when(F.col("_again"), c).otherwise(F.col(n)) for n, c in again.items()}).drop("_again")
