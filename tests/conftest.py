import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.schemas import EXTRACT_COLUMNS, FACT, STAGED_PRODUCT, STAGED_REVIEW  # noqa: E402
from starloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]


def frame(spark, table, records, columns=None):
    """A typed frame of a stored table from dictionaries; missing columns are null."""
    fields = [f for f in table.schema if columns is None or f.name in columns]
    from pyspark.sql.types import StructType

    data = [tuple(r.get(f.name) for f in fields) for r in records]
    return spark.createDataFrame(data, StructType(fields))


ATTRIBUTES = {"skin_tone": "light", "skin_type": "dry", "eye_color": "blue", "hair_color": "blonde"}


def review(number, product, author, day, rating=5, **changes):
    total = changes.pop("total", 2)
    return {
        "review_id": number, "source_row_id": number, "product_id": product, "author_id": author,
        "submission_date": day, "rating": rating, "is_recommended": True,
        "helpfulness": Decimal("0.5") if total else None, "total_feedback_count": total,
        "total_pos_feedback_count": total // 2, "total_neg_feedback_count": total - total // 2,
        "review_length": 100, **ATTRIBUTES, **changes,
    }


def product(product_id, brand_id=1, price="20.00", **changes):
    return {
        "product_id": product_id, "product_name": f"name {product_id}", "brand_id": brand_id,
        "brand_name": f"brand {brand_id}", "primary_category": "Skincare",
        "secondary_category": "Moisturizers", "tertiary_category": None,
        "price_usd": None if price is None else Decimal(price), "size": None, "loves_count": 10,
        "limited_edition": False, "new": False, "online_only": False, "out_of_stock": False,
        "retailer_exclusive": False, **changes,
    }


@pytest.fixture
def reviews(spark):
    def build(*records):
        return frame(spark, STAGED_REVIEW, records, EXTRACT_COLUMNS)
    return build


@pytest.fixture
def products(spark):
    def build(*records):
        return frame(spark, STAGED_PRODUCT, records)
    return build


@pytest.fixture
def two_reviews(reviews):
    return reviews(review(1, "P1", "A1", date(2023, 1, 1)),
                   review(2, "P2", "A2", date(2023, 1, 2), 4, total=4))


@pytest.fixture
def lookups(spark):
    make = spark.createDataFrame
    return {
        "product": make([("P1", 10), ("P2", 20)], "product_id string, product_key long"),
        "customer": make([("A1", 100), ("A2", 200)], "customer_id string, customer_key long"),
        "reviewer_profile": make(
            [(*ATTRIBUTES.values(), 7)],
            ", ".join(f"{a} string" for a in ATTRIBUTES) + ", reviewer_profile_key long"),
        "date": make([(date(2023, 1, 1), 20230101), (date(2023, 1, 2), 20230102)],
                     "full_date date, date_key int"),
    }


def fact_record(number, product_key, customer, profile, key, rating, total, length):
    return {
        "review_key": number, "source_row_id": number, "product_id": f"P{number}",
        "product_key": product_key, "customer_key": customer, "reviewer_profile_key": profile,
        "date_key": key, "rating": rating, "is_recommended": rating > 3,
        "helpfulness": Decimal("0.5") if total else None, "total_feedback_count": total,
        "total_pos_feedback_count": total // 2, "total_neg_feedback_count": total - total // 2,
        "review_length": length, "submission_date": date(2023, 1, number),
    }


GOOD_FACTS = [
    fact_record(1, 1, 1, 1, 20230101, 5, 2, 100),
    fact_record(2, 2, 2, 1, 20230102, 4, 4, 250),
    fact_record(3, 3, 3, 2, 20230103, 3, 0, 80),
]


@pytest.fixture
def facts(spark):
    """Valid fact rows; ``changes`` maps a position to the columns to break."""
    def build(changes=None):
        records = [{**r, **(changes or {}).get(i, {})} for i, r in enumerate(GOOD_FACTS)]
        return frame(spark, FACT, records)
    return build
