from datetime import date

import pytest
from conftest import review, product, rows

from starloom.operators.keys import number_rows
from starloom.operators.reconcile import ReconciliationError, count_present, account_for_rows
from starloom.plans import dimensions, fact
from starloom.schemas import FACT_DROP_REASONS, FACT_KEYS
from starloom.sources.csv_files import NULL_TOKENS

ZERO = dict.fromkeys(FACT_DROP_REASONS, 0)


def outcome(reviews, lookups):
    resolved = fact.resolve_facts(reviews, lookups)
    return resolved, *fact.count_outcome(resolved)


def test_keys_resolve_to_the_right_members(two_reviews, lookups):
    resolved, kept, drops = outcome(two_reviews, lookups)
    assert (kept, drops) == (2, ZERO)
    assert rows(fact.fact_rows(resolved), "product_id", *FACT_KEYS) == [
        ("P1", 10, 100, 7, 20230101), ("P2", 20, 200, 7, 20230102)]


def test_keys_keep_whole_number_types(two_reviews, lookups):
    kinds = dict(fact.fact_rows(fact.resolve_facts(two_reviews, lookups)).dtypes)
    assert [kinds[k] for k in FACT_KEYS] == ["bigint", "bigint", "bigint", "int"]


@pytest.mark.parametrize("change, reason", [
    ({"product_id": "GHOST"}, "unresolved_product"),
    ({"author_id": "NOBODY"}, "unresolved_customer"),
    ({"skin_type": "combination"}, "unresolved_reviewer_profile"),
    ({"submission_date": date(1999, 1, 1)}, "out_of_range_date"),
    # Several unknown keys on one row count once, under the first reason.
    ({"product_id": "GHOST", "author_id": "NOBODY"}, "unresolved_product"),
    ({"author_id": "NOBODY", "submission_date": date(1999, 1, 1)}, "unresolved_customer"),
])
def test_every_drop_has_its_reason(reviews, lookups, change, reason):
    df = reviews(review(1, "P1", "A1", date(2023, 1, 1)),
                 {**review(2, "P2", "A2", date(2023, 1, 2)), **change})
    resolved, kept, drops = outcome(df, lookups)
    assert (kept, drops) == (1, {**ZERO, reason: 1})
    assert {r.reason: r.rows for r in fact.drops_by_reason(resolved).collect()} == drops


def test_no_reviews_drop_nothing(reviews, lookups):
    _, kept, drops = outcome(reviews(), lookups)
    assert (kept, drops) == (0, ZERO)


def test_repeated_lookup_key_breaks_the_accounting(two_reviews, lookups):
    twice = {**lookups, "product": lookups["product"].union(lookups["product"])}
    _, kept, drops = outcome(two_reviews, twice)
    with pytest.raises(ReconciliationError):
        account_for_rows(2, kept, drops, "fact")


def test_unknown_brand_is_dropped_and_bands_are_left_closed(spark, products):
    prices = ["9.99", "15.00", "30.00", "50.00", "250.00", "-1.00", None]
    df = products(*[product(f"P{i}", price=p) for i, p in enumerate(prices)], product("X", brand_id=999))
    brand = spark.createDataFrame([(1, 5)], "brand_id int, brand_key long")
    resolved = dimensions.resolve_products(df, brand)
    kept = dimensions.product_rows(resolved)
    assert resolved.where("drop_reason = 'unresolved_brand'").count() == 1
    assert [r[1] for r in rows(kept, "product_id", "price_band")] == [
        "Under $15", "$15-30", "$30-50", "$50-100", "$100+", None, None]
    assert {r.brand_key for r in kept.collect()} == {5}


def test_identities():
    assert account_for_rows(100, 95, {"unresolved_product": 5}, "t") == 5
    with pytest.raises(ReconciliationError, match="5 have none"):
        account_for_rows(100, 90, {"unresolved_product": 5}, "t")
    with pytest.raises(ReconciliationError):
        account_for_rows(10, 20, {"unresolved_product": 0}, "t")
    assert count_present(100, 40, "t") == 60
    assert count_present(1000, 0, "t") == 1000
    with pytest.raises(ReconciliationError):
        count_present(10, 50, "t")


def test_calendar_fields_over_a_year_boundary(spark):
    days = dimensions.calendar_between(spark, date(2022, 12, 31), date(2023, 1, 2))
    assert rows(days, "date_key", "week", "day_of_week", "day_name", "month_name", "is_weekend") == [
        (20221231, 52, 6, "Saturday", "December", True),
        (20230101, 52, 7, "Sunday", "January", True),
        (20230102, 1, 1, "Monday", "January", False)]


def test_numbering_is_dense_and_repeatable(spark):
    df = spark.range(5000).repartition(13).selectExpr("cast(id as string) as k")
    numbered = number_rows(df, "n", start=7)
    first = {r.k: r.n for r in numbered.collect()}
    assert sorted(first.values()) == list(range(8, 5008))
    assert first == {r.k: r.n for r in numbered.repartition(3).collect()}
    assert number_rows(df.limit(0), "n").count() == 0
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan


def test_null_tokens_are_listed_once():
    assert len(NULL_TOKENS) == len(set(NULL_TOKENS))
