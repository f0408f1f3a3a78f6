import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from conftest import ATTRIBUTES, frame, product, review, rows
from pyspark.sql import functions as F

from starloom.operators import joins, upsert
from starloom.operators.quality import ConstraintError, DataQualityError
from starloom.plans import clean, dimensions, load, normalize, views
from starloom.plans.star import read_star
from starloom.schemas import (
    BATCH_TABLES, DIM_CUSTOMER, DIM_PRODUCT, FACT, NF_REVIEW, RAW_PRODUCT, RAW_REVIEW, STAGED_PRODUCT, STAGED_REVIEW,
    STG_BRAND, STG_CUSTOMER, STG_PRODUCT, STG_PROFILE,
)
from starloom.session import scratch_path
from starloom.sources import csv_files, layers
from starloom.streaming import incremental as inc

REVIEWS = [
    review(1, "P1", "A1", date(2021, 5, 1)), review(2, "P2", "A1", date(2022, 5, 2), 3, total=0),
    review(3, "P1", "A2", date(2022, 12, 31), 1), review(4, "P2", "A3", date(2023, 1, 1), 4),
    review(5, "P1", "A3", date(2023, 2, 1), 5, skin_tone="deep"),
]


def warehouse(spark, records=REVIEWS, catalogue=None):
    root = scratch_path(spark, "wh")
    layers.overwrite(frame(spark, STAGED_PRODUCT, catalogue or [product("P1"), product("P2", 2, "60")]),
                     root, STAGED_PRODUCT)
    layers.overwrite(frame(spark, STAGED_REVIEW, records), root, STAGED_REVIEW)
    return root


def test_modes_partition_and_repeat_safely(spark):
    root = warehouse(spark)
    first = load.run_load(spark, root, inc.HISTORICAL)
    assert (first["rows_extracted"], first["rows_inserted"], first["watermark_after"]) == (3, 3, "2022-12-31")
    keys = rows(layers.read_table(spark, root, FACT), "source_row_id", "review_key")

    second = load.run_load(spark, root, inc.INCREMENTAL)
    assert (second["watermark"], second["rows_inserted"], second["product_inserted"]) == ("2022-12-31", 2, 0)
    third = load.run_load(spark, root, inc.FULL)
    assert (third["rows_extracted"], third["rows_inserted"], third["rows_already_present"]) == (5, 0, 5)

    # Numbers already given never change.
    after = rows(layers.read_table(spark, root, FACT), "source_row_id", "review_key")
    assert after[:3] == keys and len({k for _, k in after}) == 5

    # Nothing is left to load: an empty batch is a clean run.
    nothing = load.run_load(spark, root, inc.INCREMENTAL)
    assert set(nothing) == set(second) and nothing["watermark_after"] == nothing["watermark"] == "2023-02-01"
    assert [nothing[c] for c in nothing if c.startswith(("rows_", "dropped_"))] == [0] * 11
    empty = load.run_staged_load(spark, root, "scheduled__2026-01-01T00:00:00+00:00", inc.INCREMENTAL)
    assert (empty["rows_extracted"], empty["rows_inserted"]) == (0, 0)
    assert layers.read_if_present(spark, root, RAW_REVIEW) is None

    star = read_star(spark, root)
    assert views.kpi_summary(star).first().total_reviews == 5
    assert rows(views.rating_by_brand(star), "brand_name", "review_count") == [("brand 1", 3), ("brand 2", 2)]


def test_late_review_is_only_recovered_by_a_full_load(spark):
    root = warehouse(spark)
    load.run_staged_load(spark, root, "b1", inc.FULL)
    late = [*REVIEWS, review(6, "P1", "A1", date(2022, 6, 1))]
    layers.overwrite(frame(spark, STAGED_REVIEW, late), root, STAGED_REVIEW)
    run = load.run_load(spark, root, inc.INCREMENTAL)
    assert (run["rows_inserted"], run["rows_late"], run["rows_late_unusable"]) == (0, 1, 0)
    assert inc.report_delta(load.report_row(spark, {"n": 5}), load.report_row(spark, {"n": 8}), "n").first().delta == 3
    staged, stored = layers.read_table(spark, root, STAGED_REVIEW), layers.read_table(spark, root, FACT)
    assert inc.backlog(staged, stored).first().status == "unaccounted"
    assert load.run_load(spark, root, inc.FULL)["rows_inserted"] == 1


def test_a_changed_price_stays_as_loaded(spark):
    root = warehouse(spark)
    load.run_load(spark, root, inc.FULL)
    layers.overwrite(frame(spark, STAGED_PRODUCT, [product("P1", price="99"), product("P2", 2, "60")]),
                     root, STAGED_PRODUCT)
    load.run_load(spark, root, inc.INCREMENTAL)
    stored = {r.product_id: float(r.price_usd) for r in layers.read_table(spark, root, DIM_PRODUCT).collect()}
    assert stored == {"P1": 20.0, "P2": 60.0}


def test_a_failed_run_cleans_its_batch_and_writes_no_fact(spark):
    root = warehouse(spark, [review(1, "P1", "A1", date(2021, 5, 1), 7)])
    with pytest.raises(DataQualityError, match="value_range"):
        load.run_staged_load(spark, root, "b:1+x", inc.FULL)
    assert all(layers.read_batch(spark, root, t, "b:1+x").count() == 0 for t in BATCH_TABLES)
    assert layers.read_table(spark, root, FACT).count() == 0


def test_unknown_modes_are_refused(spark):
    with pytest.raises(ValueError, match="Unknown load mode"):
        load.run_load(spark, "/nowhere", "everything")
    with pytest.raises(ValueError, match="Unknown load mode"):
        load.run_staged_load(spark, "/nowhere", "b", inc.HISTORICAL)


def test_staging_a_batch_twice_replaces_it(spark):
    root = scratch_path(spark, "batch")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "brand_id int, brand_name string")
    assert layers.stage_batch(df, root, STG_BRAND, "x") == 2
    assert layers.stage_batch(df.limit(0), root, STG_BRAND, "x") == 0
    assert layers.read_batch(spark, root, STG_BRAND, "x").count() == 0


def test_a_wrong_row_count_leaves_the_table_alone(spark):
    root = warehouse(spark)
    with pytest.raises(layers.RowCountError):
        layers.overwrite(frame(spark, STAGED_REVIEW, REVIEWS[:1]), root, STAGED_REVIEW, expected=2)
    assert layers.read_table(spark, root, STAGED_REVIEW).count() == 5


def test_incremental_extract_reads_only_the_months_it_needs(spark):
    root = warehouse(spark)
    batch = inc.extract_batch(spark, root, inc.INCREMENTAL, date(2022, 12, 31))
    assert rows(batch, "source_row_id") == [(4,), (5,)]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "PushedFilters: [IsNotNull(submission_date)" in plan


PRODUCT_HEADER = (
    "product_id,product_name,brand_id,brand_name,loves_count,rating,reviews,size,variation_type,"
    "variation_value,variation_desc,ingredients,price_usd,value_price_usd,sale_price_usd,limited_edition,"
    "new,online_only,out_of_stock,shop_exclusive,highlights,primary_category,secondary_category,"
    "tertiary_category,child_count,child_max_price,child_min_price")
REVIEW_HEADER = (
    ",author_id,rating,is_recommended,helpfulness,total_feedback_count,total_neg_feedback_count,"
    "total_pos_feedback_count,submission_time,review_text,review_title,skin_tone,eye_color,skin_type,"
    "hair_color,product_id,product_name,brand_name,price_usd")


@pytest.fixture
def source_files(tmp_path):
    tail = "0,0,1,0,1,\"['Vegan']\",Skincare,Masks,,2,,"
    (tmp_path / "product_info.csv").write_text("\n".join([
        PRODUCT_HEADER,
        f"P1, Cream ,7.0,Acme,10,4.5,3,1 oz,,,,x,20,,,{tail}",
        f"P1,Cream,7.0,Acme,10,4.5,3,1 oz,,,,x,20,,,{tail}",
        f"P2,Mask,7.0,Acme,20,n.a.,3,NA,,,,x,50.5,,,{tail}"]) + "\n")
    (tmp_path / "reviews_1.csv").write_text("\n".join([
        REVIEW_HEADER,
        '0,A1,5,1.0,0.5,2,1,1,2022-01-05," two\nlines, ""quoted"" ",Good,light,Grey,dry,brown,P1,Cream,Acme,20',
        '1,A2,4,,,0,0,0,2023-02-05,nice,NA,notSureST,,,,P1,Cream,Acme,20']) + "\n")
    (tmp_path / "reviews_2.csv").write_text("\n".join([
        REVIEW_HEADER,
        '0,A1 ,1,0.0,1.0,1,0,1,2022-01-05,later copy,,light,gray,dry,brown,P1,Cream,Acme,20',
        '1,A1,3,0.0,1.0,1,0,1,2022-01-06,,,light,gray,dry,brown,P2,Mask,Acme,50.5']) + "\n")
    return tmp_path


def test_files_to_star(spark, source_files):
    root = scratch_path(spark, "files")
    staged = load.land_files(spark, root, str(source_files / "product_info.csv"),
                             str(source_files / "reviews_*.csv"))
    assert staged == {"product": 2, "review": 3}
    raw = layers.read_table(spark, root, RAW_REVIEW)
    first = raw.where("author_id = 'A1' and product_id = 'P1'").first()
    assert (first.rating, first.eye_color, first.review_text) == (5, "gray", 'two\nlines, "quoted"')
    assert (first.review_length, first.source_file) == (len('two\nlines, "quoted"'), "reviews_1.csv")
    second = raw.where("author_id = 'A2'").first()
    assert (second.skin_tone, second.review_title, second.is_recommended) == (None, None, None)
    unknown = layers.read_table(spark, root, STAGED_REVIEW).where("author_id = 'A2'").first()
    assert {unknown[a] for a in ATTRIBUTES} == {"Unknown"}
    # Landing the same files again adds nothing to the normalised layer.
    assert load.land_files(spark, root, str(source_files / "product_info.csv"),
                           str(source_files / "reviews_*.csv")) == staged
    assert load.run_load(spark, root, inc.FULL)["rows_inserted"] == 3


def test_column_pruned_read_keeps_row_and_file(spark, source_files):
    df = csv_files.read_reviews(spark, str(source_files / "reviews_*.csv"), ["product_id"])
    assert df.columns == ["source_row_id", "product_id", "source_file"]
    assert rows(df, "source_file", "source_row_id", "product_id")[-1] == ("reviews_2.csv", "1", "P2")


def test_a_file_with_other_columns_is_refused(spark, source_files):
    (source_files / "reviews_3.csv").write_text(",rating,author_id\n0,5,A1\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        csv_files.read_reviews(spark, str(source_files / "reviews_*.csv")).collect()


@pytest.mark.parametrize("column, value", [
    ("submission_time", "soon"), ("submission_time", None), ("rating", "4.5"), ("is_recommended", "maybe")])
def test_unusable_values_are_refused(spark, source_files, column, value):
    raw = csv_files.read_reviews(spark, str(source_files / "reviews_*.csv"))
    with pytest.raises(clean.CleaningError):
        clean.clean_reviews(raw.withColumn(column, F.lit(value).cast("string")))


def test_a_brand_with_two_names_is_refused(spark, source_files):
    raw = csv_files.read_catalogue(spark, str(source_files / "product_info.csv"))
    with pytest.raises(ValueError, match="brand_id"):
        clean.clean_products(raw.withColumn("brand_name", F.col("product_id")))


def test_raw_rows_can_be_appended(spark, source_files):
    root = scratch_path(spark, "append")
    products = clean.clean_products(csv_files.read_catalogue(spark, str(source_files / "product_info.csv")))
    reviews = clean.clean_reviews(csv_files.read_reviews(spark, str(source_files / "reviews_1.csv")))
    expected = {"products": 2, "reviews": 2}
    assert load.ingest(root, products, reviews, expected) == expected
    assert load.ingest(root, products.limit(0), reviews, append=True) == {"products": 2, "reviews": 4}


def test_dropped_reviews_are_not_late(spark):
    root = warehouse(spark, [*REVIEWS, review(8, "GHOST", "A1", date(2021, 1, 1)), review(9, "GHOST", "A2", date(2021, 2, 1))])
    first = load.run_load(spark, root, inc.FULL)
    assert (first["rows_dropped"], first["dropped_unresolved_product"]) == (2, 2)
    second = load.run_load(spark, root, inc.INCREMENTAL)
    assert (second["rows_late"], second["rows_late_unusable"]) == (0, 2)


def test_raw_tables_change_together_or_not_at_all(spark, source_files):
    root = scratch_path(spark, "both")
    products = clean.clean_products(csv_files.read_catalogue(spark, str(source_files / "product_info.csv")))
    reviews = clean.clean_reviews(csv_files.read_reviews(spark, str(source_files / "reviews_1.csv")))
    load.ingest(root, products, reviews)
    with pytest.raises(layers.RowCountError):
        load.ingest(root, products.limit(1), reviews, {"products": 1, "reviews": 3})
    assert layers.read_table(spark, root, RAW_PRODUCT).count() == 2
    assert layers.read_table(spark, root, RAW_REVIEW).count() == 2


def test_a_publication_that_fails_keeps_the_table(spark, monkeypatch):
    root = warehouse(spark)

    def refuse(*_):
        raise OSError("store is full")

    with monkeypatch.context() as patched:
        patched.setattr(layers, "_swap", refuse)
        with pytest.raises(OSError):
            layers.overwrite(frame(spark, STAGED_REVIEW, REVIEWS[:1]), root, STAGED_REVIEW)
    assert layers.read_table(spark, root, STAGED_REVIEW).count() == 5
    assert len(os.listdir(f"{root}/staging/review")) == 1


def test_two_hundred_rounds_of_four_publishers_lose_nothing(spark):
    root = scratch_path(spark, "rounds")
    tables = [STG_BRAND, STG_CUSTOMER, STG_PRODUCT, STG_PROFILE]
    with ThreadPoolExecutor(max_workers=4) as pool:
        for i in range(200):
            given = [layers.Version(t, f"v-{i}-{t.name}", 1) for t in tables]
            list(pool.map(lambda v: layers.put_in_force(spark, root, [v], keep=True), given))
            if i % 50 == 49:
                state = layers._state(spark, root, "batch")["now"]
                assert state == {t.name: [f"v-{k}-{t.name}" for k in range(i + 1)] for t in tables}
    assert os.listdir(f"{root}/batch") == [layers.POINTER]


def test_the_pointer_is_replaced_through_the_file_system_too(spark, monkeypatch):
    root = scratch_path(spark, "rename")
    monkeypatch.setattr(layers, "_swap", layers._swap_by_rename)
    for rows in (REVIEWS, REVIEWS[:2], REVIEWS[:3]):
        layers.overwrite(frame(spark, STAGED_REVIEW, rows), root, STAGED_REVIEW)
        assert layers.read_table(spark, root, STAGED_REVIEW).count() == len(rows)


def test_readers_of_the_version_before_still_find_it(spark):
    root = warehouse(spark)
    held = layers.read_table(spark, root, STAGED_REVIEW)
    layers.overwrite(frame(spark, STAGED_REVIEW, REVIEWS[:2]), root, STAGED_REVIEW)
    assert held.count() == 5 and layers.read_table(spark, root, STAGED_REVIEW).count() == 2
    layers.overwrite(frame(spark, STAGED_REVIEW, REVIEWS[:1]), root, STAGED_REVIEW)
    assert len(os.listdir(f"{root}/staging/review")) == 2


def test_dimensions_are_put_in_force_together_or_not_at_all(spark, monkeypatch):
    root = warehouse(spark)
    monkeypatch.setattr(dimensions, "run_quality_checks", lambda *_: (_ for _ in ()).throw(DataQualityError("no")))
    with pytest.raises(DataQualityError):
        load.run_load(spark, root, inc.FULL)
    for table in dimensions.STAR_TABLES:
        assert layers.read_table(spark, root, table).count() == 0
        assert not os.path.exists(f"{root}/dw/{table.name}") or os.listdir(f"{root}/dw/{table.name}") == []


def test_an_append_that_dies_leaves_the_facts_as_they_were(spark, monkeypatch):
    root = warehouse(spark)
    load.run_load(spark, root, inc.HISTORICAL)
    with monkeypatch.context() as patched:
        patched.setattr(layers, "put_in_force", lambda *_, **__: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            load.run_load(spark, root, inc.FULL)
    assert layers.read_table(spark, root, FACT).count() == 3
    assert load.run_load(spark, root, inc.FULL)["rows_inserted"] == 2


def test_day_digests_follow_every_write(spark):
    root = warehouse(spark)
    load.run_load(spark, root, inc.HISTORICAL)
    load.run_load(spark, root, inc.INCREMENTAL)
    for table in (STAGED_REVIEW, FACT):
        kept = rows(layers.read_days(spark, root, table), "day", "rows", "keys")
        assert kept == rows(layers.day_digests(layers.read_table(spark, root, table), table), "day", "rows", "keys")
    assert inc.read_watermark(spark, root) == date(2023, 2, 1)
    assert inc.unsettled_days(spark, root, date(2023, 2, 1)) == []


def test_an_incremental_run_without_late_rows_opens_no_earlier_month(spark, monkeypatch):
    root = warehouse(spark)
    load.run_load(spark, root, inc.HISTORICAL)
    opened = []
    monkeypatch.setattr(layers, "read_on_days", lambda *a: opened.append(a))
    assert inc.late_candidates(spark, root, date(2022, 12, 31)) is None and opened == []


def test_late_rows_open_their_months_alone(spark):
    root = warehouse(spark)
    load.run_load(spark, root, inc.FULL)
    late = [*REVIEWS, review(6, "P1", "A1", date(2022, 5, 1))]
    layers.overwrite(frame(spark, STAGED_REVIEW, late), root, STAGED_REVIEW)
    assert inc.unsettled_days(spark, root, date(2023, 2, 1)) == [date(2022, 5, 1)]
    found = inc.late_candidates(spark, root, date(2023, 2, 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(_month#") >= 2 and plan.count("= 2022-05)") + plan.count("IN (2022-05)") >= 2
    assert rows(found, "source_row_id") == [(6,)]
    # A review whose date changed still meets its fact: both days are opened.
    moved = [*REVIEWS[:2], review(3, "P1", "A2", date(2022, 12, 30), 1), *REVIEWS[3:]]
    layers.overwrite(frame(spark, STAGED_REVIEW, moved), root, STAGED_REVIEW)
    assert len(inc.unsettled_days(spark, root, date(2023, 2, 1))) == 2
    assert inc.late_candidates(spark, root, date(2023, 2, 1)).count() == 0


def test_a_failed_staging_keeps_the_batch(spark):
    root = scratch_path(spark, "batch")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "brand_id int, brand_name string")
    layers.stage_batch(good, root, STG_BRAND, "x")
    layers.stage_batch(good.where("brand_id = 1"), root, STG_BRAND, "y")
    broken = spark.range(50).select(F.when(F.col("id") > 40, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast(
        "int").alias("brand_id"), F.lit("c").alias("brand_name"))
    with pytest.raises(Exception, match="no"):
        layers.stage_batch(broken, root, STG_BRAND, "x")
    assert layers.read_batch(spark, root, STG_BRAND, "x").count() == 2
    assert layers.stage_batch(good.where("brand_id = 2"), root, STG_BRAND, "x") == 1
    assert layers.read_batch(spark, root, STG_BRAND, "y").count() == 1


class Killed(BaseException):
    """The driver is gone: nothing after it runs."""


def test_a_load_killed_after_every_step_repeats_none(spark, monkeypatch):
    root, whole = warehouse(spark), warehouse(spark)
    wanted = load.run_staged_load(spark, whole, "b", inc.FULL)
    work, ran = dict(load.STEPS), []

    def watched(name):
        def run(given):
            if ran and ran[-1] is not None:  # one step a life
                ran.append(None)
                raise Killed
            ran.append(name)
            return work[name](given)
        return run

    monkeypatch.setattr(load, "STEPS", {name: watched(name) for name in work})
    for _ in range(len(work) - 1):
        with pytest.raises(Killed):
            load.run_staged_load(spark, root, "b", inc.FULL)
    assert load.run_staged_load(spark, root, "b", inc.FULL) == wanted
    assert [name for name in ran if name] == list(work)
    assert load.finished_steps(spark, root, "b") == {}


def test_a_step_needs_those_before_it(spark):
    root = warehouse(spark)
    with pytest.raises(ValueError, match="needs brand"):
        load.run_step(spark, root, "b", "customer")
    assert load.run_step(spark, root, "b", "brand") == load.run_step(spark, root, "b", "brand") == {"brand_inserted": 2}


def test_registered_views_follow_a_load_and_run_nothing(spark):
    root = warehouse(spark)
    load.run_load(spark, root, inc.HISTORICAL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("register", "views")
    views.register_views(spark, root, min_reviews=1)
    assert list(tracker.getJobIdsForGroup("register")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.sql("select total_reviews from vw_kpi_summary").first()[0] == 3
    load.run_load(spark, root, inc.FULL)
    assert spark.sql("select total_reviews from vw_kpi_summary").first()[0] == 5
    assert spark.sql("select sum(review_count) from vw_hype_vs_reality").first()[0] == 5
    assert spark.sql("select sum(review_count) from vw_rating_by_brand").first()[0] == 5


def test_an_orphan_review_and_a_repeated_brand_name_are_refused(spark, source_files):
    root = scratch_path(spark, "orphans")
    products = clean.clean_products(csv_files.read_catalogue(spark, str(source_files / "product_info.csv")))
    reviews = clean.clean_reviews(csv_files.read_reviews(spark, str(source_files / "reviews_*.csv")))
    load.ingest(root, products.where("product_id = 'P1'"), reviews)
    with pytest.raises(ConstraintError, match="references_product_product_id=1"):
        normalize.rebuild_staging(spark, root)
    assert layers.read_table(spark, root, NF_REVIEW).count() == 0
    other = scratch_path(spark, "brands")
    renamed = products.withColumn("brand_id", F.when(F.col("product_id") == "P1", 7).otherwise(8))
    load.ingest(other, renamed, reviews)
    with pytest.raises(ConstraintError, match="unique_brand_name=1"):
        normalize.rebuild_staging(spark, other)


def test_stored_keys_are_compared_without_moving_them(spark, monkeypatch):
    root = scratch_path(spark, "keyed")
    ids = spark.range(5000).select(F.col("id").cast("string").alias("customer_id"))
    monkeypatch.setattr(joins, "FEW_KEYS", 10)
    spark.conf.set(layers.BUCKETS, "4")
    try:
        assert upsert.insert_absent(ids.where("customer_id < 2000"), root, DIM_CUSTOMER).inserted == 2000
    finally:
        spark.conf.unset(layers.BUCKETS)
    assert upsert.insert_absent(ids.where("customer_id < 3000"), root, DIM_CUSTOMER).inserted == 1000
    keys = layers.read_keys(spark, root, DIM_CUSTOMER)
    assert keys.count() == 3000
    fresh = joins.without_bucketed(ids, keys, ["customer_id"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastExchange" not in plan and fresh.count() == 2000
    few = joins.without_bucketed(ids.where("customer_id in ('7', '4000')"), keys, ["customer_id"])
    assert "In(customer_id" in few._jdf.queryExecution().executedPlan().toString()
    assert [r.customer_id for r in few.collect()] == ["4000"]
    done = upsert.insert_absent(ids.limit(0), root, DIM_CUSTOMER)
    assert (done.offered, done.inserted) == (0, 0)
    with pytest.raises(ConstraintError):
        upsert.insert_absent(spark.createDataFrame([(None,)], "customer_id string"), root, DIM_CUSTOMER)


def test_rows_without_stored_keys_are_compared_as_they_are(spark):
    root = scratch_path(spark, "unkeyed")
    ids = spark.range(30).select(F.col("id").cast("string").alias("customer_id"))
    upsert.insert_absent(ids.limit(10), root, DIM_CUSTOMER)
    layers.put_in_force(spark, root, [layers.Version(layers.keys_table(DIM_CUSTOMER), None, 0)])
    assert layers.read_keys(spark, root, DIM_CUSTOMER) is None
    done = upsert.insert_absent(ids, root, DIM_CUSTOMER)
    assert (done.offered, done.inserted) == (30, 20)


def test_keys_of_an_insert_that_dies_are_not_in_force(spark, monkeypatch):
    root = warehouse(spark)
    load.run_load(spark, root, inc.HISTORICAL)

    def dies(*args, **kwargs):
        raise OSError("no space left")

    with monkeypatch.context() as patch:
        patch.setattr(layers, "put_in_force", dies)
        with pytest.raises(OSError):
            load.run_load(spark, root, inc.FULL)
    assert layers.read_keys(spark, root, FACT).count() == layers.read_table(spark, root, FACT).count() == 3
    assert load.run_load(spark, root, inc.FULL)["rows_inserted"] == 2
    assert layers.read_keys(spark, root, FACT).count() == 5


def test_landing_copies_the_reviews_once_besides_the_layers(spark, source_files):
    # Intermediate copies made while landing, found by their review texts: cleaning's and the new nf rows'.
    from starloom.session import shared_dir
    shared = shared_dir(spark)
    before = set(os.listdir(shared))
    load.land_files(spark, scratch_path(spark, "files"), str(source_files / "product_info.csv"),
                    str(source_files / "reviews_*.csv"))
    made = [f for f in set(os.listdir(shared)) - before if f.startswith("stored-")]
    texts = [f for f in made if "review_text" in spark.read.parquet(f"{shared}/{f}").columns]
    assert len(texts) <= 2, texts
