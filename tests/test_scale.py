"""What long tables must not do: be shuffled where a few bits say which rows stay."""

import datetime
import os
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import registry
from starloom.operators import bits, joins
from starloom.operators.dedup import keep_first
from starloom.operators.keys import number_rows
from starloom.session import cut_lineage, shared_dir
from starloom.sources import tpch_reviews as mapped


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder, lines=60):
    """Order tables of a few rows, with an unknown order, an unknown customer and nulls."""
    day = datetime.datetime(2000, 1, 29)  # whose numbers of days since 1990 end in 0 to 3
    held = {
        "lineitem": ([(i % 20, i % 7, i % 5, i % 3 if i % 9 else None, float(i % 50), 100.0 * i, (i % 10) / 100, 0.02,
                       "NRA"[i % 3], "OF"[i % 2], day + datetime.timedelta(days=i % 4)) for i in range(lines)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp"),
        "orders": ([(i, i % 6 if i % 8 else None, "OFP"[i % 3], 1.0, day, "4-NOT SPECIFIED" if i % 2 else "1-URGENT")
                    for i in range(18)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string"),
        "customer": ([(i, f"c{i}", 1, 1.0, "FURNITURE" if i % 2 else "BUILDING") for i in range(5)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (data, schema) in held.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def naive_first(df, key, order):
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


@pytest.mark.parametrize("limit", [4096, 1])
def test_keep_first_does_not_shuffle_the_rows(spark, monkeypatch, limit):
    """repeated keys too many to broadcast; their bits are not, unless the limit is a byte."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    df = spark.range(9000).select((F.col("id") % 3000).cast("string").alias("k"), F.concat(F.lit("f"), F.col("id") % 4).alias("f"),
                                  F.col("id").alias("o"), F.repeat(F.lit("x"), 50).alias("wide"))
    kept = keep_first(df, ["k"], ["f", "o"])
    if limit > 1:
        # Only the counts per file are exchanged.
        assert "SortMergeJoin" not in plan(kept)
        assert plan(kept).count("Exchange hashpartitioning") == plan(kept).count("Exchange hashpartitioning(_file")
    assert rows(kept, *df.columns) == rows(naive_first(df, ["k"], ["f", "o"]), *df.columns)


def test_numbering_does_not_shuffle_the_rows(spark):
    """the row per file is broadcast, whatever size the optimizer thinks it has."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        numbered = number_rows(spark.range(100).repartition(3), "n")
        assert "SortMergeJoin" not in plan(numbered)
        assert sorted(r.n for r in numbered.collect()) == list(range(1, 101))
    finally:
        spark.conf.set(threshold, held)


def test_repeats_are_made_without_a_second_join(spark, tmp_path):
    """two joins in all, and the rows of the two unions that they replace."""
    folder = tables(spark, tmp_path)
    raw = mapped.raw_reviews(spark, folder)
    assert plan(raw).count("Join") == 2
    found = raw.select("source_row_id", "source_file", "author_id").collect()
    number = {r.source_row_id: r for r in found if r.source_file != "reviews_9.csv"}
    again = [r for r in found if r.source_file == "reviews_9.csv"]
    wanted = {n for n in number if n is not None and int(n) % 10 == 0}
    assert {str(int(r.source_row_id) - 10**18) for r in again} == wanted and again
    assert sum(1 for r in found if r.source_file != "reviews_9.csv") == 60
    for r in again:
        first = number[str(int(r.source_row_id) - 10**18)].author_id
        assert r.author_id == (None if first is None else f"{first} ")


@pytest.mark.parametrize("odd", [False, True])
def test_bits_hold_a_set(spark, odd):
    random.seed(4)
    numbers = [random.choice([0, 63, 64, 2047, 2048, 10**6, 10**6 + 63, random.randint(0, 5000)]) for _ in range(400)] + [None]
    held = bits.bit_set(spark.createDataFrame([(n,) for n in numbers], "_bit long"), odd)
    wanted = {n for n in numbers if n is not None and (not odd or numbers.count(n) % 2)}
    asked = cut_lineage(spark.range(5200).unionByName(spark.range(10**6 - 100, 10**6 + 100)))
    inside = {r.id for r in bits.with_bit(asked, F.col("id"), held).collect()}
    outside = {r.id for r in bits.with_bit(asked, F.col("id"), held, unset=True).collect()}
    assert inside == wanted and outside == {r.id for r in asked.collect()} - wanted


def test_layers_store_the_reviews_once(spark, tmp_path):
    """F4 to F9: the trimmed rows are stored; the typed ones are read from them, not stored again."""
    folder = tables(spark, tmp_path / "tables")
    held = set(os.listdir(shared_dir(spark)))
    found = registry._layers(spark, folder)["raw.reviews"]
    made = set(os.listdir(shared_dir(spark))) - held
    wide = [n for n in made if "review_text" in spark.read.parquet(f"{shared_dir(spark)}/{n}").columns]
    key = [F.trim(c).alias(c) for c in ("author_id", "product_id", "submission_time")]
    assert len(wide) == 1 and found.count() == mapped.raw_reviews(spark, folder).select(*key).distinct().count()
    assert dict(found.dtypes)["rating"] == "smallint"


@pytest.mark.parametrize("held, moved", [("id < 0", False), ("id % 2 = 0", True), ("id >= 0", False)])
def test_only_keys_of_long_frames_are_compared(spark, monkeypatch, held, moved):
    """rows are not shuffled where none or all of them are new; a null key equals a null key."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 64)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        df = cut_lineage(spark.range(400).select("id", F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"),
                                                 F.concat(F.lit("v"), "id").alias("v")))
        existing = cut_lineage(df.where(held).select("k"))
        found = joins.without_matches(df, existing, ["k"])
        assert ("Exchange" in plan(found)) == moved
        known = {r.k for r in existing.collect()}
        assert {r.id for r in found.collect()} == {r.id for r in df.collect() if r.k not in known}
        assert found.columns == df.columns
    finally:
        spark.conf.set(threshold, before)
