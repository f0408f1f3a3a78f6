import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.dedup import keep_first
from starloom.operators.joins import hot_keys, lookup_join, without_matches
from starloom.operators.keys import with_percent_rank, with_rank_fraction


def skewed(spark, n=6000):
    """A third of all rows share one key; some keys are null."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 101 == 0, F.lit(None))
        .otherwise(F.col("id") % 500).cast("long").alias("k"),
        F.col("id").alias("v"))


def test_salted_join_equals_plain_join(spark):
    df = skewed(spark)
    lookup = spark.range(1, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    salted = lookup_join(df, lookup, ["k"], broadcast_ok=False)
    assert "_salt" not in salted.columns
    assert rows(salted, "v", "k", "x") == rows(df.join(lookup, "k", "left"), "v", "k", "x")
    broadcast = lookup_join(df, lookup, ["k"])
    assert rows(salted, "v", "k", "x") == rows(broadcast, "v", "k", "x")


@pytest.mark.parametrize("share", [3, 1500])
def test_hot_keys_are_cut_into_shares(spark, share):
    """Also a key that holds less than a thousandth of the rows, once partitions are many."""
    df = spark.range(60000).select(F.when(F.col("id") % share == 0, -1).otherwise(F.col("id")).alias("k"))
    partitions = 40 if share == 3 else 10000
    found = {r.h: r.shares for r in hot_keys(df, ["k"], partitions).collect()}
    assert list(found) == [spark.range(1).select(F.xxhash64(F.lit(-1).cast("long")).alias("h")).first().h]
    average = 60000 / partitions
    assert 60000 / share / found[next(iter(found))] <= average


def test_salted_null_safe_join(spark):
    df = skewed(spark)
    lookup = spark.createDataFrame([(None, "none"), (1, "one")], "k long, x string")
    found = lookup_join(df, lookup, ["k"], null_safe=True, broadcast_ok=False)
    counts = {r.x: r["count"] for r in found.groupBy("x").count().collect()}
    assert counts["one"] == df.where("k = 1").count()
    assert counts["none"] == df.where("k is null").count()


def test_keep_first_equals_a_window(spark):
    random.seed(3)
    data = [(random.choice([None, "a", "b", "c"]), random.randint(0, 3), f"f{i % 3}", i) for i in range(200)]
    df = spark.createDataFrame(data, "a string, b int, source_file string, source_row_id long")
    order = Window.partitionBy("a", "b").orderBy("source_file", "source_row_id")
    naive = df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
    kept = keep_first(df, ["a", "b"], ["source_file", "source_row_id"])
    assert rows(kept, *df.columns) == rows(naive, *df.columns)


def test_percent_rank_equals_a_window(spark):
    random.seed(5)
    values = [random.choice([0, 0, 0, 1, 70_000, 140_000, random.randint(0, 10**9), -5]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, loves int")
    naive = df.withColumn("p", F.percent_rank().over(Window.orderBy("loves")))
    ours = with_percent_rank(df, "loves", "p")
    for a, b in zip(rows(naive, "id", "p"), rows(ours, "id", "p")):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-12


def test_percent_rank_of_one_row_is_zero(spark):
    df = spark.createDataFrame([(1, 9)], "id int, loves int")
    assert with_percent_rank(df, "loves", "p").first().p == 0


def test_without_matches_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "p string, s string")
    known = spark.createDataFrame([("a", None)], "p string, s string")
    assert set(map(tuple, without_matches(df, known, ["p", "s"]).collect())) == {("a", "x"), ("b", None)}


def test_one_row_stays_of_rows_that_tie(spark):
    rows_in = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "n"), ("a", None, "n"), ("b", None, "p"), ("b", None, "p"),
               (None, 2, "q"), (None, 2, "q"), (None, 3, "r"), ("c", 5, "s")]
    df = spark.createDataFrame(rows_in, "k string, o int, v string")
    kept = keep_first(df, ["k"], ["o"])
    found = {r.k: (r.o, r.v) for r in kept.collect()}
    assert kept.count() == 4 and found["a"] == (None, "n") and found["b"] == (None, "p")
    assert found[None] == (2, "q") and found["c"] == (5, "s")


def test_percent_rank_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7), (4, 9), (5, None)], "id int, v int")
    naive = df.withColumn("p", F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())))
    assert rows(with_percent_rank(df, "v", "p"), "id", "p") == rows(naive, "id", "p")


@pytest.mark.parametrize("kind, values", [
    ("double", [0.5, -0.0, 0.0, float("nan"), None, 1e300, -1e300] + [2.5] * 40),
    ("date", ["2020-02-29", None, "1999-12-31", "2020-02-29"]), ("decimal(38,18)", ["0.000000000000000001", "1e9", None]),
    ("string", ["b", "a", "", None, "a"]), ("long", [7]), ("long", [None, None]), ("long", [])])
def test_rank_fraction_equals_the_window_form(spark, kind, values):
    df = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "i long, text string")
    df = df.select("i", F.col("text").cast(kind).alias("v"))
    window = Window.orderBy(F.col("v").asc_nulls_last())
    wanted = df.select("i", F.percent_rank().over(window).alias("r")).orderBy("i").collect()
    assert with_rank_fraction(df, "v", "r").select("i", "r").orderBy("i").collect() == wanted
