"""Exact ranks, quantiles and balanced joins against a plain computation."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthline.operators import ranks as R
from hearthline.operators.skew import lookup_join, salted_lookup
from hearthline.operators.text import sample_per_group
from hearthline.session import cut_lineage


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("abc"), rng.randint(-300_000, 900_000)) for i in range(600)]
    # A third of the rows share one value of one group; one group has a single row.
    rows += [(1000 + i, "a", 5) for i in range(300)] + [(5000, "alone", 42)]
    return spark.createDataFrame(rows, "id long, g string, v long").cache()


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_percent_rank_equals_window(values):
    lookup = R.percent_rank_lookup(values, ["g"], "v", "p")
    got = salted_lookup(values, lookup, ["g", "v"], spread="id", weight="n", rows_per_task=20)
    want = values.withColumn("p", F.percent_rank().over(Window.partitionBy("g").orderBy("v")))
    assert rows_of(got, "id", "p") == rows_of(want, "id", "p")


def test_descending_rank_equals_window(values):
    got = R.with_descending_rank(values, [], "v", "r", "id")
    want = values.withColumn("r", F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("v"))))
    assert rows_of(got, "id", "r") == rows_of(want, "id", "r")


@pytest.mark.parametrize("p", [0.01, 0.33, 0.5, 0.66, 0.95, 1.0])
def test_quantile_is_smallest_value_reaching_the_share(values, p):
    got = {r["g"]: r["cut"] for r in R.quantile_cuts(values, ["g"], "v", {"cut": p}).collect()}
    groups = {}
    for row in values.collect():
        groups.setdefault(row["g"], []).append(row["v"])
    for name, items in groups.items():
        items.sort()
        want = next(v for i, v in enumerate(items, 1) if i * 10_000 >= round(p * 10_000) * len(items))
        assert got[name] == want


def test_quantile_of_nothing(spark, values):
    assert R.quantile_cuts(values.where("g = 'z'"), ["g"], "v", {"cut": 0.5}).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_lookup_join_equals_plain_join(spark, values, how):
    lookup = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "g string, w int")
    plain = values.join(lookup, ["g"], how)
    for limit in (0, 1000):
        got = lookup_join(values, lookup, ["g"], "id", how, max_rows=limit, copies=5)
        assert rows_of(got, *plain.columns) == rows_of(plain, *plain.columns)


def test_large_sample_equals_window(values):
    order = Window.partitionBy("g").orderBy(F.md5(F.col("id").cast("string")), "id")
    big = values.crossJoin(values.sparkSession.range(8).withColumnRenamed("id", "k")).select(
        (F.col("id") * 10 + F.col("k")).alias("id"), "g")
    want = big.withColumn("position", F.row_number().over(order)).where("position <= 1500")
    got = sample_per_group(big, ["g"], "id", 1500)
    assert rows_of(got, "g", "id", "position") == rows_of(want, "g", "id", "position")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_copies_of_a_large_lookup_never_pass_the_driver(spark, values, how):
    lookup = cut_lineage(values.select("g", F.lit(1).alias("x")).distinct())
    for computed in (True, False):
        joined = lookup_join(values, lookup, ["g"], "id", how, computed=computed, max_rows=1, copies=5)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        plain = values.join(lookup, "g", how)
        assert rows_of(joined, *plain.columns) == rows_of(plain, *plain.columns)
