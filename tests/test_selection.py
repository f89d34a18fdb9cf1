"""Order statistics by narrowing brackets and split by boundary selection."""

import random

import pytest
from pyspark.sql import functions as F

from churnspark.operators import quantiles as qt, split as sp, stats


@pytest.mark.parametrize("last", [1, 7, 1000])
def test_order_statistics_equal_sorting(spark, last):
    rng = random.Random(last)
    wide = [[rng.choice([1e300, -1e-300, 0.0, 5.0]) if rng.random() < 0.5 else rng.gauss(0, 10 ** rng.randrange(-8, 8)), float(rng.randrange(5)),
             7.0, None, rng.choice([None, float("nan"), 1.0, 2.0, float("inf")])] for _ in range(700)]
    df = spark.createDataFrame(wide, "a double, b double, c double, d double, e double").repartition(5)
    ranks = lambda n: [0, n // 3, (n - 1) // 2, n // 2, n - 1]
    got = {(r.feature, r.rank): (r.n, r.value) for r in qt.order_statistics(df, list("abcde"), ranks, last).collect()}
    want = {}
    for i, c in enumerate("abcde"):
        v = sorted(x[i] for x in wide if x[i] is not None and x[i] == x[i])
        want.update({(c, k): (len(v), v[k]) for k in set(ranks(len(v))) if v})
    assert got == want


def test_median_of_many_columns_in_few_jobs(spark):
    df = spark.range(4000).select(*[(F.col("id") * (7 + i) % 1009).cast("double").alias(f"x{i}") for i in range(12)])
    want = df.agg(*[F.percentile(f"x{i}", 0.5).alias(f"x{i}") for i in range(12)]).first().asDict()
    assert {r[0]: r[1] for r in stats.median(df, df.columns).collect()} == want
    assert {r[0]: r[1] for r in stats.median(df, df.columns, n_buckets=400).collect()} == want


@pytest.mark.parametrize("last", [1, 20, 100_000])
def test_split_by_boundaries_equals_ranks(spark, monkeypatch, last):
    monkeypatch.setattr(sp, "LAST_ROWS", last)
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).alias("y"))
    got = sp.stratified_split(df.repartition(4), "k", "y", hex_digits=1)
    assert sorted(map(tuple, got.select("k", "split").collect())) == sorted(map(tuple, sp.window_split(df, "k", "y").select("k", "split").collect()))


def test_split_of_few_rows_and_of_a_hot_key(spark):
    few = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, y string")
    assert sorted(sp.stratified_split(few, "k", "y").collect()) == sorted(sp.window_split(few, "k", "y").collect())
    assert sp.stratified_split(few.limit(0), "k", "y").count() == 0
    hot = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit(1).alias("y"), (F.col("id") % 50).alias("x"))
    n = {r["split"]: r["count"] for r in sp.stratified_split(hot, "k", "y").groupBy("split").count().collect()}
    assert abs(n["train"] - 6300) < 60 and abs(n["val"] - 1350) < 60


def test_split_shuffles_no_wide_row(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), F.repeat(F.lit("x"), 500).alias("wide"))
    plan = sp.stratified_split(df, "k", "y")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line or "Sort [" in line]
    assert moved and all("wide" not in line and "[k#" not in line for line in moved)  # the table of boundaries alone
