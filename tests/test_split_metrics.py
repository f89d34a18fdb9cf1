"""Stratified split and exact metrics (distributed forms vs plain windows)."""

import random

import pytest
from pyspark.sql import functions as F

from churnspark.functions.scalar import risk_band, threshold_predict
from churnspark.operators import metrics as M
from churnspark.operators.split import stratified_split, window_split
from churnspark.plans import fixtures as fx
from conftest import SF001


def test_split_matches_window_form_and_counts(spark):
    b = fx.churn_base(spark, SF001)
    a = {(r[0], r[1]) for r in stratified_split(b, "c_custkey", "churn").select("c_custkey", "split").collect()}
    w = {(r[0], r[1]) for r in window_split(b, "c_custkey", "churn").select("c_custkey", "split").collect()}
    assert a == w
    counts = dict(((r[0], r[1]), r[2]) for r in stratified_split(b, "c_custkey", "churn")
                  .groupBy("split", "churn").count().collect())
    assert counts == {("train", 0): 822, ("train", 1): 225, ("val", 0): 176, ("val", 1): 49,
                      ("test", 0): 176, ("test", 1): 48}


def test_split_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    a = {tuple(r) for r in stratified_split(df.repartition(13), "k", "y", hex_digits=2).collect()}
    b = {tuple(r) for r in stratified_split(df.coalesce(1), "k", "y").collect()}
    assert a == b


def _auc(spark, scores, labels, **kw):
    df = spark.createDataFrame(list(zip(scores, labels)), "s double, y int")
    return M.roc_auc(df, "y", "s", **kw).first()["roc_auc"]


def test_auc_edges(spark):
    assert _auc(spark, [0.5] * 6, [0, 1, 0, 1, 1, 0]) == 0.5
    assert _auc(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1]) == 1.0
    assert _auc(spark, [0.1, 0.2], [1, 1]) is None


def test_auc_distributed_equals_window_and_symmetry(spark):
    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "s double, y int")
    a = M.roc_auc(df, "y", "s", n_buckets=16).first()["roc_auc"]
    w = M.window_roc_auc(df, "y", "s").first()["roc_auc"]
    flipped = M.roc_auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first()["roc_auc"]
    assert a == pytest.approx(w, abs=1e-15)
    assert flipped == pytest.approx(1 - a, abs=1e-12)
    assert M.roc_auc(fx.churn_base(spark, SF001), "churn", "tenure").first()["roc_auc"] == \
        pytest.approx(0.4881424127313321, abs=1e-15)


def test_prf_zero_when_undefined(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s double, y int")
    m = M.metrics(df, "y", "s").first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)
    cm = {(r[0], r[1]): r[2] for r in M.confusion_matrix(M.with_prediction(df, "s"), "y", "prediction").collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "y int, p int")
    rep = {r["class_label"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 0.5 and rep["1"]["support"] == 2
    assert rep["0"]["precision"] == pytest.approx(2 / 3) and rep["accuracy"]["f1"] == 0.6
    assert rep["weighted avg"]["recall"] == pytest.approx(0.6)


def test_threshold_and_risk_edges(spark):
    df = spark.createDataFrame([(0.3999,), (0.4,), (0.5,), (0.6999,), (0.7,)], "p double")
    got = [(r[0], r[1]) for r in df.select(threshold_predict("p"), risk_band("p")).collect()]
    assert got == [(0, "Low"), (0, "Medium"), (1, "Medium"), (1, "Medium"), (1, "High")]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    w = {r["label"]: r["weight"] for r in M.class_weights(df, "y").collect()}
    assert w == {0: 4 / 6, 1: 2.0}


def test_auc_weighted_multiclass(spark):
    df = spark.createDataFrame([(0, 0.8, 0.1, 0.1), (1, 0.1, 0.7, 0.2), (2, 0.1, 0.2, 0.7), (1, 0.3, 0.4, 0.3)],
                               "y int, p0 double, p1 double, p2 double")
    assert M.auc_weighted(df, "y", ["p0", "p1", "p2"]).first()[0] == 1.0


def test_hot_value_and_partition_invariance(spark):
    """One score / value holds a third of the rows; results do not depend on
    spark.sql.shuffle.partitions."""
    from churnspark.operators import stats as ST
    rows = [(0.5 if i % 3 == 0 else (i % 997) / 997.0, int(i % 5 == 0)) for i in range(6000)]
    df = spark.createDataFrame(rows, "s double, y int")
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append((M.roc_auc(df, "y", "s").first()["roc_auc"], ST.median(df, ["s"]).first()["median"],
                        sorted(tuple(r) for r in stratified_split(
                            df.withColumn("k", F.monotonically_increasing_id()).select("k", "y"),
                            "k", "y").groupBy("split", "y").count().collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
    assert out[0][0] == pytest.approx(M.window_roc_auc(df, "y", "s").first()["roc_auc"], abs=1e-15)
    assert out[0][1] == df.agg(F.percentile("s", 0.5)).first()[0]


def test_bucketed_paths_when_tables_are_large(spark, monkeypatch):
    """Force many buckets (tiny per-bucket target): encoder codes, medians and
    AUC still equal their single-window forms."""
    from churnspark.operators import features as FE, prefix as px, stats as ST
    df = spark.range(0, 3000).select(
        F.concat(F.lit("v"), (F.col("id") * 7 % 701).cast("string")).alias("c"),
        (F.col("id") * 13 % 997).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    base_codes = {(r[0], r[1]): r[2] for r in FE.label_encode_fit(df, ["c"]).collect()}
    base_med = ST.median(df, ["x"]).first()["median"]
    base_auc = M.roc_auc(df, "y", "x").first()["roc_auc"]
    monkeypatch.setattr(px, "TARGET_ROWS_PER_BUCKET", 50)
    assert px.adaptive_buckets(spark, 3000) > 1
    assert {(r[0], r[1]): r[2] for r in FE.label_encode_fit(df, ["c"]).collect()} == base_codes
    assert ST.median(df, ["x"]).first()["median"] == base_med == df.agg(F.percentile("x", 0.5)).first()[0]
    assert M.roc_auc(df, "y", "x").first()["roc_auc"] == pytest.approx(base_auc, abs=1e-15)
    values = sorted({r[0] for r in df.select("c").distinct().collect()})
    assert [base_codes[("c", v)] for v in values] == list(range(len(values)))
