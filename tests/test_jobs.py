"""Composed jobs: ingest -> prepare -> train/evaluate/promote, twice."""

from pyspark.sql import functions as F

from churnspark.plans import jobs
from churnspark.sources import logs as LG
from conftest import SF0001


def test_ingest_prepare_train_promote(spark, tmp_dir):
    csv, prof = jobs._telco_like_csv(spark, SF0001)
    counts = jobs.job_ingest(spark, csv, tmp_dir + "/curated", prof,
                             numeric_text=("total", "tenure", "n_orders", "c_acctbal"))
    assert counts["duplicates_dropped"] == 0 and counts["rows_saved"] == counts["rows_loaded"]
    curated = jobs._typed(spark.read.parquet(tmp_dir + "/curated"))
    jobs.job_prepare(spark, curated, prof, tmp_dir + "/prep")
    splits = spark.read.parquet(tmp_dir + "/prep/splits")
    assert splits.where(F.col("c_mktsegment").isNull() | F.col("total").isNull()).count() == 0
    reg = tmp_dir + "/registry"
    d1 = jobs.job_train_evaluate(spark, tmp_dir + "/prep/splits", prof, reg, algorithms=("logreg", "boosted"),
                                 trees=3).first()
    assert d1["promote"] and not d1["has_production"] and d1["version"] == 2
    v1 = {r["version"]: r["stage"] for r in spark.read.parquet(reg).collect()}
    assert v1 == {1: "candidate", 2: "production"}
    # the same learners again: no AUC gain > 0.01 -> production unchanged
    d2 = jobs.job_train_evaluate(spark, tmp_dir + "/prep/splits", prof, reg, algorithms=("logreg", "boosted"),
                                 trees=3).first()
    assert d2["version"] == 4 and d2["has_production"] and not d2["promote"]
    v2 = {r["version"]: r["stage"] for r in spark.read.parquet(reg).collect()}
    assert v2[2] == "production" and v2[4] == "candidate"


def test_empty_log_folder(spark, tmp_dir):
    assert LG.scan_log(spark, tmp_dir + "/nothing").count() == 0
