"""Flagship query: exact AUC/F1/precision/recall of three scorers on every
split of the deterministic stratified split of ``churn_base``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators import metrics as M
from churnspark.plans import fixtures as fx
from churnspark.operators.split import stratified_split

SCORERS = ("score", "score_tenure", "score_orders")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stratified_split(fx.scored_churn(spark, sf_dir), "c_custkey", "churn")
    long = s.select("split", "churn", F.explode(F.array(*[
        F.struct(F.lit(c).alias("model_key"), F.col(c).alias("score")) for c in SCORERS])).alias("kv")) \
        .select("split", "churn", "kv.*")
    return M.metrics(long, "churn", "score", group_cols=["split", "model_key"])
