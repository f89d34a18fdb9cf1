"""Inference-log analytics: summaries, daily series, pivots, top-k.

Input: the log table ``(id, timestamp, model, inputs, probability,
prediction, risk_level)``.  Every group-by here has low-cardinality keys
(day x model) and is partially aggregated on each task, so a model that
produces a third of all rows costs no more than the others after the
map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.scalar import pred_label, ts_display


def _date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("timestamp"))


def daily_rate(log: DataFrame) -> DataFrame:
    """``(date, model, churn_rate)`` = mean prediction per day and model."""
    return _date(log).groupBy("date", "model").agg(F.avg("prediction").alias("churn_rate"))


def daily_volume(log: DataFrame) -> DataFrame:
    """``(date, model, n)``."""
    return _date(log).groupBy("date", "model").agg(F.count(F.lit(1)).alias("n"))


def pivot_rate(log: DataFrame, models: Sequence[str]) -> DataFrame:
    """Date x model mean prediction; a missing (date, model) stays NULL.

    One conditional aggregate per listed model in a SINGLE group-by on
    date (``DataFrame.pivot`` would aggregate twice with two shuffles)."""
    d = _date(log)
    return d.groupBy("date").agg(*[F.avg(F.when(F.col("model") == m, F.col("prediction"))).alias(m)
                                   for m in models])


def pivot_volume(log: DataFrame, models: Sequence[str]) -> DataFrame:
    """Date x model row count; a missing (date, model) is 0."""
    d = _date(log)
    return d.groupBy("date").agg(*[F.count_if(F.col("model") == m).alias(m) for m in models])


def risk_distribution(log: DataFrame) -> DataFrame:
    """``(model, risk_level, n)``; only models with rows appear."""
    return log.groupBy("model", "risk_level").agg(F.count(F.lit(1)).alias("n"))


def avg_probability(log: DataFrame, digits: int = 4) -> DataFrame:
    """``(model, avg_probability)`` rounded to ``digits``."""
    return log.groupBy("model").agg(F.round(F.avg("probability"), digits).alias("avg_probability"))


def log_summary(log: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row: total predictions, calls per listed model, overall churn rate."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(F.col("model") == m).alias(f"n_{m}") for m in models]
    aggs.append(F.avg("prediction").alias("churn_rate"))
    return log.agg(*aggs)


def batch_rate(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """One row ``(n_inputs, positive_rate)`` of a scored batch."""
    return scored.agg(F.count(F.lit(1)).alias("n_inputs"), F.avg(pred).alias("positive_rate"))


def newest_first(log: DataFrame) -> DataFrame:
    """Newest first; NULL timestamps last; id breaks ties (deterministic)."""
    return log.orderBy(F.col("timestamp").desc_nulls_last(), F.col("id").desc())


def recent(log: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` newest predictions for display (a top-k: TakeOrderedAndProject,
    each task keeps only its own k rows)."""
    top = newest_first(log).limit(k)
    return top.select(ts_display("timestamp").alias("timestamp"), "model",
                      pred_label("prediction").alias("prediction"), "probability", "risk_level")
