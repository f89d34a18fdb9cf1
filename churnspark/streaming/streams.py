"""Incremental versions of the log analytics, scoring and drift.

* :func:`daily_rate_stream` -- each micro-batch writes its own (day, model)
  sums and counts under its batch id (a replayed batch replaces itself); the
  reader adds them up.  There is no watermark and no state, so rows that
  arrive late count like any other and the result equals the batch
  :func:`churnspark.operators.logs.daily_rate`.
* :func:`score_stream` -- score arriving request rows, append to the
  partitioned JSON log (file sink, exactly-once through the checkpoint).
* :func:`drift_stream` -- drift report of each micro-batch against the
  baseline profile, written idempotently per batch id.

* :func:`requests_stream` -- request bodies to scored and rejected rows, one
  commit per micro-batch.
* :func:`drift_state_stream` -- counts and sums per micro-batch that add up, so
  drift is known for any span of batches.

Every query runs with ``trigger(availableNow=True)`` by default: it drains
what is there in bounded micro-batches and stops, so it can run as a scheduled
job; ``trigger="continuous"`` starts it without end and returns at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.scalar import nan_to_null
from churnspark.operators import drift as D, stats


def _start(writer, trigger: dict | None, checkpoint: str):
    w = writer.option("checkpointLocation", checkpoint)
    if trigger == "continuous":
        return w.start()  # micro-batches without end; the caller stops the query
    q = w.trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()
    return q


def _idempotent_batch_writer(out: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        df = transform(batch, batch_id) if transform else batch
        # overwrite exactly this batch's folder: a replayed batch replaces itself
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def daily_rate_stream(log_stream: DataFrame, out: str, checkpoint: str, trigger: dict | str | None = None):
    """Run the incremental daily rate; the sums of each batch land under ``out``."""
    def sums(batch: DataFrame, batch_id: int) -> DataFrame:
        return (batch.groupBy(F.to_date("timestamp").alias("date"), "model")
                .agg(F.sum("prediction").alias("s"), F.count("prediction").alias("known"), F.count(F.lit(1)).alias("n")))
    writer = log_stream.writeStream.foreachBatch(_idempotent_batch_writer(out, sums))
    return _start(writer, trigger, checkpoint)


def daily_rate_result(spark: SparkSession, out: str) -> DataFrame:
    """The rate per day and model over all batches (a map-side combined sum)."""
    total = spark.read.parquet(out).groupBy("date", "model").agg(*[F.sum(c).alias(c) for c in ("s", "known", "n")])
    rate = F.when(F.col("known") > 0, F.col("s") / F.col("known"))
    return total.select("date", "model", rate.alias("churn_rate"), "n")


def score_stream(requests: DataFrame, score: Callable[[DataFrame], DataFrame], log_root: str,
                 checkpoint: str, trigger: dict | str | None = None):
    """``score`` maps request rows to log rows (id, timestamp, model, inputs,
    probability, prediction, risk_level); results are appended to the
    model/day-partitioned JSON log."""
    scored = score(requests)
    out = scored.select(
        F.col("id").cast("string").alias("id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        "inputs", "prediction", "probability", "risk_level", "model",
        F.to_date("timestamp").cast("string").alias("date"))
    writer = out.writeStream.format("json").outputMode("append").partitionBy("model", "date") \
        .option("path", log_root)
    return _start(writer, trigger, checkpoint)


def requests_stream(requests: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, trigger: dict | str | None = None):
    """``score`` maps request rows to outcome rows (scored and rejected); each
    micro-batch is one commit under its batch id."""
    from churnspark.plans.scoring import write_outcomes
    return _start(requests.writeStream.foreachBatch(lambda batch, batch_id: write_outcomes(score(batch), out, batch_id)), trigger, checkpoint)


# ------------------------------------------------- drift from mergeable state
def profile_state(batch: DataFrame, numeric, categorical) -> DataFrame:
    """``(feature, value, n, s)``: of a numeric feature (value null) the number
    and sum of its known values, of a categorical one the count per value.
    States of batches add up to the state of all their rows."""
    x = {c: nan_to_null(F.col(c).cast("double")) for c in numeric}
    number = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("value"), F.count(x[c]).alias("n"),
                                F.coalesce(F.sum(x[c]), F.lit(0.0)).alias("s")) for c in numeric])
    parts = []
    if numeric:
        parts.append(batch.agg(number.alias("a")).select(F.explode("a").alias("e")).select("e.*"))
    if categorical:
        parts.append(stats.value_counts(batch, categorical).select("feature", "value", "n", F.lit(0.0).alias("s")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_state_stream(live_stream: DataFrame, numeric, categorical, out: str, checkpoint: str, trigger: dict | str | None = None):
    """Keep the state of every micro-batch under its batch id."""
    writer = live_stream.writeStream.foreachBatch(
        _idempotent_batch_writer(out, lambda batch, _: profile_state(batch, numeric, categorical)))
    return _start(writer, trigger, checkpoint)


def drift_of_batches(spark: SparkSession, out: str, num_profile: DataFrame, cat_profile: DataFrame,
                     first: int | None = None, last: int | None = None) -> DataFrame:
    """The drift report of all rows of the batches ``first`` to ``last``
    (default: all), from their states alone."""
    state = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    if first is not None:
        state = state.where(F.col("batch_id") >= first)
    if last is not None:
        state = state.where(F.col("batch_id") <= last)
    total = state.groupBy("feature", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    means = total.where("value IS NULL").select("feature", (F.col("s") / F.when(F.col("n") > 0, F.col("n"))).alias("live_mean"))
    return D.drift_report_of(means, total.where("value IS NOT NULL").select("feature", "value", "n"), num_profile, cat_profile)


def drift_stream(live_stream: DataFrame, num_profile: DataFrame, cat_profile: DataFrame, out: str,
                 checkpoint: str, trigger: dict | str | None = None):
    """Drift report per micro-batch; profiles are small static tables."""
    def report(batch: DataFrame, batch_id: int) -> DataFrame:
        return D.drift_report(batch, num_profile, cat_profile).withColumn("batch_id_", F.lit(batch_id))
    writer = live_stream.writeStream.foreachBatch(_idempotent_batch_writer(out, report))
    return _start(writer, trigger, checkpoint)
