"""Scoring of request bodies, from text to response or error row.

body -> parse -> types -> range rules -> fills -> codes -> scale -> score.  Every
request leaves at least one row: ``outcome`` is ``scored`` (one row per data row
and model) or ``rejected`` (with the reason).  The whole way is one plan: each
body is parsed once, and a batch and a stream use the same function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.scalar import coerce_numeric, risk_band, threshold_predict
from churnspark.operators import features as FE, model_tables as MT, quality as Q
from churnspark.operators.models import PROB_DIGITS
from churnspark.profile import Profile
from churnspark.session import read_or_empty
from churnspark.sources import payload as PL

OUTCOME = ("outcome", "row_idx", "model", "probability", "prediction", "risk_level", "error")


def score_requests(requests: DataFrame, profile: Profile, state: FE.FittedState, models: dict, key: str = "request_id",
                   body: str = "body", threshold: float = 0.5) -> DataFrame:
    """(key, outcome, row_idx, model, probability, prediction, risk_level, error).

    ``models`` maps names to fitted models or model tables.  A request without
    data rows is rejected; a value that isn't a number is missing, and is
    rejected if a rule asks for it, else filled."""
    spark = requests.sparkSession
    parsed = PL._resolved(requests.select(key, body), body, profile.features)
    rows = parsed.select(key, "error", "__cols", F.posexplode_outer(F.when(F.col("error").isNull(), F.col("__data"))).alias("row_idx", "__row"))

    def value(c: str):
        at = F.array_position("__cols", F.lit(c)).cast("int")
        return F.when(at > 0, F.try_element_at("__row", at))
    typed = rows.select(key, F.col("row_idx").cast("int").alias("row_idx"), F.coalesce("error", F.when(F.col("__row").isNull(), F.lit("no data rows"))).alias("error"),
                        *[(coerce_numeric(value(c)) if c in profile.numeric else value(c)).alias(c) for c in profile.features])
    checked = Q.range_check(typed, profile.rules).withColumn(
        "error", F.coalesce("error", F.when(~F.col("accepted"), F.col("violations")))).drop("violations", "accepted")
    prepared = FE.apply_all(checked, state, list(profile.categorical), list(profile.numeric))
    scored = prepared
    for i, model in enumerate(models.values()):
        scored = MT.predict(MT.to_tables(spark, model), scored, f"__p{i}")
    good = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("p")) for i, name in enumerate(models)])
    none = F.array(F.struct(F.lit(None).cast("string").alias("model"), F.lit(None).cast("double").alias("p")))
    each = scored.select(key, "row_idx", "error", F.explode(F.when(F.col("error").isNull(), good).otherwise(none)).alias("m"))
    return each.select(key, F.when(F.col("error").isNull(), F.lit("scored")).otherwise(F.lit("rejected")).alias("outcome"), "row_idx", "m.model",
                       F.round("m.p", PROB_DIGITS).alias("probability"), threshold_predict("m.p", threshold).alias("prediction"),
                       risk_band("m.p").alias("risk_level"), "error")


def write_outcomes(rows: DataFrame, root: str, batch_id: int) -> None:
    """Scored and rejected rows of a batch in ONE commit, under its number; a
    batch that is replayed replaces itself."""
    rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{root}/batch_id={batch_id}")


def read_outcomes(spark: SparkSession, root: str, schema) -> DataFrame:
    """All outcomes; none before the first batch."""
    return read_or_empty(lambda: spark.read.schema(schema).option("basePath", root).parquet(f"{root}/batch_id=*"),
                         lambda: spark.createDataFrame([], schema))
