"""Views over the driver tables that give every operator real input.

Each view is a lazy DataFrame over the parquet tables in ``sf_dir``; only
the columns a view needs are read (column pruning reaches the scan).
The same views exist as SQL text in :mod:`churnspark.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.scalar import risk_band
from churnspark.operators.split import stratified_split
from churnspark.session import ensure_job_settings, materialize

DRIFT_CUT = "1999-01-01"   # lineitem before = baseline, from = live
CHURN_HORIZON_DAYS = 365   # label window after the feature cutoff

LOG_MODELS = ("click", "error", "purchase", "signup", "view")


def stream_path(sf_dir: str, name: str) -> str:
    """File-stream path of one driver table.  A file source watches a
    directory or a glob; the driver tables are single files, so the glob
    matches exactly that file."""
    return f"{sf_dir.rstrip('/')}/{name}.parque[t]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_job_settings(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def churn_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features up to a cutoff, label = no order after it.

    cutoff = max(o_orderdate) - 365 days, as a scalar subquery (no join).
    ONE conditional aggregate over ``orders`` keyed by customer (map-side
    combined): features of the orders up to the cutoff and a flag for any
    order after it, so ``orders`` is scanned and shuffled once for both.
    Customers without an order up to the cutoff are dropped (as an inner
    join to the feature aggregate would).  One join to ``customer`` on the
    key, one to the 25-row ``nation``.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cutoff = (orders.agg(F.max("o_orderdate")).scalar()
              - F.expr(f"INTERVAL {CHURN_HORIZON_DAYS} DAYS"))
    d = F.col("o_orderdate")
    before = d <= cutoff
    feats = (orders.where(d.isNotNull() & F.col("o_custkey").isNotNull())
             .groupBy("o_custkey")
             .agg(F.min(F.when(before, d)).alias("first_d"),
                  F.sum(F.when(before, F.col("o_totalprice"))).alias("total"),
                  F.count_if(before).alias("n_orders"),
                  F.max(d > cutoff).alias("has_later"))
             .where(F.col("n_orders") > 0))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (cust.join(feats, cust.c_custkey == feats.o_custkey)
         .join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey))
    return j.select(
        "c_custkey", "c_mktsegment", "n_name", "c_acctbal", "n_orders",
        F.floor(F.datediff(cutoff, F.col("first_d")) / 30).cast("int").alias("tenure"),
        "total",
        F.when(F.col("has_later"), 0).otherwise(1).alias("churn"),
    )


def churn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split, written once as a table (as a prepare job would): every
    consumer (fits, applies, metrics) reads it instead of re-ranking."""
    return materialize(stratified_split(churn_base(spark, sf_dir), "c_custkey", "churn"), "churn_split")


def churn_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """churn_base with nulls injected deterministically into four features."""
    b = churn_base(spark, sf_dir)
    k = F.col("c_custkey")
    return b.select(
        "c_custkey",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("n_name"),
        "c_acctbal", "n_orders",
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("tenure")).alias("tenure"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("total")).alias("total"),
        "churn",
    )


def churn_nulls_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(stratified_split(churn_with_nulls(spark, sf_dir), "c_custkey", "churn"),
                       "churn_nulls_split")


def scored_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """churn_base plus deterministic model scores in [0, 1]."""
    b = churn_base(spark, sf_dir)
    return b.select(
        "*",
        ((F.col("c_custkey") * 37 % 101) / 100.0).cast("double").alias("score"),
        (1.0 - F.least(F.col("tenure"), F.lit(72)) / 72.0).cast("double").alias("score_tenure"),
        (1.0 / (1.0 + F.col("n_orders"))).cast("double").alias("score_orders"),
    )


def customers_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with nulls injected (violating and passing rates)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey", "c_name",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )


CUSTOMER_CONTRACT = (("c_custkey", False), ("c_name", False), ("c_nationkey", False),
                     ("c_acctbal", False), ("c_mktsegment", True))


def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-text customer record, as a CSV export would carry it: numbers as
    text, a lone blank for every tenth balance, NA tokens in the segment."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.when(k % 10 == 0, F.lit(" ")).when(k % 10 == 5, F.lit("1d"))
         .otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("acctbal_text"),
        F.when(k % 7 == 0, F.lit("NA")).when(k % 7 == 1, F.lit("null")).when(k % 7 == 2, F.lit("nan"))
         .otherwise(F.col("c_mktsegment")).alias("segment"),
    )


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an inference log: id, timestamp (UTC instant), model,
    nested inputs, probability (value squashed into [0,1)), prediction,
    risk level."""
    e = table(spark, sf_dir, "events")
    prob = (F.col("value") / (F.col("value") + F.lit(50.0))).alias("probability")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("model"),
        F.struct(F.col("user_id").alias("user_id"), F.col("value").alias("value"),
                 F.get_json_object("props", "$.k").cast("int").alias("k")).alias("inputs"),
        prob,
    ).withColumn("prediction", (F.col("probability") >= 0.5).cast("int")) \
     .withColumn("risk_level", risk_band("probability"))


def lineitem_drift(spark: SparkSession, sf_dir: str, cols=None) -> tuple[DataFrame, DataFrame]:
    """(baseline, live) halves of lineitem split at ``DRIFT_CUT``."""
    li = table(spark, sf_dir, "lineitem")
    if cols:
        li = li.select(*cols, "l_shipdate")
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


DRIFT_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DRIFT_CATEGORICAL = ("l_returnflag", "l_linestatus")
