"""Champion/challenger promotion and the model registry as data.

``model_versions(name string, version int, stage string, roc_auc double)``
is a table; a state change is a new snapshot of it, computed with ``when``
(no in-place update, no service call).

The registry itself is a table of events that only grows: every version's
registration and every change of a stage is a row with a number ``seq``.  The
current state is folded from them by ``max_by``, so a crash between two writes
leaves all earlier versions as they were.  One writer at a time appends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.session import read_or_empty

PROMOTE_THRESHOLD = 0.01  # fixed value: promote iff AUC gain > 0.01 (strict)
METRICS = ("roc_auc", "f1", "precision", "recall")


def join_champion(candidate: DataFrame, production: DataFrame, key: str = "name") -> DataFrame:
    """Candidate metrics next to production metrics (0.0 when there is no
    production model; ``has_production`` tells the two apart).

    Both inputs hold one row per model name.
    """
    prod = production.select(key, *[F.col(m).alias(f"prod_{m}") for m in METRICS if m in production.columns],
                             F.lit(True).alias("has_production"))
    j = candidate.join(prod, key, "left")
    out = [key] + [F.col(m).alias(f"cand_{m}") for m in METRICS if m in candidate.columns]
    out += [F.coalesce(F.col(f"prod_{m}"), F.lit(0.0)).alias(f"prod_{m}")
            for m in METRICS if m in production.columns]
    out.append(F.coalesce("has_production", F.lit(False)).alias("has_production"))
    return j.select(*out)


def promote_decision(joined: DataFrame, threshold: float = PROMOTE_THRESHOLD) -> DataFrame:
    """``promote`` iff there is no production model, or the AUC gain is
    strictly above ``threshold``."""
    delta = F.col("cand_roc_auc") - F.col("prod_roc_auc")
    return joined.withColumn("auc_delta", delta).withColumn(
        "promote", (~F.col("has_production")) | F.coalesce(delta > F.lit(threshold), F.lit(False)))


def production_metrics(versions: DataFrame) -> DataFrame:
    """Metrics of the newest production version per model name."""
    prod = versions.where(F.col("stage") == "production")
    best = prod.groupBy("name").agg(F.max_by(F.struct(*[c for c in versions.columns if c != "name"]),
                                             F.col("version")).alias("__r"))
    return best.select("name", "__r.*")


def promote_transition(versions: DataFrame, decisions: DataFrame, candidate_version: DataFrame | None = None
                       ) -> DataFrame:
    """New registry snapshot.

    For every model name whose decision says ``promote``: all production
    rows become ``archived`` and the candidate version becomes
    ``production``.  The candidate version is taken from ``decisions``
    (column ``version``); names not promoted are unchanged.
    """
    d = decisions.select("name", F.col("version").alias("__cand"), F.col("promote").alias("__p"))
    j = versions.join(d, "name", "left")
    promoted = F.coalesce(F.col("__p"), F.lit(False))
    stage = (F.when(promoted & (F.col("version") == F.col("__cand")), F.lit("production"))
             .when(promoted & (F.col("stage") == "production"), F.lit("archived"))
             .otherwise(F.col("stage")))
    return j.withColumn("stage", stage).select(*versions.columns)


EVENTS = "name string, version int, stage string, roc_auc double, f1 double, precision double, recall double, seq long"


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events; none if nothing has been registered yet."""
    return read_or_empty(lambda: spark.read.schema(EVENTS).parquet(path), lambda: spark.createDataFrame([], EVENTS))


def fold_events(events: DataFrame) -> DataFrame:
    """The current ``model_versions``: the last event of every version."""
    payload = [c for c in events.columns if c not in ("name", "version", "seq")]
    last = events.groupBy("name", "version").agg(F.max_by(F.struct(*payload), "seq").alias("e"))
    return last.select("name", "version", "e.*")


def append_events(changes: DataFrame, path: str) -> None:
    """Add rows of ``model_versions`` as the newest events, in one commit."""
    spark = changes.sparkSession
    last = read_events(spark, path).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq")).first()[0]
    columns = [c.split()[0] for c in EVENTS.split(", ")[:-1]]
    changes.select(*columns, F.lit(last + 1).cast("long").alias("seq")).write.mode("append").parquet(path)


def changed_stages(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``after`` whose stage isn't the one in ``before``."""
    old = before.select(F.col("name").alias("o_name"), F.col("version").alias("o_version"), F.col("stage").alias("o_stage"))
    same = (after["name"] == old["o_name"]) & (after["version"] == old["o_version"]) & (after["stage"] == old["o_stage"])
    return after.join(old, same, "left_anti")


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """``(name, version)``: the highest integer version (optionally of one stage)."""
    v = versions if stage is None else versions.where(F.col("stage") == stage)
    return v.groupBy("name").agg(F.max(F.col("version").cast("int")).alias("version"))


def best_run(runs: DataFrame, metric: str = "auc_weighted", by: str = "experiment") -> DataFrame:
    """Best run per experiment: highest ``metric`` (ties: smallest run_id)."""
    return (runs.where(F.col(metric).isNotNull()).groupBy(by)
            .agg(F.min_by(F.struct("run_id", metric), F.struct(-F.col(metric), F.col("run_id"))).alias("__r"))
            .select(by, "__r.run_id", F.col(f"__r.{metric}").alias(metric)))


def best_run_or_raise(runs: DataFrame, metric: str = "auc_weighted") -> str:
    r = runs.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), "run_id").select("run_id").first()
    if r is None:
        raise LookupError("no child runs found")
    return r[0]
