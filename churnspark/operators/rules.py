"""A whole data contract compiled to one scan.

Every rule is a condition on a row.  Rules with an ``allowed`` share judge the
table (more violations than that fail it); rules without one reject the row.
:func:`route` scans the input once: it writes accepted and rejected rows in one
job, under ``accepted=true`` and ``accepted=false``, each with the names of the
rules it breaks.  The counts are one aggregate over that column of the written
table, however many rules there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.scalar import nan_to_null
from churnspark.operators.quality import NULL_THRESHOLD, DataQualityError
from churnspark.profile import Profile

@dataclass(frozen=True)
class Rule:
    """``kind``: missing, below, above (of ``value``) or unknown (not among the
    texts ``value``)."""

    column: str
    kind: str
    value: object = None
    allowed: float | None = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"


def contract_rules(profile: Profile, classes: Sequence[str] = ()) -> list[Rule]:
    """The rules of a profile: null shares of its contract, ranges of its
    request rules, and the texts of its target."""
    rules = [Rule(c, "missing", allowed=NULL_THRESHOLD) for c, nullable in profile.contract if not nullable]
    for r in profile.rules:
        rules += [Rule(r.column, "below", r.lo)] if r.lo is not None else []
        rules += [Rule(r.column, "above", r.hi)] if r.hi is not None else []
    return rules + ([Rule(profile.target, "unknown", tuple(classes))] if classes else [])


def violated(rule: Rule, df: DataFrame) -> Column:
    """Whether a row breaks the rule (a missing value breaks ``missing`` and
    ``unknown`` alone; NaN is missing)."""
    c = F.col(f"`{rule.column}`")
    if isinstance(df.schema[rule.column].dataType, (T.DoubleType, T.FloatType)):
        c = nan_to_null(c)
    if rule.kind == "missing":
        return c.isNull()
    if rule.kind == "unknown":
        return ~F.coalesce(c.cast("string").isin([str(v) for v in rule.value]), F.lit(False))
    return F.coalesce(c < F.lit(rule.value) if rule.kind == "below" else c > F.lit(rule.value), F.lit(False))


def _broken(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row breaks."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(F.array(*[F.when(violated(r, df), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def summary(routed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, column_name, n_rows, n_violations, share, failed) of a routed table."""
    counts = routed.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.array_contains("broken", r.name)).alias(f"v{i}") for i, r in enumerate(rules)])
    rows = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column_name"), F.col("n").alias("n_rows"),
                                        F.col(f"v{i}").alias("n_violations"), F.lit(r.allowed).cast("double").alias("allowed"))
                               for i, r in enumerate(rules)])).alias("e")
    share = F.when(F.col("n_rows") > 0, F.col("n_violations") / F.col("n_rows"))
    return (counts.select(rows).select("e.*").withColumn("share", share)
            .select("rule", "column_name", "n_rows", "n_violations", "share", F.coalesce(F.col("share") > F.col("allowed"), F.lit(False)).alias("failed")))


def route(df: DataFrame, rules: Sequence[Rule], path: str) -> DataFrame:
    """Write all rows under ``path``, accepted and rejected apart, with ``broken``
    (all rules they break) and ``violations`` (those that reject), and return the
    summary.  Rules whose column is absent raise."""
    missing = sorted({r.column for r in rules} - set(df.columns))
    if missing:
        raise DataQualityError(f"Missing columns: {missing}")
    out = (df.withColumn("broken", _broken(df, rules)).withColumn("violations", _broken(df, [r for r in rules if r.allowed is None]))
           .withColumn("accepted", F.size("violations") == 0))
    out.write.mode("overwrite").partitionBy("accepted").parquet(path)
    return summary(df.sparkSession.read.schema(out.schema).parquet(path), rules)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("accepted").cast("boolean")).drop("accepted", "violations", "broken")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(~F.col("accepted").cast("boolean")).drop("accepted", "broken")
