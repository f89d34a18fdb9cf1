"""Exact per-column statistics that scale: median, mode, value proportions.

Spark's built-in ``percentile``/``mode`` keep one hash map per group and,
for a global aggregate, merge every task's map into ONE task.  Here both are
formulated on the ``(feature, value, count)`` table instead: the shuffle is
keyed by value (spread over all tasks, pre-aggregated map-side); medians come
from brackets that all columns narrow together (:mod:`.quantiles`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.functions.scalar import nan_to_null
from churnspark.operators import quantiles as qt


def unpivot(df: DataFrame, cols: Sequence[str], value_type: str = "string",
            keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long ``(*keep, feature, value)``; one row per (row, column)."""
    if not cols:
        return df.select(*keep, F.lit(None).cast("string").alias("feature"),
                         F.lit(None).cast(value_type).alias("value")).where(F.lit(False))
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value")) for c in cols
    ])).alias("__kv")).select(*keep, "__kv.feature", "__kv.value")


def value_counts(df: DataFrame, cols: Sequence[str], value_type: str = "string") -> DataFrame:
    """``(feature, value, n)`` for non-null values; map-side combined."""
    return (unpivot(df, cols, value_type).where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))


def mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, mode_value)``: most frequent non-null value, the smallest
    value on ties; NULL when the column is all-null (feature still listed)."""
    vc = value_counts(df, cols)
    best = (vc.groupBy("feature")
            .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode_value")))
    feats = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return feats.join(F.broadcast(best), "feature", "left")


def median(df: DataFrame, cols: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """``(feature, median)``: exact, linear interpolation between the two
    middle values, nulls (and NaN) ignored; NULL for an all-null column.

    All columns are narrowed at once (:mod:`.quantiles`); ``n_buckets`` asks
    for so many brackets of the rows at least.
    """
    cols = list(cols)
    last = max(1, df.count() // n_buckets) if n_buckets else None
    found = qt.order_statistics(df, cols, qt.middle_ranks, last)
    middle = found.groupBy("feature").agg(((F.min("value") + F.max("value")) / 2).alias("median"))
    return df.sparkSession.createDataFrame([(c,) for c in cols], "feature string").join(middle, "feature", "left")


def value_proportions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, n, p)``: normalised value counts, nulls excluded."""
    vc = value_counts(df, cols)
    tot = vc.groupBy("feature").agg(F.sum("n").alias("__t"))  # one row per feature
    return (vc.join(F.broadcast(tot), "feature")
            .select("feature", "value", "n", (F.col("n") / F.col("__t")).alias("p")))


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` distinct non-null values with their counts, in
    the order of feature and value."""
    return value_counts(df, cols).orderBy("feature", "value")


def mean_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, mean, std, n)``: one pass; ``std`` is the population std.
    NaN counts as missing, as in the other statistics."""
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, mean double, std double, n long")
    aggs = []
    for i, c in enumerate(cols):
        x = nan_to_null(F.col(c).cast("double"))
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"), F.count(x).alias(f"n{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', m{i}, s{i}, n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {parts}) as (feature, mean, std, n)")
