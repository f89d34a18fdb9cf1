"""Data-quality operators: required columns, null rates, range rules,
production data-quality signals.

All per-column statistics are computed in ONE aggregation pass over the
input (partial aggregation on every task, one tiny final merge) and then
turned into a long ``(column, ...)`` table with ``stack``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.scalar import nan_to_null
from churnspark.profile import RangeRule

NULL_THRESHOLD = 0.05  # fixed value: violation iff not-nullable and rate > 5 %


class DataQualityError(ValueError):
    pass


def _stack(df: DataFrame, cols: Sequence[str], value_exprs: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row wide frame into one row per column."""
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"'{c}'")
        parts += [v.format(i=i) for v in value_exprs]
    expr = f"stack({len(cols)}, {', '.join(parts)}) as (column_name, {', '.join(names)})"
    return df.selectExpr(expr)


def required_columns(spark: SparkSession, df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Table ``(column_name, ordinal, present)`` for every expected column.

    Metadata only: no data is read.  Extra columns are allowed.
    """
    have = set(df.columns)
    rows = [(c, i + 1, c in have) for i, c in enumerate(expected)]
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("ordinal", T.IntegerType()),
                           T.StructField("present", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n_rows, n_null, null_rate)``; NaN in doubles counts as null."""
    cols = list(cols or df.columns)
    if not cols:
        raise ValueError("no columns")
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        col = F.col(c)
        is_null = col.isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            is_null = is_null | F.isnan(col)
        aggs.append(F.count_if(is_null).alias(f"__z{i}"))
    wide = df.agg(*aggs)
    long = _stack(wide, cols, ["__n", "__z{i}"], ["n_rows", "n_null"])
    return long.withColumn(
        "null_rate",
        F.when(F.col("n_rows") > 0, F.col("n_null").cast("double") / F.col("n_rows").cast("double")))


def null_rates(df: DataFrame, contract: Sequence[tuple[str, bool]],
               threshold: float = NULL_THRESHOLD) -> DataFrame:
    """Null rate per contracted column and the violation flag.

    Violation iff the column is NOT nullable and ``rate > threshold``
    (strict).  An empty table has rate NULL and never violates.
    """
    present = [(c, n) for c, n in contract if c in df.columns]
    if not present:
        raise DataQualityError("none of the contracted columns is present")
    counts = null_counts(df, [c for c, _ in present])
    nullable = F.create_map(*[x for c, n in present for x in (F.lit(c), F.lit(bool(n)))])
    return (counts
            .withColumn("nullable", F.element_at(nullable, F.col("column_name")))
            .withColumn("violation",
                        F.coalesce((~F.col("nullable")) & (F.col("null_rate") > F.lit(threshold)),
                                   F.lit(False)))
            .select("column_name", "n_rows", "n_null", "null_rate", "nullable", "violation"))


def validate(df: DataFrame, contract: Sequence[tuple[str, bool]],
             threshold: float = NULL_THRESHOLD) -> None:
    """Raise :class:`DataQualityError` like the original ingest check.

    One aggregation job; only the per-column summary reaches the driver.
    """
    missing = missing_columns(df, [c for c, _ in contract])
    if missing:
        raise DataQualityError(f"Missing columns: {missing}")
    bad = (null_rates(df, contract, threshold).where("violation")
           .select("column_name", "null_rate").collect())
    if bad:
        c, r = bad[0]
        raise DataQualityError(
            f"Column '{c}' null rate {r:.2%} exceeds threshold {threshold:.0%}")


def range_check(df: DataFrame, rules: Sequence[RangeRule], keep: Sequence[str] = ()) -> DataFrame:
    """Add ``violations`` (comma-joined names of failed rules, '' if none) and
    ``accepted``.  Rule names: ``<col>:missing``, ``<col>:below``, ``<col>:above``.
    """
    checks = []
    for r in rules:
        if r.column not in df.columns:
            if r.required:
                checks.append(F.lit(f"{r.column}:missing"))
            continue
        c = F.col(r.column)
        if r.required:
            checks.append(F.when(c.isNull(), F.lit(f"{r.column}:missing")))
        if r.lo is not None:
            checks.append(F.when(c < F.lit(r.lo), F.lit(f"{r.column}:below")))
        if r.hi is not None:
            checks.append(F.when(c > F.lit(r.hi), F.lit(f"{r.column}:above")))
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    out = df.withColumn("__v", arr)
    return (out.withColumn("violations", F.array_join("__v", ","))
            .withColumn("accepted", F.size("__v") == 0)
            .drop("__v"))


def split_accepted(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.where("accepted"), checked.where("not accepted")


def production_quality(train: DataFrame, live: DataFrame, numeric: Sequence[str],
                       categorical: Sequence[str]) -> DataFrame:
    """Production data-quality signal against a training reference.

    Per feature: live null rate, share of numeric values outside the
    training ``[min, max]``, share of categorical values never seen in
    training, and whether the live type differs from training.  One
    aggregation over ``train``, one over ``live``; the known-category set is
    joined (not collected), so it may be large.
    """
    numeric = list(numeric)
    categorical = list(categorical)
    # training bounds: one pass, one row
    value = {c: nan_to_null(F.col(c).cast("double")) for c in numeric}  # NaN is missing, not the greatest value
    bounds = train.agg(*[F.min(value[c]).alias(f"lo{i}") for i, c in enumerate(numeric)],
                       *[F.max(value[c]).alias(f"hi{i}") for i, c in enumerate(numeric)]).first() if numeric else None
    rows = []
    n = F.count(F.lit(1))
    aggs = [n.alias("__n")]
    for i, c in enumerate(numeric):
        col = value[c]
        lo, hi = bounds[f"lo{i}"], bounds[f"hi{i}"]
        aggs.append(F.count_if(col.isNull()).alias(f"nz_n{i}"))
        oor = F.lit(False) if lo is None else ((col < F.lit(lo)) | (col > F.lit(hi)))
        aggs.append(F.count_if(oor).alias(f"oo_n{i}"))
    for i, c in enumerate(categorical):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nz_c{i}"))
    wide = live.agg(*aggs)
    parts = []
    for i, c in enumerate(numeric):
        parts.append(f"'{c}', 'numeric', __n, nz_n{i}, oo_n{i}")
    for i, c in enumerate(categorical):
        parts.append(f"'{c}', 'categorical', __n, nz_c{i}, cast(null as bigint)")
    long = wide.selectExpr(
        f"stack({len(parts)}, {', '.join(parts)}) as (feature, kind, n_rows, n_null, n_out_of_range)")
    if categorical:
        # unseen categories: live (feature, value) anti-joined with train's
        # counts per live category first (map-side combined: a hot category
        # becomes one row per task), then the anti-join on the small tables
        lv = (_unpivot_str(live, categorical).where(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("__c")))
        tv = _unpivot_str(train, categorical).where(F.col("value").isNotNull()).distinct()
        unseen = (lv.join(tv, ["feature", "value"], "left_anti")
                  .groupBy("feature").agg(F.sum("__c").alias("__u")))
        long = (long.join(F.broadcast(unseen), "feature", "left")
                .withColumn("n_out_of_range",
                            F.when(F.col("kind") == "categorical", F.coalesce("__u", F.lit(0)))
                            .otherwise(F.col("n_out_of_range")))
                .drop("__u"))
    ttypes = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    ltypes = {f.name: f.dataType.simpleString() for f in live.schema.fields}
    type_ok = F.create_map(*[x for c in numeric + categorical
                             for x in (F.lit(c), F.lit(ttypes.get(c) == ltypes.get(c)))])
    rows = long.select(
        "feature", "kind", "n_rows", "n_null",
        F.col("n_out_of_range").cast("long").alias("n_out_of_range"),
        F.when(F.col("n_rows") > 0, F.col("n_null") / F.col("n_rows")).alias("null_rate"),
        F.when(F.col("n_rows") > 0, F.col("n_out_of_range") / F.col("n_rows")).alias("out_of_range_rate"),
        (~F.element_at(type_ok, F.col("feature"))).alias("type_violation"),
    )
    return rows


def _unpivot_str(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("__kv")).select("__kv.feature", "__kv.value")
