"""Fit/apply feature preparation with parameters stored as small tables.

* fills    ``(col_name, num_fill double, cat_fill string)``
* encoders ``(col_name, value string, code int)``
* scaler   ``(col_name, mean double, scale double)``

Fitting is an aggregation over the TRAINING rows only (no leakage).
Fills and scaler have one row per column and become literal column expressions,
a narrow, codegen'd projection.  Encoders have one row per (column, category) and
are applied by an equi-join per column at every size; Catalyst/AQE broadcasts
the side whose size allows it and splits skewed values otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions.scalar import nan_to_null
from churnspark.operators import stats

UNKNOWN = "Unknown"      # fixed value: categorical fill when the column is all-null
UNSEEN_CODE = -1         # fixed value: code for a category not seen in training


# ----------------------------------------------------------------- null fills
def fill_fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numeric: exact median; categorical: mode (smallest on ties), ``Unknown``
    when all-null."""
    spark = train.sparkSession
    parts = []
    if numeric:
        parts.append(stats.median(train, numeric).select(
            F.col("feature").alias("col_name"), F.col("median").alias("num_fill"),
            F.lit(None).cast("string").alias("cat_fill")))
    if categorical:
        parts.append(stats.mode(train, categorical).select(
            F.col("feature").alias("col_name"), F.lit(None).cast("double").alias("num_fill"),
            F.coalesce("mode_value", F.lit(UNKNOWN)).alias("cat_fill")))
    if not parts:
        return spark.createDataFrame([], "col_name string, num_fill double, cat_fill string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fill_apply(df: DataFrame, fills: DataFrame | dict) -> DataFrame:
    """Fill nulls with the fitted values; columns absent from ``df`` are skipped.
    Numeric fills give a double column, text fills a string column."""
    values = _fill_dict(fills)
    present = {c: v for c, v in values.items() if c in df.columns and v is not None}
    if not present:
        return df

    def filled(c):
        v = present[c]
        if isinstance(v, str):
            return F.coalesce(F.col(c).cast("string"), F.lit(v))
        # a numeric column with gaps is a float column (as in pandas)
        return F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float(v)))
    return df.select(*[filled(c).alias(c) if c in present else F.col(c) for c in df.columns])


def _fill_dict(fills: DataFrame | dict) -> dict:
    if isinstance(fills, dict):
        return fills
    out = {}
    for r in fills.collect():  # one row per column: bounded
        out[r["col_name"]] = r["num_fill"] if r["cat_fill"] is None else r["cat_fill"]
    return out


def impute_self(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                strict: bool = True) -> DataFrame:
    """Fit the fills on ``df`` itself and fill only columns that have nulls.

    With ``strict`` an all-null categorical column raises (its mode does not
    exist), as the original in-place variant does.
    """
    fills = fill_fit(df, numeric, categorical).collect()
    if strict:
        from churnspark.operators.quality import null_counts
        cols = list(numeric) + list(categorical)
        nn = {r["column_name"]: (r["n_null"], r["n_rows"]) for r in null_counts(df, cols).collect()}
        for c in categorical:
            z, n = nn[c]
            if n > 0 and z == n:
                raise ValueError(f"column '{c}' is entirely null; no mode to fill with")
    d = {r["col_name"]: (r["num_fill"] if r["cat_fill"] is None else r["cat_fill"]) for r in fills}
    return fill_apply(df, d)


# ----------------------------------------------------------- label encoding
def label_encode_fit(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: distinct non-null text values sorted lexicographically
    (code-point order) -> codes ``0..k-1``.

    Distinct values (map-side combined) are range-bucketed and ranked with
    the distributed prefix sums, so even a very wide column is never ranked
    inside a single task.
    """
    from churnspark.operators import prefix as px
    from churnspark.session import materialize
    vc = materialize(stats.value_counts(train, cols).select("feature", "value", F.lit(1).alias("__one")),
                     "distinct_values")
    nb = px.adaptive_buckets(train.sparkSession, vc.count())   # parquet footers: cheap
    b = px.range_bucketed(vc, ["feature", "value"], nb)
    ranked = px.prefix_sums(b, ["feature"], ["value"], "__bk", ["__one"], prefix="__cum", with_totals=False)
    return ranked.select(F.col("feature").alias("col_name"), "value",
                         F.col("__cum__one").cast("int").alias("code"))


def label_encode_apply(df: DataFrame, encoders: DataFrame, cols: Sequence[str] | None = None,
                       strategy: str = "join", max_literal: int | None = None) -> DataFrame:
    """Replace each categorical value by its code; unseen or NULL -> -1.

    One equi-join per column, whatever the dictionary's size.  ``strategy`` and
    ``max_literal`` are accepted for earlier callers and change nothing.
    """
    if cols is None:
        cols = [r[0] for r in encoders.select("col_name").distinct().collect()]
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    code = {c: f"__code{i}" for i, c in enumerate(cols)}
    out = df
    for i, c in enumerate(cols):
        lk = encoders.where(F.col("col_name") == c).select(F.col("value").alias(f"__value{i}"), F.col("code").alias(code[c]))
        out = out.join(lk, F.col(f"`{c}`").cast("string") == F.col(f"__value{i}"), "left")
    return out.select(*[F.coalesce(code[c], F.lit(UNSEEN_CODE)).cast("int").alias(c) if c in code else F.col(f"`{c}`")
                        for c in df.columns])


# ------------------------------------------------------------ standard scale
def scale_fit(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(col_name, mean, scale)``: mean and POPULATION std; std 0 -> 1."""
    ms = stats.mean_std(train, cols)
    return ms.select(F.col("feature").alias("col_name"), "mean",
                     F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("scale"))


def scale_apply(df: DataFrame, scaler: DataFrame | dict) -> DataFrame:
    """``(x - mean) / scale`` for the fitted columns present in ``df``."""
    if isinstance(scaler, dict):
        params = scaler
    else:
        params = {r["col_name"]: (r["mean"], r["scale"]) for r in scaler.collect()}  # one row per column
    return df.select(*[
        ((F.col(c).cast("double") - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c)
        if c in params and params[c][0] is not None else F.col(c)
        for c in df.columns])


# --------------------------------------------------------------- state bundle
@dataclass
class FittedState:
    fills: DataFrame
    encoders: DataFrame
    scaler: DataFrame

    def save(self, path: str) -> None:
        self.fills.write.mode("overwrite").parquet(f"{path}/fills")
        self.encoders.write.mode("overwrite").parquet(f"{path}/encoders")
        self.scaler.write.mode("overwrite").parquet(f"{path}/scaler")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedState:
        return cls(spark.read.parquet(f"{path}/fills"), spark.read.parquet(f"{path}/encoders"),
                   spark.read.parquet(f"{path}/scaler"))

    def cache(self) -> FittedState:
        return FittedState(self.fills.cache(), self.encoders.cache(), self.scaler.cache())


def fit_all(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> FittedState:
    """Fit fills on train, then encoders and scaler on the FILLED train.

    The training rows are persisted for the duration of the fit (several
    aggregation passes read them) and released afterwards; the returned
    parameter tables are materialised, so nothing downstream re-reads the
    training lineage.  Fills and scaler have one row per column; the encoder
    table (one row per category) is derived from a table written to the
    shared checkpoint folder, never collected here.
    """
    from pyspark import StorageLevel
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fills_rows = fill_fit(train, numeric, categorical).collect()   # one row per column
        fd = {r["col_name"]: (r["num_fill"] if r["cat_fill"] is None else r["cat_fill"]) for r in fills_rows}
        filled = fill_apply(train, fd)
        # reads a written range-bucket table: short, deterministic lineage
        encoders = label_encode_fit(filled, categorical)
        scaler_rows = scale_fit(filled, numeric).collect()              # one row per column
    finally:
        train.unpersist()
    return FittedState(
        fills=spark.createDataFrame(
            [(r["col_name"], r["num_fill"], r["cat_fill"]) for r in fills_rows],
            "col_name string, num_fill double, cat_fill string"),
        encoders=encoders,
        scaler=spark.createDataFrame([(r["col_name"], r["mean"], r["scale"]) for r in scaler_rows],
                                     "col_name string, mean double, scale double"),
    )


def apply_all(df: DataFrame, state: FittedState, categorical: Sequence[str], numeric: Sequence[str],
              strategy: str = "join") -> DataFrame:
    """fills -> codes -> scaling, one narrow projection chain."""
    out = fill_apply(df, state.fills)
    out = label_encode_apply(out, state.encoders, categorical, strategy=strategy)
    return scale_apply(out, state.scaler)
