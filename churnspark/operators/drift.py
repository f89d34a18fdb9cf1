"""Drift monitoring: baseline profile, mean shift, PSI, Jensen-Shannon.

All statistics are computed as aggregations over a long
``(feature, value)`` unpivot; a profile has one row per feature (numeric)
or per (feature, category), so the joins against it are broadcast with a
bound given by the profile, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.scalar import DRIFT_THRESHOLD, drift_status, nan_to_null
from churnspark.operators import stats
from churnspark.session import materialize

# --- Fixed values ------------------------------------------------------------
STD_EPSILON = 1e-9     # added to the baseline std in the mean shift
SHIFT_CAP = 2.0        # mean shift is capped at 2.0
PSI_FLOOR = 1e-4       # missing live share and floor of the baseline share
SCORE_DIGITS = 4       # drift scores are rounded to 4 places
MEAN_DIGITS = 3        # displayed means are rounded to 3 places
JS_BINS = 10           # equal-width baseline bins for numeric JS divergence
# -----------------------------------------------------------------------------


def baseline_profile(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
                     ) -> tuple[DataFrame, DataFrame]:
    """``num_profile(feature, mean, std)`` (population std) and
    ``cat_profile(feature, value, p)``; one pass each, written once, so that
    reports read the profiles and never run the baseline again."""
    num = stats.mean_std(train, numeric).select("feature", "mean", "std")
    cat = stats.value_proportions(train, categorical).select("feature", "value", "p")
    return materialize(num, "num_profile"), materialize(cat, "cat_profile")


def _cap(shift: Column) -> Column:
    # NULL stays NULL (Spark's least() would return the cap for NULL/NaN)
    return F.when(shift.isNull() | F.isnan(shift), F.lit(None).cast("double")) \
        .when(shift > F.lit(SHIFT_CAP), F.lit(SHIFT_CAP)).otherwise(shift)


def mean_shift(live: DataFrame, num_profile: DataFrame) -> DataFrame:
    """``abs(live_mean - mean) / (std + 1e-9)`` capped at 2.0, rounded to 4;
    features missing from ``live`` are skipped; an all-null live column
    gives a NULL score (not the cap)."""
    feats = [r[0] for r in num_profile.select("feature").collect()]  # one row per feature of a written profile
    feats = [f for f in feats if f in live.columns]
    if not feats:
        return live.sparkSession.createDataFrame(
            [], "feature string, type string, drift_score double, baseline_mean double, live_mean double")
    return _shift_of(stats.mean_std(live, feats).select("feature", F.col("mean").alias("live_mean")), num_profile)


def _shift_of(live_means: DataFrame, num_profile: DataFrame) -> DataFrame:
    """The shift of ``(feature, live_mean)`` from the profile."""
    j = live_means.join(num_profile, "feature")
    shift = F.abs(F.col("live_mean") - F.col("mean")) / (F.col("std") + F.lit(STD_EPSILON))
    return j.select("feature", F.lit("numeric").alias("type"),
                    F.round(_cap(shift), SCORE_DIGITS).alias("drift_score"),
                    F.round("mean", MEAN_DIGITS).alias("baseline_mean"),
                    F.round("live_mean", MEAN_DIGITS).alias("live_mean"))


def psi_terms(live: DataFrame, cat_profile: DataFrame) -> DataFrame:
    """Baseline categories left-joined with live shares:
    ``(feature, value, base_p, live_p)`` with the 1e-4 default/floor applied.
    Categories seen only in live are ignored."""
    feats = [r[0] for r in cat_profile.select("feature").distinct().collect()]  # bounded by #features
    feats = [f for f in feats if f in live.columns]
    return _terms_of(stats.value_counts(live, feats), cat_profile.where(F.col("feature").isin(feats)))


def _terms_of(live_counts: DataFrame, base: DataFrame) -> DataFrame:
    """The terms of the live counts ``(feature, value, n)``."""
    total = live_counts.groupBy("feature").agg(F.sum("n").alias("t"))
    lp = live_counts.join(total, "feature").select("feature", "value", (F.col("n") / F.col("t")).alias("live_p"))
    j = base.join(lp, ["feature", "value"], "left")
    return j.select("feature", "value",
                    F.greatest(F.col("p"), F.lit(PSI_FLOOR)).alias("base_p"),
                    F.coalesce(F.col("live_p"), F.lit(PSI_FLOOR)).alias("live_p"))


def psi(live: DataFrame, cat_profile: DataFrame) -> DataFrame:
    """Population stability index per categorical feature, ``abs`` and
    rounded to 4."""
    return _psi_of(psi_terms(live, cat_profile))


def _psi_of(t: DataFrame) -> DataFrame:
    term = (F.col("live_p") - F.col("base_p")) * F.ln(F.col("live_p") / F.col("base_p"))
    return t.groupBy("feature").agg(F.abs(F.sum(term)).alias("__psi")).select(
        "feature", F.lit("categorical").alias("type"), F.round("__psi", SCORE_DIGITS).alias("drift_score"),
        F.lit(None).cast("double").alias("baseline_mean"), F.lit(None).cast("double").alias("live_mean"))


def drift_report(live: DataFrame, num_profile: DataFrame, cat_profile: DataFrame,
                 threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Numeric and categorical drift in one table with ``status``
    (``Drifted`` iff score > threshold), ranked by score (NULL last)."""
    rep = mean_shift(live, num_profile).unionByName(psi(live, cat_profile))
    return rank_drift(rep.withColumn("status", drift_status("drift_score", threshold)))


def drift_report_of(live_means: DataFrame, live_counts: DataFrame, num_profile: DataFrame, cat_profile: DataFrame,
                    threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """:func:`drift_report` from live aggregates: ``(feature, live_mean)`` and
    ``(feature, value, n)``; features without either are skipped."""
    base = cat_profile.join(live_counts.select("feature").distinct(), "feature", "left_semi")
    rep = _shift_of(live_means, num_profile).unionByName(_psi_of(_terms_of(live_counts, base)))
    return rank_drift(rep.withColumn("status", drift_status("drift_score", threshold)))


def rank_drift(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("drift_score").desc_nulls_last(), F.col("feature"))


def drift_summary(report: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """One row: feature count, drifted count, sorted drifted list, message."""
    drifted = F.col("drift_score") > F.lit(threshold)
    s = report.agg(F.count(F.lit(1)).alias("n_features"), F.count_if(drifted).alias("n_drifted"),
                   F.array_sort(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted"))
    msg = F.when(F.col("n_drifted") == 0,
                 F.format_string("No drift detected - all %d features within threshold (%s)",
                                 F.col("n_features"), F.lit(str(threshold))))\
        .otherwise(F.format_string("Drift detected in %d feature(s): %s", F.col("n_drifted"),
                                   F.array_join("drifted", ", ")))
    return s.withColumn("message", msg)


# ------------------------------------------------------------ Jensen-Shannon
def _js_from_shares(shares: DataFrame) -> DataFrame:
    """``shares(feature, bin, p, q)`` (missing share = 0) -> base-2 JS per feature."""
    p, q = F.coalesce(F.col("p"), F.lit(0.0)), F.coalesce(F.col("q"), F.lit(0.0))
    m = (p + q) / 2
    tp = F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    tq = F.when(q > 0, q * F.log2(q / m)).otherwise(F.lit(0.0))
    return shares.groupBy("feature").agg((0.5 * F.sum(tp + tq)).alias("js"))


def numeric_bins(baseline: DataFrame, live: DataFrame, cols: Sequence[str], bins: int = JS_BINS
                 ) -> tuple[DataFrame, DataFrame]:
    """Bin numbers over ``bins`` equal-width baseline bins; ``-1`` below the
    baseline min, ``bins`` above the max.  Returns (baseline, live) long
    ``(feature, bin)`` frames (nulls dropped)."""
    known = [nan_to_null(F.col(c).cast("double")) for c in cols]  # NaN is missing, not the greatest value
    mm = baseline.agg(*[F.min(x).alias(f"lo{i}") for i, x in enumerate(known)],
                      *[F.max(x).alias(f"hi{i}") for i, x in enumerate(known)]).first()  # one row

    def binned(df: DataFrame) -> DataFrame:
        exprs = []
        for i, c in enumerate(cols):
            lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
            x = F.col(c).cast("double")
            if lo is None:
                b = F.lit(None).cast("int")
            else:
                lo, hi = float(lo), float(hi)
                width = (hi - lo) / bins
                inner = (F.lit(0) if width == 0 else
                         F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int"))
                b = (F.when(x.isNull() | F.isnan(x), F.lit(None).cast("int"))
                     .when(x < F.lit(lo), F.lit(-1)).when(x > F.lit(hi), F.lit(bins)).otherwise(inner))
            exprs.append(F.struct(F.lit(c).alias("feature"), b.cast("string").alias("bin")))
        return (df.select(F.explode(F.array(*exprs)).alias("kv")).select("kv.*")
                .where(F.col("bin").isNotNull()))
    return binned(baseline), binned(live)


def _shares(long: DataFrame, name: str) -> DataFrame:
    c = long.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("__n"))
    t = c.groupBy("feature").agg(F.sum("__n").alias("__t"))
    return c.join(F.broadcast(t), "feature").select("feature", "bin", (F.col("__n") / F.col("__t")).alias(name))


def js_divergence(baseline: DataFrame, live: DataFrame, numeric: Sequence[str] = (),
                  categorical: Sequence[str] = (), bins: int = JS_BINS,
                  threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """``(feature, type, js, status)``: base-2 Jensen-Shannon divergence in
    [0, 1]; numeric over equal-width baseline bins plus out-of-range bins,
    categorical by value.  The two share tables are full-outer-joined."""
    parts = []
    if numeric:
        b, l = numeric_bins(baseline, live, list(numeric), bins)
        parts.append(("numeric", b, l))
    if categorical:
        b = stats.unpivot(baseline, categorical).where(F.col("value").isNotNull()).withColumnRenamed("value", "bin")
        l = stats.unpivot(live, categorical).where(F.col("value").isNotNull()).withColumnRenamed("value", "bin")
        parts.append(("categorical", b, l))
    out = None
    for kind, b, l in parts:
        sh = _shares(b, "p").join(_shares(l, "q"), ["feature", "bin"], "full_outer")
        js = _js_from_shares(sh).withColumn("type", F.lit(kind))
        out = js if out is None else out.unionByName(js)
    if out is None:
        raise ValueError("no columns")
    return out.select("feature", "type", "js", drift_status("js", threshold).alias("status"))
