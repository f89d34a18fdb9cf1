"""Exact binary-classification metrics as aggregations.

Everything reduces to counts: the confusion matrix is four ``count_if`` in
ONE pass, precision/recall/F1 follow from it (0 when undefined, as the
original), and the ROC AUC is the exact rank statistic (ties count half)
computed over distinct scores with distributed prefix sums -- no score
binning, no single-task global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.scalar import DECISION_THRESHOLD
from churnspark.operators import prefix as px

POS_WEIGHT = 3.0  # fixed value: weight of the positive class in boosted training


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def with_prediction(df: DataFrame, prob: str, out: str = "prediction",
                    threshold: float = DECISION_THRESHOLD) -> DataFrame:
    return df.withColumn(out, (F.col(prob) >= F.lit(threshold)).cast("int"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row ``(tp, fp, fn, tn)`` (longs)."""
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y != 1) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p != 1)).alias("fn"), F.count_if((y != 1) & (p != 1)).alias("tn"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Long 2x2 ``(actual, predicted, n)``; zero cells are present."""
    c = confusion_counts(df, label, pred)
    return c.selectExpr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, n)")


def _div0(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def prf_from_counts(c: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = _div0(tp, tp + fp)
    rec = _div0(tp, tp + fn)
    f1 = _div0(2 * tp, 2 * tp + fp + fn)
    return c.select("tp", "fp", "fn", "tn", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def precision_recall_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Positive-class precision, recall, F1 (0 when undefined)."""
    return prf_from_counts(confusion_counts(df, label, pred))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class ``0``/``1`` precision, recall, f1, support plus ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows (one pass over the data)."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1, f1_1 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(2 * tp, 2 * tp + fp + fn)
    p0, r0, f1_0 = _div0(tn, tn + fn), _div0(tn, tn + fp), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div0(tp + tn, n)
    wide = c.select(p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
                    p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"),
                    acc.alias("acc"), n.alias("n"))
    return wide.selectExpr(
        "stack(5,"
        " '0', p0, r0, f0, s0,"
        " '1', p1, r1, f1, s1,"
        " 'accuracy', acc, acc, acc, n,"
        " 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,"
        " 'weighted avg', if(n = 0, 0d, (p0 * s0 + p1 * s1) / n), if(n = 0, 0d, (r0 * s0 + r1 * s1) / n),"
        "   if(n = 0, 0d, (f0 * s0 + f1 * s1) / n), n"
        ") as (class_label, precision, recall, f1, support)")


def score_label_counts(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """``(*groups, score, pos, neg)`` per distinct score (map-side combined)."""
    y = F.col(label)
    return (df.where(F.col(score).isNotNull() & y.isNotNull() & ~F.isnan(F.col(score).cast("double")))
            .groupBy(*group_cols, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def _auc_aggregate(df: DataFrame, label: str, score: str, threshold: float | None,
                   n_buckets: int | None, group_cols: Sequence[str] = ()) -> DataFrame:
    from churnspark.session import materialize
    group_cols = list(group_cols)
    # one pass over the input: the per-distinct-score table is written once
    counts = materialize(score_label_counts(df, label, score, group_cols), "score_counts")
    nb = n_buckets or px.adaptive_buckets(df.sparkSession, counts.count())
    b = px.bucketize(counts, ["score"], px.quantile_splits(counts, ["score"], nb), ["__bk"])
    # global score boundaries are monotone inside every group as well
    pre = px.prefix_sums(b, group_cols, ["score"], "__bk", ["neg"], with_totals=False)
    dec = "decimal(38,0)"
    num2 = F.sum(F.col("pos").cast(dec) * (2 * F.col("cum_neg").cast(dec) + F.col("neg").cast(dec)))
    aggs = [num2.alias("num2"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg")]
    if threshold is not None:
        hit = F.col("score") >= F.lit(threshold)
        aggs += [F.sum(F.when(hit, F.col("pos"))).alias("tp"), F.sum(F.when(hit, F.col("neg"))).alias("fp")]
    return pre.groupBy(*group_cols).agg(*aggs) if group_cols else pre.agg(*aggs)


def _auc_expr() -> Column:
    return F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                  F.col("num2").cast("double")
                  / (2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")))


def roc_auc(df: DataFrame, label: str, score: str, n_buckets: int | None = None,
            group_cols: Sequence[str] = ()) -> DataFrame:
    """One row ``(roc_auc, n_pos, n_neg)``: exact Mann-Whitney AUC
    ``P(s+ > s-) + 0.5 P(s+ = s-)``; NULL when a class is absent.

    Exact integer arithmetic (decimal(38,0)) for the rank sum, so no
    precision is lost on billions of rows.
    """
    agg = _auc_aggregate(df, label, score, None, n_buckets, group_cols)
    return agg.select(*group_cols, _auc_expr().alias("roc_auc"), F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
                      F.coalesce("n_neg", F.lit(0)).alias("n_neg"))


def window_roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Small-data reference form (single global window) used in tests."""
    from pyspark.sql import Window
    c = score_label_counts(df, label, score)
    w = Window.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("cum_neg", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    agg = c.agg(F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("s"),
                F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("s") / (F.col("p") * F.col("n")))
                      .alias("roc_auc"))


def metrics(df: DataFrame, label: str, score: str, threshold: float = DECISION_THRESHOLD,
            n_buckets: int | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row ``(roc_auc, f1, precision, recall)`` -- the evaluation record.

    AUC and the confusion counts at ``threshold`` come out of the SAME final
    aggregate over the per-score table.
    """
    agg = _auc_aggregate(df, label, score, threshold, n_buckets, group_cols)
    tp = F.coalesce(F.col("tp"), F.lit(0))
    fp = F.coalesce(F.col("fp"), F.lit(0))
    fn = F.coalesce(F.col("n_pos"), F.lit(0)) - tp
    return agg.select(*group_cols, _auc_expr().alias("roc_auc"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                      _div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"))


def auc_weighted(df: DataFrame, label: str, scores: Sequence[str] | str) -> DataFrame:
    """Support-weighted one-vs-rest AUC.

    Binary: ``scores`` is the positive-class probability (or [p0, p1]); the
    class-0 AUC on ``1 - p`` equals the class-1 AUC, so the weighted average
    equals the plain AUC.  Multi-class: one probability column per class
    ``0..k-1``.
    """
    if isinstance(scores, str):
        scores = [scores]
    if len(scores) == 1:
        return roc_auc(df, label, scores[0]).select(F.col("roc_auc").alias("auc_weighted"))
    parts = []
    for k, s in enumerate(scores):
        one = df.select(F.when(F.col(label) == k, 1).otherwise(0).alias("__y"), F.col(s).alias("__s"))
        parts.append(roc_auc(one, "__y", "__s").select(F.lit(k).alias("k"), "roc_auc", "n_pos"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg((F.sum(F.col("roc_auc") * F.col("n_pos")) / F.sum("n_pos")).alias("auc_weighted"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class: ``(label, n, weight)``.

    The window runs over the per-class table (one row per class)."""
    from pyspark.sql import Window
    per = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    t = F.sum("n").over(w).cast("double")
    k = F.count(F.lit(1)).over(w).cast("double")
    return per.select("label", "n", (t / (k * F.col("n").cast("double"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    w = class_weights(df, label)
    return df.join(F.broadcast(w.select(F.col("label").alias(label), F.col("weight").alias(out))), label, "left")


def with_pos_weight(df: DataFrame, label: str, out: str = "weight", weight: float = POS_WEIGHT) -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))
