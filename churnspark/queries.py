"""Registered queries: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the driver tables (or data Spark derives from them).  Floating outputs
whose last bits depend on summation order are rounded in the SAME way here
and in :mod:`churnspark.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.functions import scalar as S
from churnspark.operators import clean, drift as D, features as FE, logs as L, metrics as M
from churnspark.operators import promote as P, quality as Q, stats as ST
from churnspark.operators.split import stratified_split
from churnspark.plans import fixtures as fx
from churnspark.profile import CHURN_BASE
from churnspark.session import materialize, scratch_path
from churnspark.sources import csv as CSV, logs as LG, payload as PL, profiles as PR

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NUM = list(CHURN_BASE.numeric)          # tenure, total, n_orders, c_acctbal
CAT = list(CHURN_BASE.categorical)      # c_mktsegment, n_name
PART_CAT = ["p_brand", "p_type", "p_size"]
PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": 4}
SCORE_COLS = ["score", "score_tenure", "score_orders"]
PRED_DRIFT_CUT = "2024-01-16"


def q(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def r(col, digits: int = 6):
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def _part_text(spark, sf):
    p = fx.table(spark, sf, "part")
    return p.select("p_partkey", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size"))


def _train(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


def _log(spark, sf):
    return fx.inference_log(spark, sf)


# ------------------------------------------------------------ 2.1 sources
@q("scan_csv")
def scan_csv(spark, sf):
    raw = fx.customer_text(spark, sf)
    path = scratch_path(spark, "customer_csv")
    CSV.write_csv(raw, path)
    return CSV.scan_csv(spark, path, raw.columns)


@q("scan_parquet")
def scan_parquet(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@q("sink_curated")
def sink_curated(spark, sf):
    raw = fx.customer_text(spark, sf)
    curated = clean.clean_raw(raw, numeric_text=["acctbal_text"], target="__none", key="customer_id",
                              order_by=["name", "nation"])
    path = scratch_path(spark, "curated")
    CSV.sink_parquet(curated, path)
    return spark.read.parquet(path).select("customer_id", "name", "nation",
                                           F.col("acctbal_text").alias("acctbal"), "segment")


def _written_split(spark, sf):
    path = scratch_path(spark, "splits")
    CSV.sink_parquet(fx.churn_split(spark, sf).select("c_custkey", "churn", "split"), path, ["split"])
    return path


@q("sink_splits")
def sink_splits(spark, sf):
    return spark.read.parquet(_written_split(spark, sf)).select("c_custkey", "churn", "split")


@q("sink_train_val_dirs")
def sink_train_val_dirs(spark, sf):
    df = spark.read.parquet(_written_split(spark, sf))
    return df.where(F.col("split").isin("train", "val")).select("c_custkey", "churn", "split")


def _fitted_state(spark, sf):
    train = _train(fx.churn_nulls_split(spark, sf))
    return FE.fit_all(train, NUM, CAT)


@q("sink_fitted_state")
def sink_fitted_state(spark, sf):
    st = _fitted_state(spark, sf)
    path = scratch_path(spark, "state")
    st.save(path)
    enc = FE.FittedState.load(spark, path).encoders
    return enc.select("col_name", "value", "code")


@q("scan_fitted_state")
def scan_fitted_state(spark, sf):
    st = _fitted_state(spark, sf)
    path = scratch_path(spark, "state")
    st.save(path)
    back = FE.FittedState.load(spark, path)
    return back.fills.select("col_name", r("num_fill").alias("num_fill"), "cat_fill")


def _prepared(spark, sf):
    """churn_nulls split -> fitted on train -> applied to all splits."""
    df = fx.churn_nulls_split(spark, sf)
    st = FE.fit_all(_train(df), NUM, CAT)
    return FE.apply_all(df, st, CAT, NUM), st


@q("sink_model")
def sink_model(spark, sf):
    """The stored tables score as the fitted model does."""
    from churnspark.operators import model_tables as MT, models as MD
    prep, _ = _prepared(spark, sf)
    m = MD.train_logreg(_train(prep), CHURN_BASE.features, "churn")
    path = scratch_path(spark, "model")
    MT.to_tables(spark, m).save(path)
    both = MT.predict(MT.TableModel.load(spark, path), MD.predict(m, prep.where(F.col("split") == "test"), "ml"), "own")
    return both.select("c_custkey", (F.abs(F.col("ml") - F.col("own")) < 1e-9).alias("same_score"))


@q("scan_model")
def scan_model(spark, sf):
    """A tree ensemble is read back from its tables: whole, and with the same
    scores as before it was written."""
    from churnspark.operators import booster as B, model_tables as MT
    prep, _ = _prepared(spark, sf)
    model = MT.to_tables(spark, B.train(_train(prep), CHURN_BASE.features, "churn", B.Settings(trees=5, depth=4, eta=0.3)))
    path = scratch_path(spark, "model")
    model.save(path)
    back = MT.TableModel.load(spark, path)
    both = MT.predict(back, MT.predict(model, prep.where(F.col("split") == "test"), "before"), "after")
    n_trees = back.terms.agg(F.count_distinct("tree")).scalar()
    return both.select("c_custkey", (F.col("before") == F.col("after")).alias("same_score"), n_trees.alias("n_trees"))


@q("sink_run_metrics")
def sink_run_metrics(spark, sf):
    from churnspark.plans import jobs
    split = stratified_split(_scored(spark, sf), "c_custkey", "churn")
    path = scratch_path(spark, "runs")
    jobs.log_run(spark, path, "churn-tenure", "manual", {"C": 1.0}, M.metrics(split.where("split = 'val'"), "churn", "score_tenure"),
                 splits=split, features=CHURN_BASE.features)
    runs = spark.read.parquet(path)
    return runs.select("run_id", "experiment", F.col("params")["C"].alias("C"), F.col("params")["n_features"].alias("n_features"),
                       *[r(F.col("metrics")[m], 10).alias(m) for m in ("roc_auc", "f1", "precision", "recall", "n_train", "n_val")])


@q("sink_eval_report")
def sink_eval_report(spark, sf):
    from churnspark.plans import jobs
    rep = _decisions(spark, sf)
    path = scratch_path(spark, "eval_report")
    jobs.write_eval_report(rep, path)
    back = spark.read.json(path)
    return back.select("registered_model", "promote", *[r(F.col(f"{side}_metrics.{m}"), 10).alias(f"{side}_{m}")
                                                        for side in ("candidate", "production") for m in ("roc_auc", "f1", "precision", "recall")])


@q("sink_inference_log")
def sink_inference_log(spark, sf):
    root = scratch_path(spark, "inference_log")
    LG.sink_log(_log(spark, sf), root)
    back = LG.scan_log(spark, root)
    return back.groupBy("model", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@q("scan_inference_log")
def scan_inference_log(spark, sf):
    root = scratch_path(spark, "inference_log")
    LG.sink_log(_log(spark, sf), root)
    back = L.newest_first(LG.scan_log(spark, root))
    return back.select(F.col("id").cast("long").alias("id"), S.ts_display("timestamp").alias("ts"),
                       "model", "prediction", "probability", "risk_level")


@q("scan_baseline")
def scan_baseline(spark, sf):
    base, _ = fx.lineitem_drift(spark, sf)
    num, cat = D.baseline_profile(base, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    path = scratch_path(spark, "baseline")
    PR.write_profile(num, cat, path)
    _, cat_back = PR.read_profile(spark, path)
    return cat_back.select("feature", "value", r("p", 10).alias("p"))


def _payloads(spark, sf):
    e = fx.table(spark, sf, "events")
    row = F.concat(F.lit("[["), F.col("user_id").cast("string"), F.lit(","),
                   F.col("value").cast("decimal(12,2)").cast("string"), F.lit("]]"))
    body = (F.when(F.col("event_type") == "click", F.col("props"))
            .when(F.col("event_type").isin("view", "signup"),
                  F.concat(F.lit('{"input_data":{"columns":["user_id","value"],"data":'), row, F.lit("}}")))
            .otherwise(F.concat(F.lit('{"data":'), row, F.lit("}"))))
    return e.select(F.col("event_id").alias("request_id"), body.alias("body"))


@q("parse_score_payload")
def parse_score_payload(spark, sf):
    rows, _ = PL.parse_payload(_payloads(spark, sf), "body", ["user_id", "value"], value_type="double")
    return rows


@q("error_rows")
def error_rows(spark, sf):
    _, errs = PL.parse_payload(_payloads(spark, sf), "body", ["user_id", "value"], value_type="double")
    return errs


# ------------------------------------------------------- 2.2 projections/DQ
EXPECTED_CUSTOMER = ["c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal", "c_mktsegment"]


@q("dq_required_columns")
def dq_required_columns(spark, sf):
    return Q.required_columns(spark, fx.table(spark, sf, "customer"), EXPECTED_CUSTOMER)


@q("dq_null_rate")
def dq_null_rate(spark, sf):
    return Q.null_rates(fx.customers_with_nulls(spark, sf), fx.CUSTOMER_CONTRACT) \
        .withColumn("null_rate", r("null_rate", 10))


@q("coerce_numeric")
def coerce_numeric(spark, sf):
    t = fx.customer_text(spark, sf)
    return t.select(F.col("customer_id").cast("long").alias("c_custkey"),
                    S.coerce_numeric("acctbal_text").alias("acctbal"))


@q("map_binary")
def map_binary(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", S.map_binary("o_orderstatus", "F", "O").alias("status_code"))


@q("drop_columns")
def drop_columns(spark, sf):
    return clean.drop_columns(fx.table(spark, sf, "customer"), ["c_name", "c_comment_absent"])


@q("split_target")
def split_target(spark, sf):
    b = clean.drop_columns(fx.churn_base(spark, sf), ["c_custkey"])
    out = clean.split_target(b, "churn")
    return out.withColumn("total", r("total"))


@q("select_features")
def select_features(spark, sf):
    b = fx.churn_base(spark, sf)
    return b.select("c_custkey", *CHURN_BASE.features).withColumn("total", r("total"))


@q("fill_nulls_fit")
def fill_nulls_fit(spark, sf):
    train = _train(fx.churn_nulls_split(spark, sf))
    return FE.fill_fit(train, NUM, CAT).withColumn("num_fill", r("num_fill"))


def _num6(df: DataFrame, cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, r(c))
    return df


@q("fill_nulls_apply")
def fill_nulls_apply(spark, sf):
    df = fx.churn_nulls_split(spark, sf)
    fills = FE.fill_fit(_train(df), NUM, CAT)
    out = FE.fill_apply(df, fills).select("c_custkey", "split", *CAT, *NUM)
    return _num6(out, NUM)


@q("impute_self")
def impute_self(spark, sf):
    df = fx.churn_with_nulls(spark, sf)
    return _num6(FE.impute_self(df, NUM, CAT).select("c_custkey", *CAT, *NUM), NUM)


@q("label_encode_fit")
def label_encode_fit(spark, sf):
    return FE.label_encode_fit(_part_text(spark, sf), PART_CAT)


def _part_codes(spark, sf):
    p = _part_text(spark, sf)
    enc = FE.label_encode_fit(p.where(F.col("p_size").cast("int") <= 40), PART_CAT)
    return FE.label_encode_apply(p, enc, PART_CAT)


@q("label_encode_apply")
def label_encode_apply(spark, sf):
    return _part_codes(spark, sf)


@q("join_encoder_lookup")
def join_encoder_lookup(spark, sf):
    return _part_codes(spark, sf)


@q("standard_scale_fit")
def standard_scale_fit(spark, sf):
    train = _train(fx.churn_split(spark, sf))
    return FE.scale_fit(train, NUM).select("col_name", r("mean").alias("mean"), r("scale").alias("scale"))


@q("standard_scale_apply")
def standard_scale_apply(spark, sf):
    df = fx.churn_split(spark, sf)
    sc = FE.scale_fit(_train(df), NUM)
    return _num6(FE.scale_apply(df, sc).select("c_custkey", "split", *NUM), NUM)


@q("join_param_cross")
def join_param_cross(spark, sf):
    df = fx.churn_nulls_split(spark, sf)
    train = _train(df)
    fills = FE.fill_fit(train, NUM, CAT)
    sc = FE.scale_fit(FE.fill_apply(train, fills), NUM)
    out = FE.scale_apply(FE.fill_apply(df, fills), sc).select("c_custkey", "split", *NUM)
    return _num6(out, NUM)


@q("union_splits_apply")
def union_splits_apply(spark, sf):
    prep, _ = _prepared(spark, sf)
    return _num6(prep.select("c_custkey", "split", *CAT, *NUM, "churn"), NUM)


def _scored(spark, sf):
    return fx.scored_churn(spark, sf)


@q("threshold_predict")
def threshold_predict(spark, sf):
    s = _scored(spark, sf)
    return s.select("c_custkey", "score", S.threshold_predict("score").alias("prediction"))


@q("risk_band")
def risk_band(spark, sf):
    s = _scored(spark, sf)
    return s.select("c_custkey", "score", S.risk_band("score").alias("risk_level"))


@q("pred_label_map")
def pred_label_map(spark, sf):
    s = _scored(spark, sf)
    return s.select("c_custkey", S.pred_label(S.threshold_predict("score")).alias("label"))


@q("range_check")
def range_check(spark, sf):
    b = fx.churn_base(spark, sf)
    return Q.range_check(b, CHURN_BASE.rules).select("c_custkey", "violations", "accepted")


@q("code_dictionary")
def code_dictionary(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", S.code_dictionary("o_orderpriority", PRIORITY_CODES).alias("priority_code"))


def _drift_profiles(spark, sf):
    base, live = fx.lineitem_drift(spark, sf)
    num, cat = D.baseline_profile(base, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    return base, live, num, cat


@q("drift_status")
def drift_status(spark, sf):
    _, live, num, cat = _drift_profiles(spark, sf)
    rep = D.drift_report(live, num, cat)
    return D.drift_summary(rep).select("n_features", "n_drifted", F.array_join("drifted", ",").alias("drifted"),
                                       "message")


# ---------------------------------------------------------------- 2.3 joins
@q("join_psi")
def join_psi(spark, sf):
    _, live, _, cat = _drift_profiles(spark, sf)
    t = D.psi_terms(live, cat)
    return t.select("feature", "value", r("base_p", 10).alias("base_p"), r("live_p", 10).alias("live_p"))


def _model_metrics(spark, sf):
    """Exact metrics of three deterministic scorers on the TEST split."""
    s = stratified_split(_scored(spark, sf), "c_custkey", "churn").where(F.col("split") == "test")
    long = s.select("churn", F.explode(F.array(*[
        F.struct(F.lit(c).alias("model_key"), F.col(c).alias("score")) for c in SCORE_COLS])).alias("kv")) \
        .select("churn", "kv.*")
    return M.metrics(long, "churn", "score", group_cols=["model_key"])


REGISTRY_ROWS = [("score_orders", "churn", 1, "archived"), ("score_tenure", "churn", 2, "production"),
                 ("score", "churn", 3, "candidate"), ("score_orders", "churn_orders", 1, "candidate")]


def _versions(spark, sf):
    reg = spark.createDataFrame(REGISTRY_ROWS, "model_key string, name string, version int, stage string")
    # read several times by each consumer: the metrics are written once
    m = materialize(_model_metrics(spark, sf), "model_metrics")
    return reg.join(m, "model_key").select("name", "version", "stage", "roc_auc", "f1",
                                                        "precision", "recall")


def _candidates(versions: DataFrame) -> DataFrame:
    c = versions.where(F.col("stage") == "candidate")
    return c.groupBy("name").agg(F.max_by(F.struct("version", "roc_auc", "f1", "precision", "recall"),
                                          F.col("version")).alias("r")).select("name", "r.*")


def _decisions(spark, sf, v: DataFrame | None = None):
    v = _versions(spark, sf) if v is None else v
    j = P.join_champion(_candidates(v), P.production_metrics(v))
    cand = _candidates(v).select("name", "version")
    return P.promote_decision(j).join(cand, "name")


@q("join_champion")
def join_champion(spark, sf):
    v = _versions(spark, sf)
    j = P.join_champion(_candidates(v), P.production_metrics(v))
    return j.select("name", *[r(c, 10).alias(c) for c in j.columns if c.startswith(("cand_", "prod_"))],
                    "has_production")


@q("promote_decision")
def promote_decision(spark, sf):
    d = _decisions(spark, sf)
    return d.select("name", "version", r("cand_roc_auc", 10).alias("cand_roc_auc"),
                    r("prod_roc_auc", 10).alias("prod_roc_auc"), "has_production",
                    r("auc_delta", 10).alias("auc_delta"), "promote")


@q("promote_transition")
def promote_transition(spark, sf):
    v = _versions(spark, sf)
    new = P.promote_transition(v, _decisions(spark, sf, v))
    return new.select("name", "version", "stage", r("roc_auc", 10).alias("roc_auc"))


@q("latest_version")
def latest_version(spark, sf):
    v = _versions(spark, sf)
    return P.latest_version(v).join(
        P.latest_version(v, "production").withColumnRenamed("version", "production_version"), "name", "left")


def _runs(spark, sf):
    m = _model_metrics(spark, sf)
    return m.select(F.col("model_key").alias("run_id"), F.lit("churn").alias("experiment"),
                    F.col("roc_auc").alias("auc_weighted"))


@q("best_run")
def best_run(spark, sf):
    b = P.best_run(_runs(spark, sf))
    return b.select("experiment", "run_id", r("auc_weighted", 10).alias("auc_weighted"))


# --------------------------------------------------------- 2.4 aggregations
@q("agg_null_rate")
def agg_null_rate(spark, sf):
    c = Q.null_counts(fx.customers_with_nulls(spark, sf))
    return c.select("column_name", r("null_rate", 10).alias("null_rate"))


@q("agg_null_count")
def agg_null_count(spark, sf):
    c = Q.null_counts(fx.customers_with_nulls(spark, sf))
    return c.select("column_name", "n_null")


@q("agg_median")
def agg_median(spark, sf):
    return ST.median(fx.churn_base(spark, sf), NUM).withColumn("median", r("median"))


@q("agg_mode")
def agg_mode(spark, sf):
    return ST.mode(_part_text(spark, sf), PART_CAT)


@q("agg_distinct_sorted")
def agg_distinct_sorted(spark, sf):
    return ST.distinct_sorted(_part_text(spark, sf), ["p_brand", "p_type"])


@q("agg_row_counts")
def agg_row_counts(spark, sf):
    # loaded and kept rows come from one count per key, the split sizes from one pass
    keys = fx.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    rows = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_loaded"), F.count(F.lit(1)).alias("rows_saved"))
    split = stratified_split(fx.churn_base(spark, sf), "c_custkey", "churn")
    sizes = split.agg(*[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")])
    return rows.join(F.broadcast(sizes), F.lit(True)).select(  # one row each
        "rows_loaded", "rows_saved", (F.col("rows_loaded") - F.col("rows_saved")).alias("duplicates_dropped"), "n_train", "n_val", "n_test")


@q("agg_mean_std_profile")
def agg_mean_std_profile(spark, sf):
    base, _ = fx.lineitem_drift(spark, sf)
    ms = ST.mean_std(base, fx.DRIFT_NUMERIC)
    return ms.select("feature", r("mean").alias("mean"), r("std").alias("std"))


@q("agg_value_proportions")
def agg_value_proportions(spark, sf):
    base, _ = fx.lineitem_drift(spark, sf)
    vp = ST.value_proportions(base, fx.DRIFT_CATEGORICAL)
    return vp.select("feature", "value", "n", r("p", 10).alias("p"))


@q("agg_daily_rate")
def agg_daily_rate(spark, sf):
    return L.daily_rate(_log(spark, sf)).withColumn("churn_rate", r("churn_rate", 10))


@q("agg_daily_volume")
def agg_daily_volume(spark, sf):
    return L.daily_volume(_log(spark, sf))


@q("pivot_rate")
def pivot_rate(spark, sf):
    p = L.pivot_rate(_log(spark, sf), fx.LOG_MODELS)
    return _round_cols(p, fx.LOG_MODELS, 10)


def _round_cols(df, cols, digits):
    for c in cols:
        df = df.withColumn(c, r(c, digits))
    return df


@q("pivot_volume")
def pivot_volume(spark, sf):
    return L.pivot_volume(_log(spark, sf), fx.LOG_MODELS)


@q("agg_risk_distribution")
def agg_risk_distribution(spark, sf):
    return L.risk_distribution(_log(spark, sf))


@q("agg_avg_probability")
def agg_avg_probability(spark, sf):
    return L.avg_probability(_log(spark, sf))


@q("agg_log_summary")
def agg_log_summary(spark, sf):
    return L.log_summary(_log(spark, sf), fx.LOG_MODELS).withColumn("churn_rate", r("churn_rate", 10))


@q("agg_batch_rate")
def agg_batch_rate(spark, sf):
    s = _scored(spark, sf).withColumn("prediction", S.threshold_predict("score"))
    return L.batch_rate(s).withColumn("positive_rate", r("positive_rate", 10))


@q("class_weights")
def class_weights(spark, sf):
    return M.class_weights(fx.churn_base(spark, sf), "churn").withColumn("weight", r("weight", 10))


@q("pos_weight")
def pos_weight(spark, sf):
    b = fx.churn_base(spark, sf)
    return M.with_pos_weight(b, "churn").select("c_custkey", "churn", "weight")


def _pred(spark, sf):
    return M.with_prediction(_scored(spark, sf), "score")


@q("confusion_matrix")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_pred(spark, sf), "churn", "prediction")


@q("precision_recall_f1")
def precision_recall_f1(spark, sf):
    m = M.precision_recall_f1(_pred(spark, sf), "churn", "prediction")
    return _round_cols(m, ["precision", "recall", "f1"], 10)


@q("classification_report")
def classification_report(spark, sf):
    m = M.classification_report(_pred(spark, sf), "churn", "prediction")
    return _round_cols(m, ["precision", "recall", "f1"], 10)


@q("roc_auc")
def roc_auc(spark, sf):
    s = _scored(spark, sf)
    long = s.select("churn", F.explode(F.array(*[
        F.struct(F.lit(c).alias("model_key"), F.col(c).alias("score")) for c in SCORE_COLS])).alias("kv")) \
        .select("churn", "kv.*")
    a = M.roc_auc(long, "churn", "score", group_cols=["model_key"])
    return a.withColumn("roc_auc", r("roc_auc", 10))


@q("auc_weighted")
def auc_weighted(spark, sf):
    a = M.auc_weighted(_scored(spark, sf), "churn", "score")
    return a.withColumn("auc_weighted", r("auc_weighted", 10))


# ----------------------------------------------------------- 2.6 sort/top-k
@q("sort_newest_first")
def sort_newest_first(spark, sf):
    return L.newest_first(_log(spark, sf)).select("id", S.ts_display("timestamp").alias("ts"), "model",
                                                  "probability")


@q("recent_topk")
def recent_topk(spark, sf):
    return L.recent(_log(spark, sf), 20)


@q("drift_ranking")
def drift_ranking(spark, sf):
    _, live, num, cat = _drift_profiles(spark, sf)
    return D.drift_report(live, num, cat).select("feature", "type", "drift_score", "status")


# -------------------------------------------------------------- 2.7 dedup
@q("dedup_keep_first")
def dedup_keep_first(spark, sf):
    o = fx.table(spark, sf, "orders")
    return clean.dedup_keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]) \
        .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@q("union_logs")
def union_logs(spark, sf):
    log = _log(spark, sf)
    cut = F.lit(PRED_DRIFT_CUT).cast("timestamp")
    a, b = scratch_path(spark, "log_a"), scratch_path(spark, "log_b")
    LG.sink_log(log.where(F.col("timestamp") < cut), a)
    LG.sink_log(log.where(F.col("timestamp") >= cut), b)
    both = LG.scan_log(spark, a).unionByName(LG.scan_log(spark, b))
    return both.select(F.col("id").cast("long").alias("id"), "model", "prediction")


# ------------------------------------------------------------- 2.8 scalars
@q("scalar_ts_format")
def scalar_ts_format(spark, sf):
    log = _log(spark, sf)
    return log.select("id", S.ts_display("timestamp").alias("ts_display"), S.ts_path("timestamp").alias("ts_path"))


@q("scalar_json_roundtrip")
def scalar_json_roundtrip(spark, sf):
    e = fx.table(spark, sf, "events")
    parsed = e.select("event_id", F.from_json("props", "k int").alias("j"))
    return parsed.select("event_id", F.col("j.k").alias("k"), F.to_json(F.struct(F.col("j.k").alias("k")))
                         .alias("props_out"))


# --------------------------------------------------------------- 2.9 split
@q("stratified_split")
def stratified_split_q(spark, sf):
    # the operator itself (its input is written once inside it); writing the
    # split as a table for several consumers is ``churn_split`` / sink_splits
    return stratified_split(fx.churn_base(spark, sf), "c_custkey", "churn").select("c_custkey", "churn", "split")


# ----------------------------------------------------------------- 2.11 drift
@q("drift_mean_shift")
def drift_mean_shift(spark, sf):
    _, live, num, _ = _drift_profiles(spark, sf)
    return D.mean_shift(live, num)


@q("drift_psi")
def drift_psi(spark, sf):
    _, live, _, cat = _drift_profiles(spark, sf)
    return D.psi(live, cat).select("feature", "type", "drift_score")


@q("drift_report")
def drift_report(spark, sf):
    _, live, num, cat = _drift_profiles(spark, sf)
    return D.drift_report(live, num, cat)


@q("drift_js_divergence")
def drift_js_divergence(spark, sf):
    base, live = fx.lineitem_drift(spark, sf)
    js = D.js_divergence(base, live, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    return js.withColumn("js", r("js", 10))


@q("drift_prediction")
def drift_prediction(spark, sf):
    log = _log(spark, sf)
    cut = F.lit(PRED_DRIFT_CUT).cast("timestamp")
    js = D.js_divergence(log.where(F.col("timestamp") < cut), log.where(F.col("timestamp") >= cut),
                         numeric=["probability"], categorical=["risk_level"])
    return js.withColumn("js", r("js", 10))


@q("dq_production")
def dq_production(spark, sf):
    base, live = fx.lineitem_drift(spark, sf)
    out = Q.production_quality(base, live, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    return _round_cols(out, ["null_rate", "out_of_range_rate"], 10)


@q("baseline_profile")
def baseline_profile(spark, sf):
    base, _ = fx.lineitem_drift(spark, sf)
    num, cat = D.baseline_profile(base, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    a = num.select("feature", F.lit(None).cast("string").alias("value"), r("mean").alias("mean"),
                   r("std").alias("std"), F.lit(None).cast("double").alias("p"))
    b = cat.select("feature", "value", F.lit(None).cast("double").alias("mean"),
                   F.lit(None).cast("double").alias("std"), r("p", 10).alias("p"))
    return a.unionByName(b)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # R-checked queries (model fitting, streams, jobs) live in plans.jobs
    from churnspark.plans import jobs  # noqa: F401  (registers its queries)
    return dict(REGISTRY)

