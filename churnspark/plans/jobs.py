"""Composed jobs (ingest, prepare, train, evaluate/promote, monitor) and the
rows-checked queries: model fitting, search, ensembles, scoring, streams.

A job is a plain Python function that chains lazy operators and triggers
only the actions it needs (fits are actions; writes are actions).  Data
boundaries between steps are parquet tables under the shared checkpoint
root, so a lost executor recomputes from a written table, never from the
start of the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.scalar import risk_band, threshold_predict
from churnspark.operators import clean, drift as D, features as FE, logs as L, metrics as M
from churnspark.operators import model_tables as MT, models as MD, promote as P, quality as Q, rules as R
from churnspark.operators.split import stratified_split
from churnspark.plans import fixtures as fx, scoring as SC
from churnspark.profile import CHURN_BASE, Profile
from churnspark.queries import CAT, NUM, _prepared, _train, q, r
from churnspark.session import materialize, read_or_empty, scratch_path
from churnspark.sources import csv as CSV, logs as LG
from churnspark.streaming import streams as SS


# ------------------------------------------------------------ sinks
RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("ts", T.TimestampType()),
])


def log_run(spark: SparkSession, path: str, run_id: str, experiment: str, params: dict,
            metrics_row: DataFrame, splits: DataFrame | None = None, features=()) -> None:
    """Append one run record to the runs table: params (with the number of
    features) and metrics (with the rows of the training and validation split
    of ``splits``, counted in the same pass)."""
    named = [x for c in metrics_row.columns for x in (F.lit(c), F.col(c).cast("double"))]
    if splits is not None:
        sizes = splits.agg(*[F.count_if(F.col("split") == s).cast("double").alias(f"n_{s}") for s in ("train", "val")])
        metrics_row = metrics_row.join(F.broadcast(sizes), F.lit(True))  # one row each
        named += [x for s in ("train", "val") for x in (F.lit(f"n_{s}"), F.col(f"n_{s}"))]
    params = dict(params) | ({"n_features": len(features)} if features else {})
    rec = metrics_row.select(
        F.lit(run_id).alias("run_id"), F.lit(experiment).alias("experiment"),
        F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]).cast("map<string,string>").alias("params"),
        F.create_map(*named).alias("metrics"), F.current_timestamp().alias("ts"))
    rec.write.mode("append").parquet(path)


def write_eval_report(decisions: DataFrame, path: str) -> None:
    """One record per model name: candidate/production metric structs,
    promote flag, registered model name."""
    cand = [c for c in decisions.columns if c.startswith("cand_")]
    prod = [c for c in decisions.columns if c.startswith("prod_")]
    rep = decisions.select(
        F.struct(*[F.col(c).alias(c[5:]) for c in cand]).alias("candidate_metrics"),
        F.struct(*[F.col(c).alias(c[5:]) for c in prod]).alias("production_metrics"),
        "promote", F.col("name").alias("registered_model"))
    rep.write.mode("overwrite").json(path)


# ------------------------------------------------------------ jobs
def job_ingest(spark: SparkSession, csv_path: str, out: str, profile: Profile,
               numeric_text=("TotalCharges",), rejected: str | None = None) -> dict:
    """CSV -> contract check -> coerce -> map target -> keep-first dedup -> parquet.

    The CSV is read once, into a columnar copy of its text; validation, cleaning
    and row counts read that.  Null shares are those of the RAW text, before
    cleaning (a blank total is not a null there); a table that breaks the contract
    raises before anything is written to ``out``.  Rows whose target is neither
    class go to the table ``rejected`` if that is given, else they stay with a
    NULL target.  Returns row counts.
    """
    raw = CSV.scan_csv(spark, csv_path, profile.expected_columns)
    # the order is a position in the files, so it is taken on the scan itself
    copy = materialize(clean.with_ingest_order(raw), "raw")
    Q.validate(copy, profile.contract)
    cleaned = clean.clean_raw(copy, numeric_text=numeric_text, target=profile.target, key=profile.key,
                              order_by=["__ingest_order"]).drop("__ingest_order")
    counts = {"rows_loaded": copy.count()}  # from the files' footers, as below
    if rejected:
        known = F.col(profile.target).isNotNull()
        cleaned = materialize(cleaned, "ingest")
        unmapped = cleaned.where(~known)
        unmapped.write.mode("overwrite").parquet(rejected)
        counts["rows_rejected"] = spark.read.schema(unmapped.schema).parquet(rejected).count()
        cleaned = cleaned.where(known)
    cleaned.write.mode("overwrite").parquet(out)
    saved = spark.read.schema(cleaned.schema).parquet(out).count()
    return counts | {"rows_saved": saved, "duplicates_dropped": counts["rows_loaded"] - saved - counts.get("rows_rejected", 0)}


def job_prepare(spark: SparkSession, curated: DataFrame, profile: Profile, out: str,
                key: str | None = None) -> FE.FittedState:
    """Drop ids -> split -> fit on train -> apply to all -> one partitioned write."""
    key = key or profile.key
    df = curated.withColumn(profile.target, F.col(profile.target).cast("int"))
    split = stratified_split(df, key, profile.target)
    # materialise the split once (a written table: survives executor loss)
    split_path = f"{out}/_split"
    split.write.mode("overwrite").parquet(split_path)
    split = spark.read.parquet(split_path)
    state = FE.fit_all(_train(split), list(profile.numeric), list(profile.categorical))
    state.save(f"{out}/state")
    prepared = FE.apply_all(split, state, list(profile.categorical), list(profile.numeric))
    keep = [c for c in [key] if c] + profile.features + [profile.target, "split"]
    prepared.select(*keep).write.mode("overwrite").partitionBy("split").parquet(f"{out}/splits")
    return state


def evaluate(model, test: DataFrame, label: str) -> DataFrame:
    return M.metrics(MD.predict(model, test), label, "probability_1")


def register_and_promote(spark: SparkSession, models: list, test: DataFrame, label: str, registry_path: str,
                         name: str = "churn") -> DataFrame:
    """Store each model as tables, register it as a candidate with its metrics
    on ``test``, decide on the newest candidate against the production version
    and record the change of stages.  Returns the decisions.

    Order of writes: models, candidates, decisions, stages, report, snapshot.
    The events are the registry; ``registry_path`` itself holds a snapshot that
    is made from them anew each time, so a crash anywhere loses nothing.
    """
    events = f"{registry_path}_events"
    known = P.fold_events(P.read_events(spark, events))
    next_v = (known.agg(F.max("version")).first()[0] or 0) + 1
    rows = None
    for i, model in enumerate(models):
        MT.to_tables(spark, model).save(f"{registry_path}_models/{name}/{next_v + i}")
        row = evaluate(model, test, label).select(F.lit(name).alias("name"), F.lit(next_v + i).alias("version"),
                                                  F.lit("candidate").alias("stage"), "roc_auc", "f1", "precision", "recall")
        rows = row if rows is None else rows.unionByName(row)
    P.append_events(rows, events)
    versions = materialize(P.fold_events(P.read_events(spark, events)), "versions")
    cands = (versions.where("stage = 'candidate'").groupBy("name")
             .agg(F.max_by(F.struct("version", "roc_auc", "f1", "precision", "recall"), "version").alias("r"))
             .select("name", "r.*"))
    dec = P.promote_decision(P.join_champion(cands, P.production_metrics(versions))).join(cands.select("name", "version"), "name")
    dec_path = f"{registry_path}_decisions/v{next_v}"
    dec.write.mode("overwrite").parquet(dec_path)
    dec = spark.read.parquet(dec_path)
    P.append_events(P.changed_stages(versions, P.promote_transition(versions, dec)), events)
    write_eval_report(dec, f"{registry_path}_reports/v{next_v}")
    P.fold_events(P.read_events(spark, events)).write.mode("overwrite").parquet(registry_path)
    return dec


def job_train_evaluate(spark: SparkSession, prepared_path: str, profile: Profile, registry_path: str,
                       algorithms=("logreg", "boosted"), trees: int | None = None,
                       name: str = "churn") -> DataFrame:
    """Train the listed learners on train, evaluate them on test and bring them
    into the registry.  Returns the decisions."""
    splits = spark.read.parquet(prepared_path)
    train, test = splits.where("split = 'train'"), splits.where("split = 'test'")
    models = [MD._fit(alg, train, profile.features, profile.target, {"trees": trees} if (trees and alg != "logreg") else {})
              for alg in algorithms]
    return register_and_promote(spark, models, test, profile.target, registry_path, name)


def job_search(spark: SparkSession, prepared_path: str, profile: Profile, registry_path: str, space, name: str = "churn",
               max_trials: int = 5, parallelism: int = 2) -> tuple[DataFrame, DataFrame]:
    """Search, then the winner's evaluation on the test split, its report and
    its promotion.  Returns the runs and the decisions."""
    splits = spark.read.parquet(prepared_path)
    runs, trials = MD.model_search(splits.where("split = 'train'"), splits.where("split = 'val'"), profile.features, profile.target,
                                   space=space, max_trials=max_trials, parallelism=parallelism, experiment=name)
    best = P.best_run_or_raise(runs.where("status = 'finished'"))
    winner = next(t.model for t in trials if t.run_id == best)
    return runs, register_and_promote(spark, [winner], splits.where("split = 'test'"), profile.target, registry_path, name)


def job_monitor(spark: SparkSession, log: DataFrame, num_profile: DataFrame, cat_profile: DataFrame,
                models, drift_from=None) -> dict[str, DataFrame]:
    """Every dashboard table off ONE cached scan of the whole log; rows from
    the timestamp ``drift_from`` on (default: all) are compared with the
    baseline profile in the drift report.

    The persisted log is returned under ``"log"``; call ``unpersist()`` on it
    once the tables have been consumed."""
    log = log.persist()
    live = log if drift_from is None else log.where(F.col("timestamp") >= drift_from)
    return {
        "log": log,
        "summary": L.log_summary(log, models),
        "daily_rate": L.daily_rate(log),
        "daily_volume": L.daily_volume(log),
        "pivot_rate": L.pivot_rate(log, models),
        "pivot_volume": L.pivot_volume(log, models),
        "risk": L.risk_distribution(log),
        "avg_probability": L.avg_probability(log),
        "recent": L.recent(log, 20),
        "drift": D.drift_report(live.select("inputs.*"), num_profile, cat_profile),
    }


def dashboard_rows(tables: dict[str, DataFrame], models) -> DataFrame:
    """The contents of all dashboard tables: (table_name, key, metric, value)."""
    day, per_model = F.col("date").cast("string"), F.concat_ws("|", F.col("date").cast("string"), "model")
    wide = {m: m for m in models}
    layout = {
        "summary": (F.lit("all"), {c: c for c in ("total", *[f"n_{m}" for m in models], "churn_rate")}),
        "daily_rate": (per_model, {"churn_rate": "churn_rate"}), "daily_volume": (per_model, {"n": "n"}),
        "pivot_rate": (day, wide), "pivot_volume": (day, wide),
        "risk": (F.concat_ws("|", "model", "risk_level"), {"n": "n"}),
        "avg_probability": (F.col("model"), {"avg_probability": "avg_probability"}),
        "recent": (F.concat_ws("|", "timestamp", "model", "prediction", "risk_level"), {"probability": "probability"}),
        "drift": (F.concat_ws("|", "feature", "type", "status"), {"drift_score": "drift_score"}),
    }
    out = None
    for name, (key, metrics) in layout.items():
        values = F.array(*[F.struct(F.lit(m).alias("metric"), r(F.col(c).cast("double"), 10).alias("value"))
                           for m, c in metrics.items()])
        part = tables[name].select(F.lit(name).alias("table_name"), key.alias("key"), F.explode(values).alias("e")) \
            .select("table_name", "key", "e.*")
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------- rows-checked queries
@q("train_logreg")
def q_train_logreg(spark, sf):
    """The optimum of the penalised, weighted loss: its gradient, summed up anew
    from the rows, vanishes in every coefficient and the intercept."""
    prep, _ = _prepared(spark, sf)
    train = _train(prep)
    m = MD.train_logreg(train, CHURN_BASE.features, "churn")
    weight = {r["feature"]: r["weight"] for r in MT.to_tables(spark, m).terms.collect()}  # one row per feature
    scored = MD.predict(m, M.with_class_weight(train, "churn", "w"), "p")
    slope = lambda x: F.sum(F.col("w") * (F.col("p") - F.col("churn")) * x)
    row = scored.agg(F.count("*").alias("n"), *[slope(F.col(c)).alias(f"g_{c}") for c in CHURN_BASE.features], slope(F.lit(1.0)).alias("g_"))
    parts = [(c, F.col(f"g_{c}") + F.lit(weight[c] / MD.LOGREG["C"])) for c in CHURN_BASE.features] + [("(intercept)", F.col("g_"))]
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("term"), F.col("n").alias("n_rows"), (F.abs(g) < 0.005 * F.col("n")).alias("at_optimum"))
                                          for c, g in parts])).alias("e")).select("e.*")


@q("train_boosted")
def q_train_boosted(spark, sf):
    prep, _ = _prepared(spark, sf)
    m = MD.train_boosted(_train(prep), CHURN_BASE.features, "churn")
    curve = MD.eval_curve(m, prep.where("split = 'val'"), "churn")
    return curve


@q("train_forest")
def q_train_forest(spark, sf):
    prep, _ = _prepared(spark, sf)
    m = MD.train_forest(_train(prep), CHURN_BASE.features, "churn")
    return evaluate(m, prep.where("split = 'val'"), "churn").withColumn("model", F.lit("forest"))


@q("top_feature_importance")
def q_top_feature_importance(spark, sf):
    prep, _ = _prepared(spark, sf)
    m = MD.train_forest(_train(prep), CHURN_BASE.features, "churn")
    return MD.top_feature_importance(m, CHURN_BASE.features, 10)


#: Every learner with its defaults.
SEARCH_SPACE = (("logreg", {}), ("forest", {}), ("boosted", {}))


@q("model_search")
def q_model_search(spark, sf):
    prep, _ = _prepared(spark, sf)
    runs, _ = MD.model_search(_train(prep), prep.where("split = 'val'"), CHURN_BASE.features, "churn",
                              space=SEARCH_SPACE, max_trials=5, parallelism=2)
    return runs.select("run_id", "experiment", "algorithm", "auc_weighted", "rung", "status")


@q("ensemble_vote")
def q_ensemble_vote(spark, sf):
    """The vote of stored members, scored from their tables one by one, is the
    ensemble's."""
    prep, _ = _prepared(spark, sf)
    tr = _train(prep)
    ms = [MD.train_logreg(tr, CHURN_BASE.features, "churn"),
          MD.train_forest(tr, CHURN_BASE.features, "churn")]
    v = MD.ensemble_vote(ms, prep.where("split = 'test'"))
    for i, m in enumerate(ms):
        path = scratch_path(spark, "member")
        MT.to_tables(spark, m).save(path)
        v = MT.predict(MT.TableModel.load(spark, path), v, f"own{i}")
    return v.select("c_custkey", (F.abs(F.col("probability_1") - (F.col("own0") + F.col("own1")) / 2) < 1e-9).alias("same_vote"))


@q("ensemble_stack")
def q_ensemble_stack(spark, sf):
    """The stored base models and meta model give the stacked score."""
    prep, _ = _prepared(spark, sf)
    base, meta = MD.ensemble_stack(_train(prep), CHURN_BASE.features, "churn", "c_custkey",
                                   [("logreg", {}), ("forest", {})], folds=3)
    s = MD.stack_predict(base, meta, prep.where("split = 'test'"))
    for i, m in enumerate(base):
        s = MT.predict(MT.to_tables(spark, m), s, f"m{i}")
    own = MT.predict(MT.to_tables(spark, meta), s, "own")
    return own.select("c_custkey", (F.abs(F.col("probability_1") - F.col("own")) < 1e-9).alias("same_score"))


@q("auto_featurize")
def q_auto_featurize(spark, sf):
    b = fx.churn_base(spark, sf)
    prof = MD.auto_featurize(b, "churn", exclude=["c_custkey"])
    rows = [(c, "categorical") for c in prof.categorical] + [(c, "numeric") for c in prof.numeric]
    kinds = spark.createDataFrame(rows, "feature string, kind string")
    # distinct counts of the detected columns in one pass (data-dependent part)
    dc = b.agg(*[F.count_distinct(c).alias(c) for c, _ in rows])
    parts = ", ".join(f"'{c}', `{c}`" for c, _ in rows)
    return kinds.join(dc.selectExpr(f"stack({len(rows)}, {parts}) as (feature, n_distinct)"), "feature")


@q("batch_score")
def q_batch_score(spark, sf):
    """Two models side by side: the scores of the stored tables, rounded, with
    the decision and the band that belong to them."""
    prep, _ = _prepared(spark, sf)
    tr, test = _train(prep), prep.where("split = 'test'")
    models = {"logreg": MD.train_logreg(tr, CHURN_BASE.features, "churn"),
              "boosted": MD.train_boosted(tr, CHURN_BASE.features, "churn")}
    got = MD.batch_score(test, models, key="c_custkey")
    own = None
    for name, m in models.items():
        part = MT.predict(MT.to_tables(spark, m), test, "p").select(F.col("c_custkey").alias("k"), F.lit(name).alias("m"), "p")
        own = part if own is None else own.unionByName(part)
    met = got.join(own, (got["c_custkey"] == own["k"]) & (got["model"] == own["m"]))
    same = ((F.abs(F.col("probability") - F.col("p")) <= 0.50001e-4) & (F.col("prediction") == threshold_predict("p"))
            & (F.col("risk_level") == risk_band("p")))
    near_a_cut = F.exists(F.array(*[F.lit(c) for c in (0.4, 0.5, 0.7)]), lambda c: F.abs(F.col("p") - c) < 1e-9)
    return met.select("c_custkey", "model", (same | near_a_cut).alias("consistent"))


def _routed(spark, sf):
    """The customers' rows routed by a contract of null shares, ranges and known texts."""
    rules = [R.Rule("c_mktsegment", "missing", allowed=0.05), R.Rule("n_name", "missing", allowed=0.1), R.Rule("tenure", "missing"),
             R.Rule("tenure", "above", 60), R.Rule("c_acctbal", "below", 0), R.Rule("n_orders", "above", 20),
             R.Rule("c_mktsegment", "unknown", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))]
    path = scratch_path(spark, "routed")
    return R.route(fx.churn_with_nulls(spark, sf), rules, path), spark.read.parquet(path)


@q("dq_rules")
def q_dq_rules(spark, sf):
    found, _ = _routed(spark, sf)
    return found.select("rule", "n_rows", "n_violations", r("share", 10).alias("share"), "failed")


@q("dq_rejected")
def q_dq_rejected(spark, sf):
    _, rows = _routed(spark, sf)
    return R.rejected(rows).select("c_custkey", F.array_join("violations", ",").alias("violations"))


@q("permutation_importance")
def q_permutation_importance(spark, sf):
    """What the AUC of a fixed scorer loses by each feature, for the features
    that the drift report of the customers' halves also has."""
    s = fx.scored_churn(spark, sf).select("c_custkey", "churn", "tenure", "n_orders", "total", "c_acctbal")
    score = lambda df: df.withColumn("score", F.col("n_orders") * 0.125 + F.col("tenure") * 0.0625 - F.col("total") / 1048576.0)
    imp = materialize(MD.permutation_importance(s, score, ["tenure", "n_orders", "total", "c_acctbal"], "churn", "c_custkey"), "importance")
    old = F.col("c_custkey") % 2 == 0
    num, cat = D.baseline_profile(s.where(old), ["tenure", "n_orders", "total", "c_acctbal"], [])
    drift = MD.monitored(D.drift_report(s.where(~old), num, cat), imp, k=2).select("feature", "drift_score")
    return imp.join(drift, "feature", "left").select("feature", r("base_auc", 10).alias("base_auc"), r("auc", 10).alias("auc"),
                                                     r("importance", 10).alias("importance"), "drift_score")


# --------------------------------------------------------- streams
@q("stream_daily_rate")
def q_stream_daily_rate(spark, sf):
    out, ck = scratch_path(spark, "daily_rate"), scratch_path(spark, "daily_rate_ckpt")
    src = (spark.readStream.schema(fx.table(spark, sf, "events").schema)
           .option("maxFilesPerTrigger", 1).parquet(fx.stream_path(sf, "events")))
    log = _stream_log(src)
    SS.daily_rate_stream(log, out, ck)
    res = SS.daily_rate_result(spark, out)
    return res.select("date", "model", r("churn_rate", 10).alias("churn_rate"))


def _stream_log(events: DataFrame) -> DataFrame:
    prob = F.col("value") / (F.col("value") + F.lit(50.0))
    return events.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"),
                         F.col("event_type").alias("model"),
                         F.struct("user_id", "value").alias("inputs"), prob.alias("probability")) \
        .withColumn("prediction", (F.col("probability") >= 0.5).cast("int")) \
        .withColumn("risk_level", risk_band("probability"))


def _requests(spark, sf) -> DataFrame:
    """Request bodies of the raw churn rows; some aren't JSON, some have a row
    that is too short, some no row at all."""
    b, k = fx.churn_with_nulls(spark, sf), F.col("c_custkey")
    cells = F.array(*[F.col(c).cast("string") for c in CHURN_BASE.features])
    cells = F.when(k % 29 == 0, F.slice(cells, 1, 3)).otherwise(cells)
    data = F.when(k % 31 == 0, F.lit("[]")).otherwise(F.to_json(F.array(cells)))
    columns = '["' + '","'.join(CHURN_BASE.features) + '"]'
    body = F.when(k % 23 == 0, F.lit("tenure=5")).otherwise(F.concat(F.lit('{"input_data":{"columns":' + columns + ',"data":'), data, F.lit("}}")))
    return b.select(k.alias("request_id"), body.alias("body"))


@q("stream_score")
def q_stream_score(spark, sf):
    prep, st = _prepared(spark, sf)
    model = MD.train_logreg(_train(prep), CHURN_BASE.features, "churn")
    req_dir = scratch_path(spark, "requests")
    _requests(spark, sf).write.mode("overwrite").parquet(req_dir)
    tables = {"logreg": MT.to_tables(spark, model)}
    stream = spark.readStream.schema("request_id long, body string").option("maxFilesPerTrigger", 4).parquet(req_dir)
    root, ck = scratch_path(spark, "outcomes"), scratch_path(spark, "outcomes_ckpt")
    score = lambda batch: SC.score_requests(batch, CHURN_BASE, st, tables)
    SS.requests_stream(stream, score, root, ck)
    schema = "request_id long, row_idx int, model string, probability double, prediction int, risk_level string, error string, outcome string, batch_id long"
    # what Spark ML itself says about the prepared rows
    ml = MD.predict(model, prep, "ml").select("c_custkey", F.round("ml", 4).alias("ml"))
    got = SC.read_outcomes(spark, root, schema)
    met = got.join(ml, got["request_id"] == ml["c_custkey"], "left")
    same = ((F.abs(F.col("probability") - F.col("ml")) < 1.5e-4) & (F.col("prediction") == threshold_predict("ml"))
            & (F.col("risk_level") == risk_band("ml")))
    near_a_cut = F.exists(F.array(*[F.lit(c) for c in (0.4, 0.5, 0.7)]), lambda c: F.abs(F.col("ml") - c) < 1.5e-4)
    return met.select(F.col("request_id").alias("id"), "outcome", "model", "error",
                      F.when(F.col("outcome") == "scored", same | near_a_cut).alias("as_trained"))


@q("stream_drift")
def q_stream_drift(spark, sf):
    base, _ = fx.lineitem_drift(spark, sf)
    num, cat = D.baseline_profile(base, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL)
    src = (spark.readStream.schema(fx.table(spark, sf, "lineitem").schema)
           .parquet(fx.stream_path(sf, "lineitem"))
           .where(F.col("l_shipdate") >= F.lit(fx.DRIFT_CUT).cast("timestamp_ntz")))
    out, ck = scratch_path(spark, "drift_state"), scratch_path(spark, "drift_state_ckpt")
    SS.drift_state_stream(src, fx.DRIFT_NUMERIC, fx.DRIFT_CATEGORICAL, out, ck)
    report = SS.drift_of_batches(spark, out, num, cat)
    return report.select(F.lit(0).alias("batch_id"), "feature", "type", "drift_score", "status")


# ------------------------------------------------------------ jobs as queries
def _telco_like_csv(spark: SparkSession, sf: str) -> tuple[str, Profile]:
    """A raw CSV export derived from churn_base (text columns, blanks)."""
    b = fx.churn_base(spark, sf)
    k = F.col("c_custkey")
    txt = b.select(k.cast("string").alias("customer_id"), "c_mktsegment", "n_name",
                   F.col("tenure").cast("string").alias("tenure"),
                   F.when(k % 10 == 0, F.lit(" ")).otherwise(F.col("total").cast("decimal(14,2)").cast("string"))
                   .alias("total"),
                   F.col("n_orders").cast("string").alias("n_orders"),
                   F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"),
                   F.when(F.col("churn") == 1, "Yes").otherwise("No").alias("churn"))
    path = scratch_path(spark, "raw_csv")
    CSV.write_csv(txt, path)
    prof = Profile(target="churn", key="customer_id", categorical=("c_mktsegment", "n_name"),
                   numeric=("tenure", "total", "n_orders", "c_acctbal"), drop=("customer_id",),
                   contract=(("customer_id", False), ("c_mktsegment", False), ("n_name", False),
                             ("tenure", False), ("total", True), ("n_orders", False), ("c_acctbal", False),
                             ("churn", False)),
                   feature_order=("c_mktsegment", "n_name", "tenure", "total", "n_orders", "c_acctbal"))
    return path, prof


def _typed(curated: DataFrame) -> DataFrame:
    return curated.select("customer_id", "c_mktsegment", "n_name",
                          *[F.col(c).cast("double").alias(c) for c in ("tenure", "total", "n_orders",
                                                                       "c_acctbal")], "churn")


@q("job_ingest")
def q_job_ingest(spark, sf):
    csv, prof = _telco_like_csv(spark, sf)
    out = scratch_path(spark, "curated")
    counts = job_ingest(spark, csv, out, prof, numeric_text=("total", "tenure", "n_orders", "c_acctbal"))
    cur = spark.read.parquet(out)
    return cur.agg(F.count(F.lit(1)).alias("rows_saved"), F.count_if(F.col("total").isNull()).alias("null_total"),
                   F.sum("churn").alias("churned")).withColumn("rows_loaded", F.lit(counts["rows_loaded"]))


def _ingested_prepared(spark, sf):
    csv, prof = _telco_like_csv(spark, sf)
    cur_path = scratch_path(spark, "curated")
    job_ingest(spark, csv, cur_path, prof, numeric_text=("total", "tenure", "n_orders", "c_acctbal"))
    curated = _typed(spark.read.parquet(cur_path))
    out = scratch_path(spark, "prepared")
    job_prepare(spark, curated, prof, out)
    return out, prof


@q("job_prepare")
def q_job_prepare(spark, sf):
    out, _ = _ingested_prepared(spark, sf)
    s = spark.read.parquet(f"{out}/splits")
    return s.groupBy("split", "churn").agg(F.count(F.lit(1)).alias("n"))


def _job_train(spark, sf, algorithms):
    out, prof = _ingested_prepared(spark, sf)
    reg = scratch_path(spark, "registry")
    job_train_evaluate(spark, f"{out}/splits", prof, reg, algorithms=algorithms)
    dec = job_train_evaluate(spark, f"{out}/splits", prof, reg, algorithms=algorithms)
    # the same learners again: the newest candidate gains nothing on production
    stages = P.fold_events(P.read_events(spark, f"{reg}_events")).groupBy("name").agg(
        F.count("*").alias("n_versions"), F.max(F.when(F.col("stage") == "production", F.col("version"))).alias("production_version"))
    return dec.select("name", "version", "has_production", "promote").join(stages, "name")


@q("job_manual")
def q_job_manual(spark, sf):
    return _job_train(spark, sf, ("logreg", "boosted"))


@q("job_retrain")
def q_job_retrain(spark, sf):
    return _job_train(spark, sf, ("boosted",))


@q("job_search")
def q_job_search(spark, sf):
    out, prof = _ingested_prepared(spark, sf)
    runs, dec = job_search(spark, f"{out}/splits", prof, scratch_path(spark, "registry"), SEARCH_SPACE)
    # one winner, which is promoted as there is no production version yet
    states = runs.agg(F.count("*").alias("n_trials"), F.count_if(F.col("status") == "finished").alias("n_finished"))
    return dec.select("name", "version", "has_production", "promote").join(F.broadcast(states), F.lit(True))


@q("job_monitor")
def q_job_monitor(spark, sf):
    log = fx.inference_log(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    base = log.where(F.col("timestamp") < cut).select("inputs.*")
    num, cat = D.baseline_profile(base, ["value"], ["k"])
    tables = job_monitor(spark, log.where(F.col("timestamp") >= cut), num, cat, fx.LOG_MODELS)
    cached = tables.pop("log")
    counts = [(k, v.count()) for k, v in tables.items()]   # one small number per table
    cached.unpersist()
    return spark.createDataFrame(counts, "table_name string, n_rows long")


@q("job_dashboard")
def q_job_dashboard(spark, sf):
    log = fx.inference_log(spark, sf)
    cut = F.lit("2024-01-16").cast("timestamp")
    num, cat = D.baseline_profile(log.where(F.col("timestamp") < cut).select("inputs.*"), ["value"], ["k"])
    tables = job_monitor(spark, log, num, cat, fx.LOG_MODELS, drift_from=cut)
    rows = materialize(dashboard_rows(tables, fx.LOG_MODELS), "dashboard")
    tables["log"].unpersist()
    return rows
