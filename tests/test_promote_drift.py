"""Promotion decisions, registry transitions, drift scores."""

import math

import pytest
from pyspark.sql import functions as F

from churnspark.operators import drift as D, promote as P, quality as Q


def versions(spark):
    return spark.createDataFrame([
        ("a", 1, "archived", 0.5), ("a", 2, "production", 0.75), ("a", 3, "candidate", 0.7578125),
        ("b", 1, "production", 0.75), ("b", 2, "candidate", 0.765625),
        ("c", 1, "candidate", 0.6),
    ], "name string, version int, stage string, roc_auc double")


def decide(spark, threshold):
    v = versions(spark)
    cands = v.where("stage = 'candidate'").select("name", "version", "roc_auc")
    j = P.join_champion(cands, P.production_metrics(v).select("name", "roc_auc"))
    return P.promote_decision(j, threshold).join(cands.select("name", "version"), "name")


def test_promotion_gains(spark):
    d = {r["name"]: r for r in decide(spark, 0.01).collect()}
    assert d["a"]["auc_delta"] == 0.0078125 and not d["a"]["promote"]      # below
    assert d["b"]["auc_delta"] == 0.015625 and d["b"]["promote"]           # above
    assert d["c"]["promote"] and not d["c"]["has_production"] and d["c"]["prod_roc_auc"] == 0.0
    at = {r["name"]: r["promote"] for r in decide(spark, 0.0078125).collect()}
    assert at["a"] is False                                                 # exactly at: strict


def test_transition(spark):
    new = {(r["name"], r["version"]): r["stage"] for r in
           P.promote_transition(versions(spark), decide(spark, 0.01)).collect()}
    assert new[("a", 2)] == "production" and new[("a", 3)] == "candidate"   # not promoted
    assert new[("b", 1)] == "archived" and new[("b", 2)] == "production"
    assert new[("c", 1)] == "production"
    lv = {r["name"]: r["version"] for r in P.latest_version(versions(spark)).collect()}
    assert lv == {"a": 3, "b": 2, "c": 1}


def test_best_run(spark):
    runs = spark.createDataFrame([("r1", "e", 0.7), ("r2", "e", 0.9), ("r3", "e", 0.9), ("r4", "e", None)],
                                 "run_id string, experiment string, auc_weighted double")
    assert P.best_run(runs).first()["run_id"] == "r2"
    with pytest.raises(LookupError):
        P.best_run_or_raise(runs.where("run_id = 'r4'"))


def profiles(spark, base):
    return D.baseline_profile(base, ["x"], ["c"])


def test_psi_identity_and_defaults(spark):
    base = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "b"), (4.0, "c")], "x double, c string")
    num, cat = profiles(spark, base)
    rep = {r["feature"]: r for r in D.drift_report(base, num, cat).collect()}
    assert rep["c"]["drift_score"] == 0.0 and rep["x"]["drift_score"] == 0.0
    # live-only category ignored; missing live category uses 1e-4
    live = spark.createDataFrame([(1.0, "a"), (1.0, "z")], "x double, c string")
    terms = {r["value"]: r for r in D.psi_terms(live, cat).collect()}
    assert set(terms) == {"a", "b", "c"} and terms["b"]["live_p"] == 1e-4
    exp = sum((lp - bp) * math.log(lp / bp) for bp, lp in ((0.25, 0.5), (0.5, 1e-4), (0.25, 1e-4)))
    assert D.psi(live, cat).first()["drift_score"] == round(abs(exp), 4)


def test_mean_shift_cap_and_all_null(spark):
    base = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    num, _ = D.baseline_profile(base, ["x"], [])
    far = spark.createDataFrame([(100.0,)], "x double")
    assert D.mean_shift(far, num).first()["drift_score"] == 2.0
    empty = spark.createDataFrame([(None,)], "x double")
    assert D.mean_shift(empty, num).first()["drift_score"] is None
    assert D.mean_shift(far.withColumnRenamed("x", "y"), num).count() == 0     # missing feature skipped


def test_drift_ranking_nulls_last_and_status(spark):
    rep = spark.createDataFrame([("a", 0.1), ("b", None), ("c", 0.3), ("d", float("nan"))],
                                "feature string, drift_score double")
    rep = rep.withColumn("drift_score", F.when(F.isnan("drift_score"), None).otherwise(F.col("drift_score")))
    assert [r[0] for r in D.rank_drift(rep).collect()][:2] == ["c", "a"]
    s = D.drift_summary(rep).first()
    assert s["n_drifted"] == 1 and s["drifted"] == ["c"] and "c" in s["message"]


def test_js_bounds(spark):
    base = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(100)], "x double, c string")
    live = spark.createDataFrame([(float(i + 1000), "z") for i in range(50)], "x double, c string")
    same = {r["feature"]: r["js"] for r in D.js_divergence(base, base, ["x"], ["c"]).collect()}
    apart = {r["feature"]: r["js"] for r in D.js_divergence(base, live, ["x"], ["c"]).collect()}
    assert same == {"x": 0.0, "c": 0.0}
    assert apart["x"] == pytest.approx(1.0) and apart["c"] == pytest.approx(1.0)


def test_production_quality(spark):
    train = spark.createDataFrame([(1.0, "a"), (5.0, "b")], "x double, c string")
    live = spark.createDataFrame([(0.0, "a"), (3.0, "q"), (None, None)], "x double, c string")
    q = {r["feature"]: r for r in Q.production_quality(train, live, ["x"], ["c"]).collect()}
    assert q["x"]["n_out_of_range"] == 1 and q["x"]["n_null"] == 1
    assert q["c"]["n_out_of_range"] == 1 and not q["c"]["type_violation"]


def test_range_check(spark):
    from churnspark.profile import RangeRule
    df = spark.createDataFrame([(5, 1.0), (99, None), (-1, 2.0)], "tenure int, m double")
    rules = [RangeRule("tenure", 0, 72), RangeRule("m", 0, 200), RangeRule("gone", 0, 1)]
    got = [(r["violations"], r["accepted"]) for r in Q.range_check(df, rules).collect()]
    assert got == [("gone:missing", False), ("tenure:above,m:missing,gone:missing", False),
                   ("tenure:below,gone:missing", False)]
    ok = [r["accepted"] for r in Q.range_check(df, rules[:1]).collect()]
    assert ok == [True, False, False]


def test_request_codes_and_rules(spark):
    from churnspark.functions.scalar import request_codes
    from churnspark.profile import TELCO
    from telco import valid_row
    r = valid_row()
    r.pop("customerID"), r.pop("Churn")
    r.update(SeniorCitizen="No", tenure=12, MonthlyCharges=50.5, TotalCharges=606.0,
             PaymentMethod="Credit card (automatic)", OnlineSecurity="No internet service")
    bad = dict(r, Contract="Three year", tenure=99)
    cols = list(TELCO.feature_order)
    ddl = ", ".join(f"{c} {'double' if c in ('MonthlyCharges', 'TotalCharges') else 'int' if c == 'tenure' else 'string'}"
                    for c in cols)
    df = spark.createDataFrame([tuple(x[c] for c in cols) for x in (r, bad)], ddl)
    coded = request_codes(df)
    first = coded.first()
    assert (first["gender"], first["SeniorCitizen"], first["OnlineSecurity"], first["PaymentMethod"],
            first["Contract"], first["InternetService"]) == (1, 0, 0, 3, 1, 0)
    checked = [(x["violations"], x["accepted"]) for x in Q.range_check(coded, TELCO.rules).collect()]
    assert checked == [("", True), ("tenure:above,Contract:missing", False)]
