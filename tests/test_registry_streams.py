"""Registry that only grows, search by halving, request and drift streams,
column kinds, NaN in drift and quality."""

import json

import pytest
from pyspark.sql import functions as F

from churnspark.operators import drift as D, features as FE, model_tables as MT, models as MD, promote as P, quality as Q
from churnspark.plans import jobs, scoring as SC
from churnspark.profile import Profile, RangeRule
from churnspark.streaming import streams as SS


def linear(spark, base):
    return MT.TableModel(spark.createDataFrame([("linear", "logit", base, 1.0, 0)], MT.META),
                         spark.createDataFrame([("x", 2.0), ("c", -1.0)], MT.LINEAR))


@pytest.fixture(scope="module")
def scored(spark):
    return spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 10 / 10.0).alias("x"), (F.col("id") % 3).cast("int").alias("c"),
                                   ((F.col("id") % 10 > 4) | (F.col("id") % 17 == 0)).cast("int").alias("y"))


@pytest.mark.parametrize("step", ["evaluate", "promote_transition", "write_eval_report"])
def test_a_crash_between_two_writes_loses_no_version(spark, scored, tmp_dir, monkeypatch, step):
    reg = tmp_dir + "/registry"
    first = jobs.register_and_promote(spark, [linear(spark, 0.0)], scored, "y", reg).first()
    assert first["promote"] and first["version"] == 1
    owner = P if step == "promote_transition" else jobs
    real = getattr(owner, step)

    def crash(*args, **kwargs):
        raise RuntimeError("lost")
    monkeypatch.setattr(owner, step, crash)
    with pytest.raises(RuntimeError):
        jobs.register_and_promote(spark, [linear(spark, 1.0)], scored, "y", reg)
    monkeypatch.setattr(owner, step, real)
    kept = {r["version"]: r["stage"] for r in P.fold_events(P.read_events(spark, reg + "_events")).collect()}
    assert kept[1] == "production" and set(kept) <= {1, 2}
    again = jobs.register_and_promote(spark, [linear(spark, 2.0)], scored, "y", reg).first()
    assert again["version"] == max(kept) + 1 and again["has_production"]
    after = {r["version"]: r["stage"] for r in spark.read.parquet(reg).collect()}
    assert after == kept | {again["version"]: "production" if again["promote"] else "candidate"}
    assert MT.TableModel.load(spark, f"{reg}_models/churn/1").meta.first()["base"] == 0.0


def test_halving_stops_trials_and_reruns_agree(spark, scored):
    space = (("logreg", {"max_iter": 5}), ("logreg", {"C": 1e-6, "max_iter": 5}), ("forest", {"trees": 2, "depth": 2}), ("boosted", {"trees": 2, "depth": 2}))
    val = scored.where("k % 4 = 0")
    runs = [MD.model_search(scored.where("k % 4 <> 0"), val, ["x", "c"], "y", space=space, parallelism=2)[0].collect() for _ in range(2)]
    assert runs[0] == runs[1]
    assert sorted(r["status"] for r in runs[0]) == ["finished"] * 2 + ["stopped"] * 2
    assert all(r["rung"] == (r["status"] == "finished") for r in runs[0])
    with pytest.raises(ValueError):
        MD.model_search(scored, val, ["x"], "y", space=space, max_trials=3)


def test_requests_are_scored_or_rejected_and_replay_changes_nothing(spark, tmp_dir):
    profile = Profile(target="y", key=None, categorical=("c",), numeric=("x",), feature_order=("x", "c"), rules=(RangeRule("x", 0, 5),))
    train = spark.createDataFrame([(0.0, "a"), (2.0, "b"), (4.0, None)], "x double, c string")
    state = FE.fit_all(train, ["x"], ["c"])
    models = {"m": linear(spark, 0.5), "n": linear(spark, -0.5)}
    bodies = [json.dumps({"data": [[1, "a"], [3, "zzz"]]}), json.dumps({"input_data": {"columns": ["c", "x"], "data": [["b", 9]]}}), "no json",
              None, json.dumps({"data": []}), json.dumps({"data": [[1]]}), json.dumps({"columns": ["c"], "data": [["a"]]}),
              json.dumps({"data": [["1d", None], [5, None]]}), json.dumps({"other": 1})]
    requests = spark.createDataFrame(list(enumerate(bodies)), "request_id long, body string")
    rows = SC.score_requests(requests, profile, state, models).collect()
    assert {r.request_id for r in rows} == set(range(len(bodies)))
    errors = {(r.request_id, r.row_idx): r.error for r in rows if r.outcome == "rejected"}
    assert errors == {(1, 0): "x:above", (2, None): "body is not a JSON object", (3, None): "body is not a JSON object", (4, None): "no data rows",
                      (5, None): "row width differs from columns", (6, 0): "x:missing", (7, 0): "x:missing", (8, None): "missing 'data'"}
    good = [(r.request_id, r.row_idx, r.model) for r in rows if r.outcome == "scored"]
    assert sorted(good) == [(0, 0, "m"), (0, 0, "n"), (0, 1, "m"), (0, 1, "n"), (7, 1, "m"), (7, 1, "n")]
    requests.repartition(3).write.parquet(tmp_dir + "/requests")
    stream = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(tmp_dir + "/requests")
    score = lambda b: SC.score_requests(b, profile, state, models)
    SS.requests_stream(stream, score, tmp_dir + "/out", tmp_dir + "/ckpt")
    schema = "request_id long, row_idx int, model string, probability double, prediction int, risk_level string, error string, outcome string, batch_id long"
    read = lambda: sorted(map(str, SC.read_outcomes(spark, tmp_dir + "/out", schema).drop("batch_id").collect()))
    once = read()
    assert len(once) == len(rows)
    batch = SC.read_outcomes(spark, tmp_dir + "/out", schema).where("batch_id = 0").select("request_id").distinct()
    SC.write_outcomes(score(requests.join(batch, "request_id")), tmp_dir + "/out", 0)  # the first batch again
    assert read() == once
    assert SC.read_outcomes(spark, tmp_dir + "/none", schema).count() == 0


def test_drift_of_any_span_of_batches(spark, tmp_dir):
    rows = [(float(i % 7) if i % 5 else float("nan"), "abc"[i * i % 3] if i % 4 else None, i // 30) for i in range(120)]
    df = spark.createDataFrame(rows, "x double, c string, part int")
    num, cat = D.baseline_profile(df.where("part = 0"), ["x"], ["c"])
    df.repartition(4, "part").write.parquet(tmp_dir + "/live")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(tmp_dir + "/live")
    SS.drift_state_stream(stream, ["x"], ["c"], tmp_dir + "/state", tmp_dir + "/ckpt")
    want = sorted(map(tuple, D.drift_report(df, num, cat).collect()))
    assert sorted(map(tuple, SS.drift_of_batches(spark, tmp_dir + "/state", num, cat).collect())) == want
    states = spark.read.parquet(tmp_dir + "/state")
    n = states.where("feature = 'x'").agg(F.sum("n")).first()[0]
    assert n == df.where("NOT isnan(x)").count()
    last = states.agg(F.max("batch_id")).first()[0]
    assert last >= 1 and SS.drift_of_batches(spark, tmp_dir + "/state", num, cat, first=1, last=last).count() == 2


def test_kinds_of_columns_are_found_and_applied(spark):
    df = spark.range(3000).select(
        F.col("id").alias("number"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("code"), (F.col("id") % 3).cast("int").alias("three"),
        (F.col("id") % 2).cast("int").alias("flag"), (F.col("id") % 90).cast("int").alias("age"), F.concat(F.lit("s"), (F.col("id") % 40).cast("string")).alias("city"),
        F.sqrt("id").alias("amount"), (F.col("id") % 5 == 0).alias("yes"), (F.col("id") % 2).cast("int").alias("y"))
    kinds = {r["feature"]: r["kind"] for r in MD.column_kinds(df, "y").collect()}
    assert kinds == {"number": "identifier", "code": "identifier", "three": "categorical", "flag": "numeric", "age": "numeric", "city": "categorical",
                     "amount": "numeric", "yes": "categorical"}
    profile = MD.auto_featurize(df, "y")
    assert set(profile.drop) == {"number", "code"}
    state = FE.fit_all(df, profile.numeric, profile.categorical)
    out = FE.apply_all(df, state, profile.categorical, profile.numeric)
    assert {r["three"] for r in out.select("three").distinct().collect()} == {0, 1, 2}


def test_nan_hides_neither_drift_nor_violations(spark):
    base = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,)], "x double")
    live = spark.createDataFrame([(90.0,), (80.0,), (float("nan"),)], "x double")
    js = D.js_divergence(base, live, ["x"]).first()
    assert js["js"] == pytest.approx(1.0) and js["status"] == "Drifted"
    q = Q.production_quality(base, live, ["x"], []).first()
    assert (q["n_out_of_range"], q["n_null"]) == (2, 1)


def test_permutation_hands_every_value_on(spark, scored):
    out = MD.permuted(scored, ["x", "c"], "k")
    assert out.where("permuted IS NULL").count() == 200
    for f, other in (("x", "c"), ("c", "x")):
        part = out.where(F.col("permuted") == f)
        assert sorted(r[0] for r in part.select(f).collect()) == sorted(r[0] for r in scored.select(f).collect())
        assert part.join(scored.select("k", F.col(other).alias("o")), "k").where(F.col(other) == F.col("o")).count() == 200
    imp = {r["feature"]: r["importance"] for r in MD.permutation_importance(
        scored, lambda d: d.withColumn("score", F.col("x")), ["x", "c"], "y", "k").collect()}
    assert imp["c"] == 0 and imp["x"] > 0.1


def test_rules_are_counted_and_routed_in_one_scan(spark, tmp_dir):
    from churnspark.operators import rules as R
    df = spark.createDataFrame([(1, 5.0, "Yes"), (2, float("nan"), "No"), (3, 99.0, "Maybe"), (4, -1.0, None), (5, None, "Yes")], "k int, x double, y string")
    rules = [R.Rule("x", "missing", allowed=0.3), R.Rule("x", "above", 10), R.Rule("x", "below", 0), R.Rule("y", "unknown", ("Yes", "No"))]
    got = {r["rule"]: (r["n_violations"], r["failed"]) for r in R.route(df, rules, tmp_dir + "/r").collect()}
    assert got == {"x:missing": (2, True), "x:above": (1, False), "x:below": (1, False), "y:unknown": (2, False)}
    back = spark.read.parquet(tmp_dir + "/r")
    assert {r["k"]: r["violations"] for r in R.rejected(back).collect()} == {3: ["x:above", "y:unknown"], 4: ["x:below", "y:unknown"]}
    assert {r["k"] for r in R.accepted(back).collect()} == {1, 2, 5}
    assert {r["share"] for r in R.route(df.limit(0), rules, tmp_dir + "/e").collect()} == {None}
    with pytest.raises(Q.DataQualityError, match="Missing columns"):
        R.route(df, [R.Rule("gone", "missing")], tmp_dir + "/x")


def test_ingest_lists_unmapped_targets_and_reads_once(spark, tmp_dir):
    text = "id,total,churn\n1,10.5,Yes\n2, ,No\n1,99,No\n3,7,Perhaps\n4,8,\n"
    with open(tmp_dir + "/raw.csv", "w") as f:
        f.write(text)
    profile = Profile(target="churn", key="id", categorical=(), numeric=("total",), contract=(("id", False), ("total", True), ("churn", True)))
    counts = jobs.job_ingest(spark, tmp_dir + "/raw.csv", tmp_dir + "/out", profile, numeric_text=("total",), rejected=tmp_dir + "/bad")
    assert counts == {"rows_loaded": 5, "rows_saved": 2, "rows_rejected": 2, "duplicates_dropped": 1}
    assert {(r["id"], r["total"], r["churn"]) for r in spark.read.parquet(tmp_dir + "/out").collect()} == {("1", 10.5, 1), ("2", None, 0)}
    assert {r["id"] for r in spark.read.parquet(tmp_dir + "/bad").collect()} == {"3", "4"}
    strict = Profile(target="churn", key="id", categorical=(), numeric=("total",), contract=(("id", False), ("total", True), ("churn", False)))
    with pytest.raises(Q.DataQualityError, match="null rate"):
        jobs.job_ingest(spark, tmp_dir + "/raw.csv", tmp_dir + "/never", strict, numeric_text=("total",))
    import os
    assert not os.path.exists(tmp_dir + "/never")
