"""Model training smoke tests (few trees): mechanics, never a minimum AUC."""

import inspect
import tempfile

import pytest
from pyspark.sql import functions as F

from churnspark import queries
from churnspark.operators import features as FE, models as MD, metrics as M
from churnspark.operators.split import stratified_split
from churnspark.plans import fixtures as fx, jobs
from churnspark.profile import CHURN_BASE
from conftest import SF0001

NUM, CAT = list(CHURN_BASE.numeric), list(CHURN_BASE.categorical)


def prepared(spark):
    s = stratified_split(fx.churn_base(spark, SF0001), "c_custkey", "churn")
    st = FE.fit_all(s.where("split = 'train'"), NUM, CAT)
    return FE.apply_all(s, st, CAT, NUM).cache()


def test_train_and_score(spark, tmp_dir):
    p = prepared(spark)
    tr, te = p.where("split = 'train'"), p.where("split = 'test'")
    lr = MD.train_logreg(tr, CHURN_BASE.features, "churn", max_iter=50)
    gbt = MD.train_boosted(tr, CHURN_BASE.features, "churn", trees=3, depth=2)
    scored = MD.batch_score(te, {"logreg": lr, "boosted": gbt}, key="c_custkey")
    assert scored.count() == 2 * te.count()
    r = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0
    m = M.metrics(MD.predict(lr, te), "churn", "probability_1").first()
    assert 0.0 <= m["roc_auc"] <= 1.0
    lr.write().overwrite().save(tmp_dir + "/m")
    from pyspark.ml import PipelineModel
    back = PipelineModel.load(tmp_dir + "/m")
    a = [r[-1] for r in MD.predict(lr, te).orderBy("c_custkey").collect()]
    b = [r[-1] for r in MD.predict(back, te).orderBy("c_custkey").collect()]
    assert a == b
    assert MD.eval_curve(gbt, p.where("split = 'val'"), "churn").count() == 3


def test_search_and_ensembles(spark):
    p = prepared(spark)
    tr, va = p.where("split = 'train'"), p.where("split = 'val'")
    space = (("logreg", {"C": 1.0}), ("forest", {"trees": 3, "depth": 3}))
    runs, trials = MD.model_search(tr, va, CHURN_BASE.features, "churn", space=space, parallelism=2)
    assert runs.count() == 2 and all(t.auc_weighted is not None for t in trials)
    v = MD.ensemble_vote([t.model for t in trials], va)
    assert v.count() == va.count()
    base, meta = MD.ensemble_stack(tr, CHURN_BASE.features, "churn", "c_custkey",
                                   [("logreg", {"max_iter": 20}), ("forest", {"trees": 3, "depth": 3})], folds=2)
    assert MD.stack_predict(base, meta, va).count() == va.count()
    prof = MD.auto_featurize(fx.churn_base(spark, SF0001), "churn", exclude=["c_custkey"])
    assert set(prof.categorical) == {"c_mktsegment", "n_name"}


class Fitted(Exception):
    pass


@pytest.fixture(scope="module")
def small(spark):
    return prepared(spark).withColumn("ts", F.lit(0))


@pytest.mark.parametrize("key,learners", [
    ("train_boosted", {"boosted"}), ("train_forest", {"forest"}), ("top_feature_importance", {"forest"}),
    ("model_search", {"boosted", "forest"}), ("ensemble_vote", {"forest"}), ("ensemble_stack", {"forest"}),
    ("batch_score", {"boosted"}), ("job_manual", {"boosted"}), ("job_retrain", {"boosted"}),
    ("job_search", {"boosted", "forest"}), ("sink_model", set()), ("stream_score", set())])
def test_registered_learners_use_the_operators_defaults(spark, small, monkeypatch, key, learners):
    """Which fits a query asks for; the tree fits themselves are not run."""
    seen, logreg = [], MD.train_logreg

    def recorder(name, fn):
        def call(*args, **kwargs):
            bound = inspect.signature(fn).bind(*args, **kwargs)
            bound.apply_defaults()
            seen.append((name, {k: bound.arguments[k] for k in ("trees", "depth", "max_iter") if k in bound.arguments}))
            if name != "logreg" or not learners:
                raise Fitted
            return logreg(*args, **{**kwargs, "max_iter": 1})
        return call
    for name in ("logreg", "boosted", "forest"):
        monkeypatch.setattr(MD, f"train_{name}", recorder(name, getattr(MD, f"train_{name}")))
    for module in (jobs, queries):
        monkeypatch.setattr(module, "_prepared", lambda spark, sf: (small, None))
    monkeypatch.setattr(jobs, "_ingested_prepared", lambda spark, sf: (written(small), CHURN_BASE))
    with pytest.raises(Fitted):
        queries.registry()[key](spark, SF0001)
    want = {"logreg": {"max_iter": 1000}, "boosted": {"trees": 300, "depth": 6}, "forest": {"trees": 300, "depth": 8}}
    assert learners <= {n for n, _ in seen} and seen and all(p == want[n] for n, p in seen)


def written(df):
    path = tempfile.mkdtemp(prefix="churnspark-test-")
    df.write.partitionBy("split").parquet(f"{path}/splits")
    return path


def test_forest_rows_are_dealt_to_all_cores(spark, monkeypatch):
    rows = spark.range(40).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(id % 2 AS INT) AS y").coalesce(1)

    def fit(_, data):
        raise Fitted(data.rdd.getNumPartitions(), data.count())
    monkeypatch.setattr(MD.Pipeline, "fit", fit)
    for task_rows, most_rows, parts in ((10, 500, 4), (1, 500, spark.sparkContext.defaultParallelism), (100, 500, 1), (10, 4, 10)):
        monkeypatch.setattr(MD, "TASK_ROWS", task_rows)
        monkeypatch.setattr(MD, "MOST_ROWS", most_rows)
        with pytest.raises(Fitted) as got:
            MD.train_forest(rows, ["a"], "y")
        assert got.value.args == (parts, 40)
