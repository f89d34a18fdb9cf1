"""Second-order boosting and models as tables, against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.operators import booster as B, model_tables as MT, models as MD


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), float(rng.randrange(6)), rng.random()
        out.append((i, a, b, None if i % 17 == 0 else c, int((a > 0.3) ^ (b > 3) or rng.random() < 0.1), 3.0 if i % 5 == 0 else 1.0))
    return out


def plain(data, s):
    """The same learner by loops over rows: list of {node: (feature, threshold) or leaf}."""
    unit = B.UNIT
    value = lambda v: -math.inf if v is None else v
    x = [[value(v) for v in r[1:4]] for r in data]
    y, w, m = [r[4] for r in data], [r[5] for r in data], [0.0] * len(data)
    cuts = [sorted({v[f] for v in x if v[f] > -math.inf})[1:] for f in range(3)]
    trees = []
    for _ in range(s.trees):
        p = [1 / (1 + math.exp(-v)) for v in m]
        q = lambda v: math.floor(abs(v) * unit + 0.5) * (1 if v >= 0 else -1)
        g, h = [q((a - b) * c) for a, b, c in zip(p, y, w)], [q(a * (1 - a) * c) for a, c in zip(p, w)]
        tree, at = {}, {0: list(range(len(data)))}
        for level in range(s.depth + 1):
            after = {}
            for n, own in at.items():
                G, H = sum(g[i] for i in own) / unit, sum(h[i] for i in own) / unit
                best = (1e-12, None)
                for f in range(3) if level < s.depth else ():
                    for c in cuts[f]:
                        left = [i for i in own if x[i][f] < c]
                        if not left or len(left) == len(own):
                            continue
                        gl, hl = sum(g[i] for i in left) / unit, sum(h[i] for i in left) / unit
                        if min(hl, H - hl) < s.min_hessian:
                            continue
                        gain = (gl ** 2 / (hl + s.l2) + (G - gl) ** 2 / (H - hl + s.l2) - G ** 2 / (H + s.l2)) / 2 - s.gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, c))
                if best[1]:
                    f, c = tree[n] = best[1]
                    after[2 * n + 1], after[2 * n + 2] = [i for i in own if x[i][f] < c], [i for i in own if x[i][f] >= c]
                else:
                    tree[n] = -G / (H + s.l2) * s.eta
                    for i in own:
                        m[i] += tree[n]
            at = after
        trees.append(tree)
    return trees, m


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows(220), "k long, a double, b double, c double, y int, w double")


@pytest.mark.parametrize("local", [0, 60, 50_000])
def test_trees_equal_those_of_plain_loops(spark, data, monkeypatch, local):
    monkeypatch.setattr(B, "LOCAL_ROWS", local)
    s = B.Settings(trees=3, depth=3, eta=0.3)
    model = B.train(data, ["a", "b", "c"], "y", s, weight="w", key="k")
    want, margins = plain(rows(220), s)
    for got, tree in zip(model.trees, want):
        for n, v in tree.items():
            if isinstance(v, tuple):
                assert (got.feature[n], model.cuts[got.feature[n]][got.cut[n] - 1]) == v
            else:
                assert got.feature[n] == -1 and abs(got.leaf[n] - v) < 1e-9
    scored = MT.predict(MT.to_tables(spark, model), data)
    p = {r.k: r.probability_1 for r in scored.collect()}
    assert all(abs(p[i] - 1 / (1 + math.exp(-v))) < 1e-9 for i, v in enumerate(margins))


def test_same_trees_on_any_partitioning_and_sampling(spark, data, monkeypatch):
    s = B.Settings(trees=3, depth=3, eta=0.1, subsample=0.7, colsample=0.6)
    a = B.train(data.repartition(7), ["a", "b", "c"], "y", s, weight="w", key="k")
    b = B.train(data.coalesce(1).orderBy(F.desc("a")), ["a", "b", "c"], "y", s, weight="w", key="k")
    assert a == b
    monkeypatch.setattr(B, "LOCAL_ROWS", 0)
    assert B.train(data, ["a", "b", "c"], "y", s, weight="w", key="k") == a
    used = [{f for f in t.feature if f >= 0} for t in a.trees]
    assert all(len(u) <= 2 for u in used)


def test_one_class_no_rows_and_no_split(spark, data):
    s = B.Settings(trees=2, depth=2, eta=0.5)
    one = B.train(data.withColumn("y", F.lit(1)), ["a"], "y", s)
    assert all(r.probability_1 > 0.5 for r in MT.predict(MT.to_tables(spark, one), data).collect())
    empty = B.train(data.limit(0), ["a"], "y", s)
    assert {r.probability_1 for r in MT.predict(MT.to_tables(spark, empty), data).collect()} == {0.5}


def test_tables_score_as_spark_ml_does(spark, data, tmp_dir):
    filled = data.fillna(0.5)
    for name, model in (("logreg", MD.train_logreg(filled, ["a", "b", "c"], "y", max_iter=30)),
                        ("forest", MD.train_forest(filled, ["a", "b", "c"], "y", trees=5, depth=4))):
        MT.to_tables(spark, model).save(f"{tmp_dir}/{name}")
        back = MT.TableModel.load(spark, f"{tmp_dir}/{name}")
        both = MT.predict(back, MD.predict(model, filled, "ml"), "own")
        assert both.where("abs(ml - own) > 1e-12 OR own IS NULL").count() == 0, name


def test_rows_go_down_all_trees_by_batches(spark, monkeypatch):
    nodes = [(0, 0, "a", 0.5, 1, 2, 0.0), (0, 1, None, None, None, None, 0.25), (0, 2, "b", -1.0, 3, 4, 0.0), (0, 3, None, None, None, None, 0.5),
             (0, 4, None, None, None, None, 1.0), (3, 0, None, None, None, None, 8.0), (7, 0, "b", 2.0, 5, 9, 0.0), (7, 5, None, None, None, None, 16.0),
             (7, 9, None, None, None, None, 32.0)]
    model = MT.TableModel(spark.createDataFrame([("trees", "mean", 0.0, 1.0, 1)], MT.META), spark.createDataFrame(nodes, MT.TREES))
    nan = float("nan")
    df = spark.createDataFrame([(0, 0.5, 0.0), (1, 0.6, -1.0), (2, 0.6, 3.0), (3, None, nan), (4, nan, None), (5, 9.0, None)], "k long, a double, b double")
    want = {0: 24.25, 1: 24.5, 2: 41.0, 3: 24.25, 4: 24.25, 5: 24.5}
    for cells in (1, 1_000_000):
        monkeypatch.setattr(MT, "CELLS", cells)
        scored = MT.predict(model, df)
        assert {r["k"]: r["probability_1"] for r in scored.collect()} == want
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambdafunction" not in plan


def test_losses_of_every_round(spark, data):
    model = MT.to_tables(spark, B.train(data, ["a", "b", "c"], "y", B.Settings(trees=4, depth=2, eta=0.5)))
    curve = {r["round"]: r["loss"] for r in MT.losses(model, data, "y").collect()}
    last = MT.predict(model, data).select(F.avg(-F.log(F.when(F.col("y") == 1, F.col("probability_1")).otherwise(1 - F.col("probability_1"))))).first()[0]
    assert sorted(curve) == [1, 2, 3, 4] and abs(curve[4] - last) < 1e-9 and curve[4] < curve[1]


def test_rows_are_drawn_as_spark_hashes_them(spark):
    s = B.Settings(trees=1, depth=1, eta=0.1, subsample=0.3, seed=7)
    for number in (0, 1, 299):
        got = spark.range(-500, 500).selectExpr("xxhash64(id) AS k").selectExpr(
            "xxhash64(k) AS h", f"pmod(xxhash64(k, {number}, 7), {B.UNIT}) < {int(0.3 * B.UNIT)} AS own").toPandas()
        assert (B._sampled(got["h"].to_numpy(), s, number) == got["own"].to_numpy()).all() and 200 < got["own"].sum() < 400


@pytest.mark.parametrize("local", [0, 50_000])
def test_a_tree_costs_no_more_jobs_than_levels(spark, data, monkeypatch, local):
    monkeypatch.setattr(B, "LOCAL_ROWS", local)
    monkeypatch.setattr(B, "KEEP", 1000)
    tracker, ran = spark.sparkContext.statusTracker(), {}
    for trees in (1, 11):
        spark.sparkContext.setJobGroup(f"trees-{local}-{trees}", "boosting")
        try:
            model = B.train(data, ["a", "b", "c"], "y", B.Settings(trees=trees, depth=3, eta=0.3), weight="w", key="k")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        ran[trees] = len(tracker.getJobIdsForGroup(f"trees-{local}-{trees}"))
        assert len(model.trees) == trees
    # ten more trees: a job each where one block holds all rows, else one for each level
    assert ran[11] - ran[1] <= (30 if local == 0 else 10)


def test_all_trees_of_one_task_are_one_job(spark, data):
    """The default holds the 62,987 training rows of six times sf0.1 in one task."""
    assert B.LOCAL_ROWS >= 62_987
    tracker, ran = spark.sparkContext.statusTracker(), {}
    for trees in (1, 11):
        spark.sparkContext.setJobGroup(f"task-{trees}", "boosting")
        try:
            B.train(data, ["a", "b", "c"], "y", B.Settings(trees=trees, depth=3, eta=0.3), weight="w", key="k")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        ran[trees] = len(tracker.getJobIdsForGroup(f"task-{trees}"))
    assert ran[11] == ran[1]


def test_a_level_sums_up_one_child_of_every_node(spark):
    """Half the nodes of a level are summed up, in columns that lie together in memory; the trees of the
    other half's differences and of margins carried over several trees are the loops' (tests above)."""
    rng, widths, s = np.random.default_rng(3), [7, 40, 200], B.Settings(trees=2, depth=5, eta=0.3)
    x = np.stack([rng.integers(0, w, 4000) for w in widths]).astype(np.uint8)
    y = ((x[1] > 20) ^ (x[2] % 7 > 3)).astype(np.int8)
    block = (x, y, np.ones(4000, np.int8), rng.integers(-2 ** 62, 2 ** 62, 4000), np.zeros(4000))
    drawn, asked = B._drawn(block, (), s, 0), []
    assert drawn[0].flags.c_contiguous

    def sums(tree, level, nodes, columns):
        asked.append(len(nodes))
        return B._level(drawn, tree, level, nodes, columns, widths)
    tree = B.grow(sums, 0, s, widths)
    assert sum(f >= 0 for f in tree.feature) > 5 and all(n <= max(1, 2 ** (level - 1)) for level, n in enumerate(asked))
    at = B._nodes(tree, s.depth, x)
    for n in np.unique(at):
        g, h = (v[at == n].sum() / B.UNIT for v in drawn[1:])
        assert abs(tree.leaf[n] + g / (h + s.l2) * s.eta) < 1e-12
    assert tree == next(B._task_trees([block], widths, s))
