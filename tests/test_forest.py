"""The forest of histograms against plain loops and beside Spark ML's."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from churnspark.operators import booster as B, forest as FO, metrics as M, model_tables as MT, models as MD

WIDTHS, DEPTH, TREES = [3, 9, 20], 4, 5


def blocks(n, parts):
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, w, n) for w in WIDTHS]).astype(np.uint8)
    y = (((x[1] > 4) ^ (x[2] > 11)) | (rng.random(n) < 0.1)).astype(np.int8)
    whole = (x, y, np.where(y == 1, 1.5, 0.75).astype(np.float32), rng.integers(-2 ** 62, 2 ** 62, n))
    cut = np.array_split(np.arange(n), parts)
    return [tuple(v[..., own] for v in whole) for own in cut]


def grown(parts):
    own = blocks(700, parts)

    def level_splits(level, asked):
        sums = {}
        for b in own:
            for t, s in FO._task_sums(iter([b]), asked, level, max(WIDTHS), 42):
                sums[t] = sums.get(t, 0) + s
        return {t: FO.best_splits(s) for t, s in sums.items()}
    return FO.grow(level_splits, TREES, DEPTH, 3, 2, 42)


def gini(rows):
    w = [sum(r[2] for r in rows if r[1] == c) for c in (0, 1)]
    return 1 - (w[0] ** 2 + w[1] ** 2) / sum(w) ** 2, sum(w)


def test_trees_equal_those_of_plain_loops():
    feature, cut, gain, stats = grown(3)
    x, y, w, k = blocks(700, 1)[0]
    splits = 0
    for t in range(TREES):
        times = FO.DRAWS[(FO._hashes(k, t // FO.LANES, 42) >> np.uint64(16 * (t % FO.LANES)) & np.uint64(0xFFFF)).astype(np.int64)]
        held = {0: [(x[:, i], y[i], float(w[i]), i) for i in range(700) for _ in range(times[i])]}
        for level in range(DEPTH):
            draw, after = random.Random(f"42:{t}:{level}"), {}
            for n in sorted(held):
                rows = held[n]
                impurity, weight = gini(rows)
                assert [round(v / B.UNIT, 9) for v in stats[t, n, :2]] == [round(sum(r[2] for r in rows if r[1] == c), 9) for c in (0, 1)]
                assert stats[t, n, 2] == len(rows)
                if impurity == 0:
                    assert feature[t, n] == -1
                    continue
                best = (1e-12, None)
                for f in sorted(draw.sample(range(3), 2)):
                    for c in range(1, WIDTHS[f]):
                        left, right = [r for r in rows if r[0][f] < c], [r for r in rows if r[0][f] >= c]
                        if left and right:
                            (il, wl), (ir, wr) = gini(left), gini(right)
                            g = impurity - wl / weight * il - wr / weight * ir
                            if g > best[0] + 1e-12:
                                best = (g, (f, c, left, right))
                if best[1]:
                    f, c, left, right = best[1]
                    assert (feature[t, n], cut[t, n]) == (f, c) and abs(gain[t, n] - best[0]) < 1e-9
                    after[2 * n + 1], after[2 * n + 2] = left, right
                    splits += 1
                else:
                    assert feature[t, n] == -1
            held = after
    assert splits > 30
    for a, b in zip(grown(3), grown(1)):
        assert (a == b).all()


def test_rows_are_drawn_as_often_as_poisson_has_it():
    k = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 200_000)
    h = FO._hashes(k, 7, 42)
    lanes = [FO.DRAWS[(h >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64)] for i in range(FO.LANES)]
    for times in lanes:
        assert all(abs((times == n).mean() - math.exp(-1) / math.factorial(n)) < 0.005 for n in range(6))
    assert abs(np.corrcoef(lanes)[np.triu_indices(FO.LANES, 1)]).max() < 0.01


def test_leaves_that_say_the_same_are_merged():
    feature, _, _, stats = grown(1)
    before = (feature >= 0).sum()
    FO.prune(feature, stats)
    says = stats[..., 1] > stats[..., 0]
    assert (feature >= 0).sum() < before
    for t, n in zip(*np.nonzero(feature >= 0)):
        a, b = 2 * n + 1, 2 * n + 2
        assert feature[t, a] >= 0 or feature[t, b] >= 0 or says[t, a] != says[t, b]


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(3000).selectExpr("id AS k", "rand(1) AS a", "CAST(rand(2) * 6 AS INT) AS b", "rand(3) AS c",
                                        "CAST((rand(1) > 0.5) != (rand(2) > 0.5) OR rand(4) < 0.1 AS INT) AS y").cache()


def test_the_model_is_spark_mls_and_as_good(spark, data, tmp_dir):
    train, test, cols = data.where("k % 3 > 0"), data.where("k % 3 = 0"), ["a", "b", "c"]
    own = MD.train_forest(train, cols, "y", trees=20, depth=5)
    last = own.stages[-1]
    assert isinstance(last, RandomForestClassificationModel) and last.getNumTrees == 20 and abs(sum(last.featureImportances.toArray()) - 1) < 1e-9
    ml = Pipeline(stages=[MD.assembler(cols), RandomForestClassifier(labelCol="y", weightCol="w", numTrees=20, maxDepth=5, seed=42)]).fit(
        M.with_class_weight(train, "y", "w"))
    auc = [M.metrics(MD.predict(m, test), "y", "probability_1").first()["roc_auc"] for m in (own, ml)]
    assert auc[0] > auc[1] - 0.03 > 0.8
    assert MT.predict(MT.to_tables(spark, own), MD.predict(own, data, "ml"), "own").where("abs(ml - own) > 1e-12 OR own IS NULL").count() == 0
    again = MD.train_forest(train.repartition(5).orderBy(F.desc("a")), cols, "y", trees=20, depth=5)
    assert again.stages[-1].toDebugString.split("\n", 1)[1] == last.toDebugString.split("\n", 1)[1]


def test_labels_of_other_classes_and_missing_values_are_spark_mls(data):
    with pytest.raises(PySparkException, match="NaN"):
        MD.train_forest(data.withColumn("a", F.when(F.col("k") > 5, F.col("a"))), ["a", "b"], "y", trees=2, depth=2)
    three = MD.train_forest(data.withColumn("y", F.col("b") % 3), ["a", "b"], "y", trees=2, depth=2)
    assert three.stages[-1].numClasses == 3
