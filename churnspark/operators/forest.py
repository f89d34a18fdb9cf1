"""Random forest of histograms for a 0/1 label: Spark ML's learner and model,
with sums that are made in numpy.

All trees are grown together, level by level, as Spark ML's ``RandomForestClassifier``
does: rows are drawn with replacement (Poisson 1) for every tree, a node looks at
the root of the number of features (drawn per node; a single tree at all), takes
the split with the greatest gain in Gini impurity over at most ``maxBins`` bins a
feature, and siblings that predict the same class are merged at the end.

The rows are held as numpy blocks.  A level is ONE job: every task lets its drawn
rows go down each tree and sums up weights and rows by (node, feature, bin,
class); the sums of a tree meet in one task, which chooses its splits.  Only these
reach the driver, a few numbers a node.  Nothing is kept per row and tree.

Draws come from a hash of all columns of a row, so rows that are equal in every
column, key included, are drawn together.  Weights count in units of 2^-20.  The
result is written as Spark ML stores it and read back as its own model.
"""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.operators import booster as B
from churnspark.session import materialize, scratch_path, ship_package

#: Draws of Poisson(1) by 16 bits of a hash.
DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)
LANES = 4
#: Rows below which a task isn't divided, and rows it holds at most.
TASK_ROWS, MOST_ROWS = 5_000, 1_000_000


def cut_points(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Lower ends of all bins but the first: all values of a feature that has few,
    else quantiles from a sketch of all rows."""
    x = [F.col(f"`{f}`").cast("double") for f in features]
    found = rows.agg(*[F.percentile_approx(c, [i / bins for i in range(bins)], 10_000).alias(f"q{i}") for i, c in enumerate(x)],
                     *[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(len(x)) if found[f"n{i}"] <= 2 * bins]
    met = {i: set() for i in few}
    if few:  # at most about twice as many values as bins
        sets = rows.agg(*[F.collect_set(x[i]).alias(f"v{i}") for i in few]).first()
        met = {i: set(sets[f"v{i}"]) for i in few}
    return [sorted(met[i] if i in met and len(met[i]) <= bins else set(found[f"q{i}"] or ()))[1:] for i in range(len(x))]


def _hashes(k: np.ndarray, number: int, seed: int) -> np.ndarray:
    """64 new bits of every key hash, for ``LANES`` trees."""
    with np.errstate(over="ignore"):
        z = k.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (number + 1) + 0xD1B54A32D192ED03 * seed) & (2 ** 64 - 1))
        z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def _block_sums(block: tuple[np.ndarray, ...], drawn: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int, slot: np.ndarray,
                chosen: np.ndarray, bins: int) -> np.ndarray:
    """(weight of class 0, of class 1, rows) by looked-at feature, open node and
    bin, over a block's rows, each as often as it is drawn.  ``feature`` and
    ``cut`` are the tree's nodes, ``slot`` numbers the open ones, ``chosen`` are
    their features (a row for each node)."""
    x, y, w = block[:3]
    n, flat, inner, nodes, rows = x.shape[1], x.reshape(-1), feature >= 0, np.arange(len(feature)), np.flatnonzero(drawn)
    start, below, cut, at = np.where(inner, feature, 0) * n, np.where(inner, 2 * nodes + 1, nodes), np.where(inner, cut, 2 ** 31 - 1).astype(np.int32), np.zeros(len(rows), np.int64)
    for _ in range(level):
        value = start.take(at)
        value += rows
        at = below.take(at) + (flat.take(value) >= cut.take(at))
    own = slot.take(at)
    met = np.flatnonzero(own >= 0)
    own, rows = own.take(met), rows.take(met)
    times, label, parts = drawn.take(rows).astype(float), y.take(rows).astype(np.int64), []
    weight = np.rint(w.take(rows) * float(B.UNIT)) * times
    for j in range(chosen.shape[1]):
        value = (chosen[:, j] * n).take(own)
        value += rows
        cell = own * bins
        cell += flat.take(value)
        size = len(chosen) * bins
        raw = np.bincount(cell, times, size)
        cell += label * size
        parts.append([*np.bincount(cell, weight, 2 * size).reshape(2, -1), raw])
    return np.array(parts).astype(np.int64).reshape(len(parts), 3, len(chosen), bins).transpose(1, 0, 2, 3)


def _task_sums(blocks: Iterator, trees: Sequence[tuple], level: int, bins: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of a task's rows, tree by tree; ``trees`` has number, nodes and open nodes of each."""
    blocks, bits, of = list(blocks), [], None
    for number, feature, cut, slot, chosen in trees:
        if of != number // LANES:
            of = number // LANES
            bits = [_hashes(b[3], of, seed) for b in blocks]
        lane = np.uint64(16 * (number % LANES))
        yield number, sum(_block_sums(b, DRAWS[(h >> lane & np.uint64(0xFFFF)).view(np.int64)], feature, cut, level, slot, chosen, bins)
                          for b, h in zip(blocks, bits))


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, 1 - (a * a + b * b) / (n * n), 0.0)


def best_splits(sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every node, of its sums by (what, feature, node, bin): number of the
    feature or -1, first bin that goes right, gain, sums of all rows and of those
    that go left.  On ties the first feature and bin."""
    left, whole = np.cumsum(sums, axis=3)[..., :-1], sums.sum(axis=3)
    total = whole[:, 0]
    if not left.shape[3]:
        none = np.zeros(total.shape[1], np.int64)
        return none - 1, none, none - 1.0, total, total
    a, b = (v / B.UNIT for v in left[:2])
    A, Z = (v[..., None] / B.UNIT for v in whole[:2])
    with np.errstate(divide="ignore", invalid="ignore"):
        share = (a + b) / (A + Z)
        gain = _gini(A, Z) - share * _gini(a, b) - (1 - share) * _gini(A - a, Z - b)
    gain = np.where((left[2] > 0) & (left[2] < whole[2][..., None]) & ~np.isnan(gain), gain, -1.0).transpose(1, 0, 2)
    nodes, at = np.arange(gain.shape[0]), gain.reshape(len(gain), -1).argmax(axis=1)
    j, k = at // gain.shape[2], at % gain.shape[2]
    top = gain[nodes, j, k]
    return np.where(top > 0, j, -1), k + 1, top, total, left[:, j, nodes, k]


def grow(level_splits, trees: int, depth: int, n_features: int, looked_at: int, seed: int) -> tuple[np.ndarray, ...]:
    """Nodes of all trees in heap order: feature (-1 in leaves), cut, gain and
    (weight of class 0, of class 1, rows).  ``level_splits(level, open trees)``
    gives :func:`best_splits` by number of tree."""
    size = 2 ** (depth + 1) - 1
    feature, cut, gain = np.full((trees, size), -1), np.zeros((trees, size), np.int64), np.full((trees, size), -1.0)
    stats, is_open = np.zeros((trees, size, 3), np.int64), np.zeros((trees, size), bool)
    is_open[:, 0] = True
    for level in range(depth + 1):
        asked = []
        for t in range(trees):
            nodes = np.flatnonzero(is_open[t])
            if len(nodes):
                draw, slot = random.Random(f"{seed}:{t}:{level}"), np.full(size, -1)
                slot[nodes] = np.arange(len(nodes))
                asked.append((t, feature[t], cut[t], slot, np.array([sorted(draw.sample(range(n_features), looked_at)) for _ in nodes])))
        if not asked or level == max(depth, 1):
            break
        is_open[:] = False
        found = level_splits(level, asked)
        for t, _, _, slot, chosen in asked:
            j, k, g, total, left = found[t]
            nodes = np.flatnonzero(slot >= 0)
            stats[t, nodes] = total.T
            own = np.flatnonzero(j >= 0) if depth else []
            for i in own:
                n = nodes[i]
                feature[t, n], cut[t, n], gain[t, n] = chosen[i, j[i]], k[i], g[i]
                for child, s in ((2 * n + 1, left[:, i]), (2 * n + 2, total[:, i] - left[:, i])):
                    stats[t, child] = s
                    is_open[t, child] = level + 1 < depth and s[0] > 0 and s[1] > 0
    return feature, cut, gain, stats


def prune(feature: np.ndarray, stats: np.ndarray) -> None:
    """Merges, from the last level on, two leaves that predict the same class."""
    says = stats[..., 1] > stats[..., 0]
    for n in range(feature.shape[1] // 2 - 1, -1, -1):
        a, b = 2 * n + 1, 2 * n + 2
        feature[(feature[:, n] >= 0) & (feature[:, a] < 0) & (feature[:, b] < 0) & (says[:, a] == says[:, b]), n] = -1


def _node_rows(feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, stats: np.ndarray, cuts: list[list[float]]) -> pa.Table:
    """The nodes as Spark ML numbers and stores them (depth first)."""
    weights = stats[..., :2] / B.UNIT
    impurity, out = _gini(weights[..., 0], weights[..., 1]), []
    for t in range(len(feature)):
        def add(n: int) -> int:
            number, f = len(out) - base, int(feature[t, n])
            out.append(node := dict(id=number, prediction=float(weights[t, n, 1] > weights[t, n, 0]), impurity=float(impurity[t, n]),
                                    impurityStats=weights[t, n].tolist(), rawCount=int(stats[t, n, 2]), gain=-1.0, leftChild=-1, rightChild=-1,
                                    split=dict(featureIndex=-1, leftCategoriesOrThreshold=[], numCategories=-1)))
            if f >= 0:
                threshold = float(np.nextafter(cuts[f][cut[t, n] - 1], -math.inf))
                node["gain"], node["split"] = float(gain[t, n]), dict(featureIndex=f, leftCategoriesOrThreshold=[threshold], numCategories=-1)
                node["leftChild"], node["rightChild"] = add(2 * n + 1), add(2 * n + 2)
            return number
        base = len(out)
        add(0)
        for node in out[base:]:
            node["tree"] = t
    split = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
    data = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                      ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", split)])
    return pa.table({"treeID": pa.array([v.pop("tree") for v in out], pa.int32()), "nodeData": pa.array(out, data)})


def _as_spark_ml(data: DataFrame, forest: RandomForestClassifier, n_features: int, nodes: pa.Table) -> RandomForestClassificationModel:
    """The model of these nodes, by way of the files in which Spark ML stores one."""
    spark, path = data.sparkSession, scratch_path(data.sparkSession, "forest_model")
    of_forest = ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")
    params = [{p.name: v for p, v in found.items()} for found in (forest._paramMap, forest._defaultParamMap)]

    def meta(kind: str, uid: str, leave_out: Sequence[str] = (), **more) -> str:
        own = [{k: v for k, v in found.items() if k not in leave_out} for found in params]
        return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": own[0], "defaultParamMap": own[1], "numFeatures": n_features, "numClasses": 2, **more})
    trees = forest.getNumTrees()
    spark.createDataFrame([(meta("RandomForestClassificationModel", forest.uid, numTrees=trees),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(t, meta("DecisionTreeClassificationModel", f"dtc_{forest.uid}_{t}", of_forest), 1.0) for t in range(trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def fit(data: DataFrame, features: Sequence[str], forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """``forest`` fitted to the rows; the columns ``features`` are its vector.  Labels
    other than two classes 0 and 1, and values that aren't finite (an error there),
    are left to Spark ML."""
    label, depth, bins, features = forest.getLabelCol(), forest.getMaxDepth(), forest.getMaxBins(), list(features)
    key = F.xxhash64(*[F.col(f"`{f.name}`") for f in data.schema.fields if isinstance(f.dataType, T.AtomicType)])
    rows = materialize(data.select(*[f"`{f}`" for f in features], label, forest.getWeightCol(), key.alias("__key")), "forest_task_rows")
    y, n = F.col(label).cast("double"), rows.count()
    finite = reduce(lambda a, b: a & b, [F.abs(F.col(f"`{f}`").cast("double")) < math.inf for f in features])
    met = rows.agg(F.count_if(y == 0), F.count_if(y == 1), F.count_if(finite)).first()
    if not (met[0] and met[1] and met[0] + met[1] == met[2] == n):
        return forest.fit(data)
    cuts, cores = cut_points(rows, features, bins), data.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, math.ceil(n / TASK_ROWS)), math.ceil(n / MOST_ROWS))
    binned = B._binned(rows, features, label, forest.getWeightCol(), "__key", cuts)
    ship_package(data.sparkSession)
    blocks = binned.selectExpr("y", "w", "x", "xxhash64(k) AS k").coalesce(parts).mapInArrow(B._pack(B.BLOCK_ROWS, bins), "block binary") \
        .rdd.map(B._unpack).persist(StorageLevel.MEMORY_AND_DISK)
    most = max(len(c) for c in cuts) + 1

    def level_splits(level: int, asked: list[tuple]) -> dict[int, tuple]:
        own = blocks.mapPartitions(partial(_task_sums, trees=asked, level=level, bins=most, seed=forest.getSeed()))
        return dict(own.reduceByKey(np.add, parts).mapValues(best_splits).collect())  # a few numbers a node
    trees = forest.getNumTrees()
    looked_at = len(features) if trees == 1 else math.ceil(math.sqrt(len(features)))
    try:
        feature, cut, gain, stats = grow(level_splits, trees, depth, len(features), looked_at, forest.getSeed())
    finally:
        blocks.unpersist()
    prune(feature, stats)
    return _as_spark_ml(data, forest, len(features), _node_rows(feature, cut, gain, stats, cuts))


class HistogramForest(Estimator):
    """Stage of a pipeline that fits ``forest`` by :func:`fit`."""

    def __init__(self, forest: RandomForestClassifier, features: Sequence[str]) -> None:
        super().__init__()
        self.forest, self.features = forest, list(features)

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        return fit(dataset, self.features, self.forest)
