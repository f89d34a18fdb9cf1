"""Models as tables: weights of a linear model, nodes of a tree ensemble.

* ``meta``    one row: kind (``linear`` or ``trees``), link (``logit`` or
  ``mean``), base, factor, n_trees
* ``linear``  ``(feature, weight)``
* ``trees``   ``(tree, node, feature, threshold, left, right, value)``; nodes are
  numbered from 0 in every tree, a row goes left if its value is at most the
  threshold (null and NaN go left), leaves have no feature

A probability is 1 / (1 + exp(-(base + factor * sum))) for ``logit`` and
sum / n_trees for ``mean``.  Any engine can score the same tables.  Here the
nodes (the size of the model, never of the data) travel to the tasks as arrays,
and a batch of rows goes down tree after tree, a level at a time, so scoring is
a projection without a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.booster import BoostedModel
from churnspark.session import scratch_path, ship_package

META = "kind string, link string, base double, factor double, n_trees int"
LINEAR = "feature string, weight double"
TREES = "tree int, node int, feature string, threshold double, left int, right int, value double"
#: Rows times trees that are held at once.
CELLS = 1_000_000


@dataclass
class TableModel:
    meta: DataFrame
    terms: DataFrame

    def save(self, path: str) -> None:
        self.meta.write.mode("overwrite").parquet(f"{path}/meta")
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TableModel:
        return cls(spark.read.parquet(f"{path}/meta"), spark.read.parquet(f"{path}/terms"))


def to_tables(spark: SparkSession, model) -> TableModel:
    """Tables of a fitted logistic regression, forest or booster."""
    if isinstance(model, TableModel):
        return model
    if isinstance(model, BoostedModel):
        return TableModel(spark.createDataFrame([("trees", "logit", 0.0, 1.0, len(model.trees))], META),
                          spark.createDataFrame(model.node_rows(), TREES))
    features, last = model.stages[0].getInputCols(), model.stages[-1]
    if hasattr(last, "coefficients"):
        return TableModel(spark.createDataFrame([("linear", "logit", float(last.intercept), 1.0, 0)], META),
                          spark.createDataFrame([(f, float(w)) for f, w in zip(features, last.coefficients)], LINEAR))
    return _forest_tables(spark, last, features)


def _forest_tables(spark: SparkSession, forest, features: Sequence[str]) -> TableModel:
    """From the nodes that Spark ML writes: the share of the positive class."""
    path = scratch_path(spark, "forest")
    forest.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    n = saved.select("nodeData.*", F.col("treeID").cast("int").alias("tree")) if "nodeData" in saved.columns else saved.withColumnRenamed("treeID", "tree")
    stats, split = F.col("impurityStats"), F.col("split")
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(f) for f in features])
    nodes = n.select(
        "tree", F.col("id").cast("int").alias("node"), F.when(inner, F.get(names, split["featureIndex"])).alias("feature"),
        F.when(inner, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, F.col("leftChild").cast("int")).alias("left"), F.when(inner, F.col("rightChild").cast("int")).alias("right"),
        F.when(inner, F.lit(0.0)).otherwise(F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)).alias("value"))
    return TableModel(spark.createDataFrame([("trees", "mean", 0.0, 1.0, int(forest.getNumTrees))], META), nodes)


def _linear_sum(terms: DataFrame, df: DataFrame) -> Column:
    rows = terms.collect()  # one row per feature
    total = F.lit(0.0)
    for r in sorted(rows, key=lambda r: r["feature"]):
        total = total + F.col(f"`{r['feature']}`").cast("double") * F.lit(r["weight"])
    return total


@dataclass
class Flat:
    """All nodes of a tree model in one array each; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray  # left and right of every node
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The value of every tree (column) for the given rows; a tree at a time, as one's nodes fit a core's cache."""
        n, row, ends = len(x), np.arange(len(x)), np.r_[self.roots[1:], len(self.feature)]
        values, out = np.ascontiguousarray(x.T).reshape(-1), np.empty((len(self.roots), len(x)))
        for t, (a, z) in enumerate(zip(self.roots, ends)):
            feature, threshold, child, at = self.feature[a:z] * n, self.threshold[a:z], self.child[2 * a:2 * z] - a, np.zeros(n, np.int64)
            for _ in range(self.depth):
                cell = feature.take(at)
                cell += row
                at = child.take(2 * at + (values.take(cell) > threshold.take(at)))  # null and NaN aren't greater
            out[t] = self.value[a:z].take(at)
        return out.T

    def running(self, x: pa.Array) -> Iterator[np.ndarray]:
        """Sums of the first 1, 2, ... trees of an array column's rows, by parts of the rows."""
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        size = max(1, CELLS // max(1, len(self.roots)))
        for i in range(0, len(values), size):
            yield np.cumsum(self.leaves(values[i:i + size]), axis=1)


def flat(model: TableModel, names: Sequence[str]) -> Flat:
    """The nodes of the model (its size, never the data's) for rows of the columns ``names``."""
    rows = model.terms.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    tree, node = (rows[c].to_numpy().astype(np.int64) for c in ("tree", "node"))
    number, own = {n: i for i, n in enumerate(names)}, np.arange(len(tree))
    inner = ~rows["feature"].is_null().to_numpy()
    key = tree << 32 | node
    side = lambda c: np.where(inner, np.searchsorted(key, tree << 32 | rows[c].fill_null(0).to_numpy().astype(np.int64)), own)
    child = np.stack([side("left"), side("right")], axis=1)
    roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else own
    depth, level = 0, roots
    while len(level := np.unique(child[level[inner[level]]])):
        depth += 1
    return Flat(np.array([number.get(f, 0) for f in rows["feature"].to_pylist()], np.int64), np.where(inner, rows["threshold"].fill_null(0.0).to_numpy(), np.inf),
                child.ravel(), rows["value"].to_numpy(), roots, depth)


def _values(df: DataFrame, names: Sequence[str]) -> Column:
    ship_package(df.sparkSession)
    return F.array(*[F.col(f"`{c}`").cast("double") for c in names])


def _total(trees: Flat):
    @F.arrow_udf("double")
    def total(x: pa.Array) -> pa.Array:
        parts = [r[:, -1] if len(trees.roots) else np.zeros(len(r)) for r in trees.running(x)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))
    return total


def _running(trees: Flat):
    @F.arrow_udf("array<double>")
    def running(x: pa.Array) -> pa.Array:
        rows, n = list(trees.running(x)), len(trees.roots)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n, pa.int32()), pa.array(np.concatenate(rows).ravel() if rows else np.zeros(0)))
    return running


def _names(model: TableModel, df: DataFrame) -> list[str]:
    """The features of a tree model in a fixed order (one column at least)."""
    found = model.terms.where("feature IS NOT NULL").select("feature").distinct().collect()
    return sorted(r[0] for r in found) or [df.columns[0]]


def predict(model: TableModel, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """``df`` with the probability of the positive class."""
    meta = model.meta.first()  # one row
    if meta["kind"] == "linear":
        total = _linear_sum(model.terms, df)
    else:
        names = _names(model, df)
        total = _total(flat(model, names))(_values(df, names))
    if meta["link"] == "mean":
        p = total / F.lit(float(meta["n_trees"]))
    else:
        p = 1 / (1 + F.exp(-(F.lit(meta["base"]) + F.lit(meta["factor"]) * total)))
    return df.select("*", p.alias(out))


def losses(model: TableModel, df: DataFrame, label: str) -> DataFrame:
    """(round, loss): mean log loss of the first 1, 2, ... trees, in one pass."""
    meta = model.meta.first()
    names = _names(model, df)
    y = F.col(f"`{label}`").cast("double")
    rows = df.select(y.alias("y"), F.posexplode(_running(flat(model, names))(_values(df, names))).alias("round", "margin")).where("y IS NOT NULL")
    z = F.lit(meta["base"]) + F.lit(meta["factor"]) * F.col("margin")
    # log(1 + exp(-z)) or log(1 + exp(z)), without overflow
    s = F.when(F.col("y") == 1, -z).otherwise(z)
    loss = F.greatest(s, F.lit(0.0)) + F.log1p(F.exp(-F.abs(s)))
    return rows.groupBy((F.col("round") + 1).alias("round")).agg(F.avg(loss).alias("loss"))
