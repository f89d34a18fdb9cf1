"""Second-order gradient boosting of histograms, for a 0/1 label.

The rows are held as numpy blocks of at most about ``BLOCK_ROWS`` rows, spread
over all tasks.  Every tree is grown level by level.  A level is ONE Spark job:
each block sums up gradient and hessian by (node, feature, bin) over its sampled
rows, and the sums are added up, by tasks first where there are many.  Only the
child with the smaller hessian is summed up, its sibling is what is left of their
parent.  2^(level - 1) x bins sums of at most ``DIRECT`` tasks, or of the root of
the number of tasks, reach the driver, where each node's split is chosen:

    gain = (GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)) / 2 - gamma
    leaf = -G / (H + l) * eta

At most ``LOCAL_ROWS`` rows (``LOCAL_CELLS`` rows times features) are the blocks
of one task, which chooses the splits by the same function: all trees are one job,
as so many rows take a core less time than the jobs would.

Gradients and hessians are whole multiples of 2^-20, so sums don't depend on the
order of rows: the trees are the same on any partitioning.  Rows are sampled per
tree by a hash of their key, columns per tree by a seeded draw.  The margin of
every row is carried over ``STEP`` trees at a time in persisted blocks whose
lineage is cut every ``KEEP`` trees by a checkpoint; the sampled rows of a tree
with their gradients and hessians are persisted for its levels.

Bins: at most ``bins`` per feature, cut at exact order statistics (all distinct
values where there are no more of them).  A row goes left if its value is less
than the threshold; null and NaN go left.
"""

from __future__ import annotations

import math
import pickle
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators import quantiles as qt
from churnspark.session import checkpoint_root, materialize, ship_package

#: Gradients and hessians are counted in units of 1 / UNIT.
UNIT = 1 << 20
#: Trees between two checkpoints (a multiple of STEP), and between two persisted margins.
KEEP, STEP = 24, 4
#: Rows of a block, and of a task's blocks.
BLOCK_ROWS, TASK_ROWS = 65_536, 1_000_000
#: Sums of so many tasks are added up by the driver; those of more by tasks first.
DIRECT = 64
#: Rows, and rows times features, of a training set that is one task's.
LOCAL_ROWS, LOCAL_CELLS = 1_000_000, 16_000_000


@dataclass(frozen=True)
class Settings:
    """Defaults of the original learner where it sets none."""

    trees: int
    depth: int
    eta: float
    subsample: float = 1.0
    colsample: float = 1.0
    l2: float = 1.0
    gamma: float = 0.0
    min_hessian: float = 1.0
    bins: int = 256
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: children of n are 2n+1 (left) and 2n+2."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    leaf: list[float] = field(default_factory=lambda: [0.0])


@dataclass
class BoostedModel:
    features: list[str]
    cuts: list[list[float]]
    trees: list[Tree]

    def node_rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, left, right, value); leaves have no
        feature.  Thresholds are the greatest values that go left."""
        out = []
        for t, tree in enumerate(self.trees):
            for n, (f, c, v) in enumerate(zip(tree.feature, tree.cut, tree.leaf)):
                if f >= 0:
                    out.append((t, n, self.features[f], float(np.nextafter(self.cuts[f][c - 1], -math.inf)), 2 * n + 1, 2 * n + 2, 0.0))
                else:
                    out.append((t, n, None, None, None, None, v))
        return out


def cut_points(train: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Lower ends of all bins but the first of every feature."""
    def ranks(n: int) -> list[int]:
        return [i * n // bins for i in range(bins)] if n > bins else list(range(n))
    found = qt.order_statistics(train, features, ranks).collect()  # features x bins numbers
    out = []
    for f in features:
        values = sorted({r["value"] for r in found if r["feature"] == f})
        out.append(values[1:])
    return out


def _binned(train: DataFrame, features: Sequence[str], label: str, weight: str | None, key: str | None,
            cuts: list[list[float]]) -> DataFrame:
    """(k, y, w, x): key hash, label, weight, bins."""
    k = F.xxhash64(key) if key else F.xxhash64(*[F.col(f).cast("double") for f in features], label)
    inf, n = float("inf"), len(features)
    src = train.select(k.alias("k"), F.col(label).cast("double").alias("y"),
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                       *[F.col(f).cast("double").alias(f"v{i}") for i, f in enumerate(features)]).where("y IS NOT NULL")
    used = [i for i in range(n) if cuts[i]]
    if used:
        src = Bucketizer(splitsArray=[[-inf, *cuts[i], inf] for i in used], inputCols=[f"v{i}" for i in used],
                         outputCols=[f"b{i}" for i in used], handleInvalid="keep").transform(src)
    known = lambda i: F.col(f"v{i}").isNotNull() & ~F.isnan(f"v{i}")
    x = F.array(*[F.when(known(i), F.col(f"b{i}").cast("int")).otherwise(0) if i in used else F.lit(0) for i in range(n)])
    return src.select("k", "y", "w", x.alias("x"))


def _blocks(binned: DataFrame, n_rows: int, bins: int) -> RDD:
    """Numpy blocks (x, y, w, k, m) of the rows: bins by column, labels, weights,
    key hashes, margins; as many tasks for every core."""
    cores = binned.sparkSession.sparkContext.defaultParallelism
    packed = binned.repartition(cores * math.ceil(n_rows / TASK_ROWS / cores)).mapInArrow(_pack(BLOCK_ROWS, bins), "block binary")
    return packed.rdd.map(_unpack)


def _sampled(k: np.ndarray, s: Settings, number: int) -> np.ndarray:
    """Whether tree ``number`` samples the rows: ``xxhash64(k, number, seed)``
    below the share, as Spark computes it, from ``xxhash64(k)``."""
    one, two, three, five = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = k.view(np.uint64)
    for v in (number, s.seed):
        h = h + five + np.uint64(4) ^ np.array([v & 0xFFFFFFFF], np.uint64) * one
        h = (h << np.uint64(23) | h >> np.uint64(41)) * two + three
        h = (h ^ h >> np.uint64(33)) * two
        h = (h ^ h >> np.uint64(29)) * three
        h = h ^ h >> np.uint64(32)
    return h % np.uint64(UNIT) < int(s.subsample * UNIT)


def _least(a: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest of three types."""
    with np.errstate(all="ignore"):
        return next((b for b in (a.astype(np.int8), a.astype(np.float32)) if (b == a).all()), a)


def _chunks(batches: Iterator[pa.RecordBatch], size: int, bins: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of a task in blocks of about ``size`` rows."""
    def block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        rows = pa.Table.from_batches(held)
        x = rows["x"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        return (np.ascontiguousarray(x.T, np.uint8 if bins <= 256 else np.int32), _least(rows["y"].to_numpy()), _least(rows["w"].to_numpy()),
                rows["k"].to_numpy(), np.zeros(rows.num_rows))

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield block(held)
            held, n = [], 0
    if n:
        yield block(held)


def _pack(size: int, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _chunks(batches, size, bins):
            yield pa.record_batch({"block": pa.array([pickle.dumps(block, protocol=5)], pa.binary())})
    return run


def _unpack(row) -> tuple[np.ndarray, ...]:
    return pickle.loads(row["block"])


def _slopes(block: tuple[np.ndarray, ...], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the rows ``own`` in whole units."""
    y, w, m = (v.take(own) for v in (block[1], block[2], block[4]))
    with np.errstate(over="ignore"):
        p = 1 / (1 + np.exp(-m))

    def whole(v: np.ndarray) -> np.ndarray:
        v = np.copysign(np.floor(np.abs(v * UNIT) + 0.5), v)
        return v.astype(np.int64 if len(v) and np.abs(v).max() >= 2 ** 31 else np.int32)
    return whole((p - y) * w), whole(p * (1 - p) * w)


def _drawn(block: tuple[np.ndarray, ...], since: Sequence[Tree], s: Settings, number: int) -> tuple[np.ndarray, ...]:
    """Bins, gradients and hessians of the rows that tree ``number`` samples, after the trees ``since``."""
    block = _next(block, since, s.depth)
    own = np.flatnonzero(_sampled(block[3], s, number))
    return block[0].take(own, axis=1), *_slopes(block, own)  # by column in memory, as an index wouldn't leave it


def _step(tree: Tree, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The nodes a level below the nodes ``at`` (a leaf keeps its rows)."""
    feature = np.array(tree.feature)
    inner, n, nodes = feature >= 0, x.shape[1], np.arange(len(feature))
    value = np.where(inner, feature * n, 0).take(at)
    value += np.arange(n)
    right = x.reshape(-1).take(value) >= np.where(inner, tree.cut, 2 ** 31 - 1).astype(np.int32).take(at)  # no bin reaches a leaf's cut
    return np.where(inner, 2 * nodes + 1, nodes).take(at) + right


def _nodes(tree: Tree, levels: int, x: np.ndarray) -> np.ndarray:
    """The node that every row reaches after so many levels."""
    at = np.zeros(x.shape[1], np.int64)
    for _ in range(levels):
        at = _step(tree, x, at)
    return at


def _tally(cell: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Whole sums of ``v`` by cell; doubles hold those of a block's 32 bit numbers."""
    if v.dtype != np.int64:
        return np.bincount(cell, v, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, cell, v)
    return out


def _sums(x: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, own: np.ndarray | None, tree: Tree, nodes: Sequence[int],
          columns: Sequence[int], widths: Sequence[int]) -> np.ndarray:
    """Sums of gradient and hessian by node and by column and bin, over a block's
    rows at the given nodes; ``own`` are the numbers of the rows that count, g
    and h are theirs (default: all)."""
    slot = np.full(len(tree.feature), -1)
    slot[nodes] = np.arange(len(nodes))
    slot = slot.take(at if own is None else at.take(own))
    met = np.flatnonzero(slot >= 0)
    if len(met) < len(slot):
        slot, g, h, own = slot.take(met), g.take(met), h.take(met), met if own is None else own.take(met)
    g, h = (v if v.dtype == np.int64 else v.astype(float) for v in (g, h))
    parts = []
    for f in columns:
        cell = slot * widths[f]
        cell += x[f] if own is None else x[f].take(own)
        parts.append([_tally(cell, v, len(nodes) * widths[f]).reshape(len(nodes), -1) for v in (g, h)])
    return np.concatenate(parts, axis=2)


def best_splits(g: np.ndarray, h: np.ndarray, columns: Sequence[int], widths: Sequence[int], s: Settings) -> list[tuple]:
    """(feature or -1, first bin that goes right, GL, HL) of every node, from its
    sums (rows of g and h): the greatest gain, on ties the first feature and bin.
    A bin without rows, or of rows that weigh nothing, has the gain of the bin
    before it, so it is never chosen."""
    out, best, a = [(-1, 0, 0, 0)] * len(g), np.full(len(g), 1e-12), 0
    for f in columns:
        gl, hl = (np.cumsum(v[:, a:a + widths[f]], axis=1) for v in (g, h))
        a += widths[f]
        G, H, GL, HL = gl[:, -1:] / UNIT, hl[:, -1:] / UNIT, gl[:, :-1] / UNIT, hl[:, :-1] / UNIT
        if not GL.shape[1]:
            continue
        GR, HR = G - GL, H - HL
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (GL ** 2 / (HL + s.l2) + GR ** 2 / (HR + s.l2) - G ** 2 / (H + s.l2)) / 2 - s.gamma
        gain[(HL < s.min_hessian) | (HR < s.min_hessian) | np.isnan(gain)] = -math.inf
        k = gain.argmax(axis=1)
        top = gain[np.arange(len(g)), k]
        for i in np.flatnonzero(top > best):
            out[i], best[i] = (f, int(k[i]) + 1, int(gl[i, k[i]]), int(hl[i, k[i]])), top[i]
    return out


def grow(sums, number: int, s: Settings, widths: Sequence[int]) -> Tree:
    """Tree ``number``, level by level; ``sums(tree, level, nodes, columns)``
    gives what :func:`_sums` does for all rows."""
    draw, n = random.Random(f"{s.seed}:{number}"), len(widths)
    columns = sorted(draw.sample(range(n), max(1, math.ceil(s.colsample * n - 1e-9))))
    size = 2 ** (s.depth + 1) - 1
    tree = Tree([-1] * size, [0] * size, [0.0] * size)

    def leaf(G: int, H: int) -> float:
        return -(G / UNIT) / (H / UNIT + s.l2) * s.eta if G else 0.0
    nodes, held = [0], {}  # nodes to sum up, and the sums of every split node with its smaller child
    for level in range(s.depth):
        if not nodes:
            break
        found = sums(tree, level, nodes, columns)
        if held:
            rest = np.stack([held[n][1] for n in nodes], axis=1) - found
            nodes, found = nodes + [held[n][0] for n in nodes], np.concatenate([found, rest], axis=1)
        g, h = found
        splits, one = best_splits(g, h, columns, widths, s), slice(0, widths[columns[0]])
        after, held = [], {}
        for i, (n, (feature, cut, GL, HL)) in enumerate(zip(nodes, splits)):
            G, H = int(g[i, one].sum()), int(h[i, one].sum())
            tree.leaf[n] = leaf(G, H)
            if feature < 0:
                continue
            tree.feature[n], tree.cut[n] = feature, cut
            tree.leaf[2 * n + 1], tree.leaf[2 * n + 2] = leaf(GL, HL), leaf(G - GL, H - HL)
            less, more = (2 * n + 1, 2 * n + 2) if 2 * HL <= H else (2 * n + 2, 2 * n + 1)
            after.append(less)
            held[less] = (more, found[:, i])
        nodes = after
    return tree


def _advance(block: tuple[np.ndarray, ...], tree: Tree, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The block with the margins after one more tree, whose leaves its rows reach."""
    *rest, m = block
    return (*rest, m + np.array(tree.leaf)[at])


def _next(block: tuple[np.ndarray, ...], trees: Sequence[Tree], depth: int) -> tuple[np.ndarray, ...]:
    for tree in trees:
        block = _advance(block, tree, _nodes(tree, depth, block[0]))
    return block


def _level(drawn: tuple[np.ndarray, ...], tree: Tree, level: int, nodes: Sequence[int], columns: Sequence[int], widths: Sequence[int]) -> np.ndarray:
    return _sums(*drawn, _nodes(tree, level, drawn[0]), None, tree, nodes, columns, widths)


def _task_trees(blocks: list[tuple[np.ndarray, ...]], widths: Sequence[int], s: Settings) -> Iterator[Tree]:
    """All trees of a training set that is one task's; rows keep their nodes from level to level."""
    for number in range(s.trees):
        own = [np.flatnonzero(_sampled(b[3], s, number)) for b in blocks]
        slopes = [_slopes(b, rows) for b, rows in zip(blocks, own)]
        at = [np.zeros(b[0].shape[1], np.int64) for b in blocks]

        def sums(tree, level, nodes, columns, own=own, slopes=slopes, at=at):
            if level:
                at[:] = [_step(tree, b[0], a) for b, a in zip(blocks, at)]
            return sum(_sums(b[0], *v, a, rows, tree, nodes, columns, widths) for b, v, a, rows in zip(blocks, slopes, at, own))
        tree = grow(sums, number, s, widths)
        # rows stand one level above the last leaves, or, where growing ended early, on leaves
        blocks = [_advance(b, tree, _step(tree, b[0], a)) for b, a in zip(blocks, at)]
        yield tree


def _grow_in_task(widths: Sequence[int], s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = list(_chunks(batches, BLOCK_ROWS, max(widths)))
        if blocks:
            yield pa.record_batch({"trees": pa.array([pickle.dumps(list(_task_trees(blocks, widths, s)), protocol=5)], pa.binary())})
    return run


def train(data: DataFrame, features: Sequence[str], label: str, s: Settings, weight: str | None = None,
          key: str | None = None) -> BoostedModel:
    data = materialize(data, "boosting")
    features = list(features)
    cuts = cut_points(data, features, s.bins)
    binned = materialize(_binned(data, features, label, weight, key, cuts), "binned").selectExpr("y", "w", "x", "xxhash64(k) AS k")
    n_rows, trees, widths = binned.count(), [], [len(c) + 1 for c in cuts]
    if not n_rows:
        empty = lambda tree, level, nodes, columns: np.zeros((2, len(nodes), sum(widths[f] for f in columns)), np.int64)
        return BoostedModel(features, cuts, [grow(empty, number, s, widths) for number in range(s.trees)])
    ship_package(data.sparkSession)
    checkpoint_root(data.sparkSession)
    if n_rows <= LOCAL_ROWS and n_rows * len(features) <= LOCAL_CELLS:
        grown = binned.repartition(1).mapInArrow(_grow_in_task(widths, s), "trees binary").collect()  # one row, the model
        return BoostedModel(features, cuts, pickle.loads(grown[0]["trees"]))
    rows, before, since = _blocks(binned, n_rows, s.bins).persist(StorageLevel.MEMORY_AND_DISK), None, ()
    for number in range(s.trees):
        drawn = rows.map(partial(_drawn, since=since, s=s, number=number)).persist(StorageLevel.MEMORY_AND_DISK)

        def sums(tree, level, nodes, columns, drawn=drawn):
            own = partial(_level, tree=tree, level=level, nodes=nodes, columns=columns, widths=widths)
            return drawn.map(own).treeReduce(np.add, depth=1 if drawn.getNumPartitions() <= DIRECT else 2)
        trees.append(grow(sums, number, s, widths))
        drawn.unpersist()
        if before is not None:
            before.unpersist()
            before = None
        since = (*since, trees[-1])
        if len(since) == STEP:
            before, rows, since = rows, rows.map(partial(_next, trees=since, depth=s.depth)).persist(StorageLevel.MEMORY_AND_DISK), ()
            if (number + 1) % KEEP == 0:
                rows.checkpoint()
    rows.unpersist()
    if before is not None:
        before.unpersist()
    return BoostedModel(features, cuts, trees)
