"""Hard negatives by inner product, with coordinate pruning after LEMP.

An anchor's positives are its best other rows of the same label; for each of
them the best rows of other labels whose score lies in a band around the
positive's score are its hard negatives.  Both are searches of all rows, made in
blocks: rows and anchors are hashed into blocks of bounded size, and a task
searches one block of rows for one block of anchors.  The best of all tasks are
merged by anchor.

Within a task rows are sorted by length and cut into buckets; a bucket holds the
sorted list of each coordinate of its unit vectors.  A row can reach the score t
only if its cosine with the anchor reaches t / (anchor length * greatest length
of the bucket).  That rules out whole buckets, and for each focus coordinate
(those where the anchor is largest) it leaves a feasible range: with the anchor
at angle a from the axis and the row at angle b, cos(a - b) must reach the
bound.  The rows in the ranges of all focus coordinates are the candidates,
whose integer scores are then computed exactly.  ``t`` is the worst of the best
rows found so far, so it rises from bucket to bucket.  Rows at a bound, up to
rounding, are always kept: the result equals a search of all pairs.

Defined cases: rows with a null id, label or vector, or any null or non-finite
component take no part; of rows that share an id the one with the smallest label,
then vector, counts; an empty or short vector is continued with zeros; zero vectors score 0; ties go to
the smaller id; a positive with a score below 0 has an empty band; an empty
table gives an empty table; extra columns aren't read.  Components are taken as
integers, and sums must stay below 2^63 (below 2^53 they are computed by double
products, above by integer ones).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import ship
from churnspark.session import materialize

#: Greatest expected rows and anchors of a block; small tables are cut finer so
#: that there are tasks to share.
ROWS_PER_BLOCK, ANCHORS_PER_BLOCK = 65_536, 16_384
ROW_BLOCKS, ANCHOR_BLOCKS = 16, 4
#: Rows of a length bucket, and coordinates that an anchor looks at.
BUCKET = 512
FOCUS = 3
_SLACK = 1e-9


class LengthBucket:
    """Rows of similar length with a sorted list of every coordinate."""

    def __init__(self, rows: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.rows, self.vectors, self.longest = rows, vectors, lengths.max()
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.sorted = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, bound: float) -> np.ndarray:
        """Positions of the rows whose cosine with ``unit`` may reach ``bound``."""
        hits = np.zeros(len(self.rows), np.uint8)
        beta = math.acos(max(-1.0, min(1.0, bound - _SLACK)))
        for f in focus:
            alpha = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            low, high = math.cos(min(alpha + beta, math.pi)) - _SLACK, math.cos(max(alpha - beta, 0.0)) + _SLACK
            column = self.sorted[:, f]
            hits[self.order[np.searchsorted(column, low, "left"):np.searchsorted(column, high, "right"), f]] += 1
        return np.flatnonzero(hits == len(focus))


class Block:
    """A block of rows, longest first, cut into length buckets.  Zero vectors
    are kept apart, as they have no direction."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        squares = (vectors.astype(float) ** 2).sum(axis=1)
        self.exact = len(squares) == 0 or squares.max() < 2.0 ** 52
        order = np.lexsort((ids, -squares))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        lengths = np.sqrt(squares[order])
        if self.exact:
            self.vectors = self.vectors.astype(float)
        alive = int((lengths > 0).sum())
        self.zeros = np.arange(alive, len(order))
        self.buckets = [LengthBucket(np.arange(i, min(i + BUCKET, alive)), self.vectors[i:min(i + BUCKET, alive)],
                                     lengths[i:min(i + BUCKET, alive)]) for i in range(0, alive, BUCKET)]

    def search(self, vector: np.ndarray, threshold):
        """Yield (rows, scores) of candidates, bucket by bucket.  ``threshold()``
        is the least score that still counts; None ends the search."""
        length = math.sqrt(float((vector.astype(float) ** 2).sum()))
        query = vector.astype(float) if self.exact and length < 2.0 ** 26 else vector.astype(np.int64)
        unit = vector / length if length else None
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS] if length else None
        for bucket in self.buckets:
            least = threshold()
            if length and least > 0:
                bound = least / (length * bucket.longest)
                if bound > 1 + _SLACK:
                    return  # buckets that follow hold shorter rows
                at = bucket.candidates(unit, focus, bound)
            elif not length and least > 0:
                return
            else:
                at = np.arange(len(bucket.rows))
            if len(at):
                chosen = bucket.vectors[at] if len(at) < len(bucket.rows) else bucket.vectors
                scores = (chosen if query.dtype == chosen.dtype else chosen.astype(np.int64)) @ query
                yield bucket.rows[at], scores.astype(np.int64)
        if len(self.zeros) and threshold() <= 0:
            yield self.zeros, np.zeros(len(self.zeros), np.int64)


class Best:
    """The best ``k`` (score, id) so far, higher scores and then smaller ids first."""

    def __init__(self, k: int, least: float, most: float = math.inf):
        self.k, self.least, self.most = k, least, most
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.least) & (scores <= self.most)
        if not fit.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(self.ids) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    if len(sizes) and (sizes == width).all():
        return flat[at[0]:at[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, (a, b) in enumerate(zip(at, at[1:])):
        out[i, :b - a] = flat[a:b]
    return out


def _widest(*columns: pa.ChunkedArray) -> int:
    return max([1, *(int(np.diff(c.combine_chunks().offsets.to_numpy()).max(initial=0)) for c in columns)])


def _block(rows: pa.Table, width: int) -> Block:
    return Block(rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["vector"], width))


def integer_rows(rows: DataFrame, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part: floor(scale * x) as long."""
    finite = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return (rows.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("vector"))
            .groupBy("id").agg(F.min(F.struct("label", "vector")).alias("one")).select("id", "one.label", "one.vector"))


def _dealt(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with the pair of blocks they meet in: every row meets
    each block of anchors once, and every anchor each block of rows."""
    row_blocks = max(-(-n_rows // ROWS_PER_BLOCK), min(ROW_BLOCKS, -(-n_rows // BUCKET)), 1)
    anchor_blocks = max(-(-n_anchors // ANCHORS_PER_BLOCK), min(ANCHOR_BLOCKS, n_anchors), 1)
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return (rows.withColumn("rb", own(row_blocks)).withColumn("ab", every(anchor_blocks)),
            anchors.withColumn("ab", own(anchor_blocks)).withColumn("rb", every(row_blocks)))


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and anchors.num_rows:
            width = _widest(rows["vector"], anchors["vector"])
            block, vectors = _block(rows, width), _matrix(anchors["vector"], width)
            for i, (own, label) in enumerate(zip(anchors["id"].to_pylist(), anchors["label"].to_pylist())):
                best = Best(k, -math.inf)
                for at, scores in block.search(vectors[i], lambda best=best: best.least):
                    fit = (block.labels[at] == label) & (block.ids[at] != own)
                    best.add(scores[fit], block.ids[at[fit]])
                n = len(best.ids)
                out.append((np.full(n, own), best.ids, best.scores))
        cols = [np.concatenate([x[c] for x in out]) if out else np.zeros(0, np.int64) for c in range(3)]
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("id", "positive", "score"), cols)})
    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if rows.num_rows and anchors.num_rows:
            width = _widest(rows["vector"], anchors["vector"])
            block, vectors = _block(rows, width), _matrix(anchors["vector"], width)
            for i, (own, label, positives) in enumerate(zip(*(anchors[c].to_pylist() for c in ("id", "label", "positives")))):
                # the band of a score holds low <= 100 * negative / positive <= high
                bands = {p["score"]: Best(k, -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives if p["score"] >= 0}
                if not bands:
                    continue
                for at, scores in block.search(vectors[i], lambda bands=bands: min(b.least for b in bands.values())):
                    fit = (block.labels[at] != label) & (block.ids[at] != own)
                    for best in bands.values():
                        best.add(scores[fit], block.ids[at[fit]])
                for p in positives:
                    if p["score"] in bands:
                        best = bands[p["score"]]
                        n = len(best.ids)
                        out.append((np.full(n, own), np.full(n, p["id"]), np.full(n, p["score"]), best.ids, best.scores))
        cols = [np.concatenate([x[c] for x in out]) if out else np.zeros(0, np.int64) for c in range(5)]
        names = ("id", "positive", "positive_score", "negative", "score")
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, cols)})
    return run


def _searched(rows: DataFrame, anchors: DataFrame, run, schema: str) -> DataFrame:
    ship(rows.sparkSession)
    return rows.groupBy("rb", "ab").cogroup(anchors.groupBy("rb", "ab")).applyInArrow(run, schema)


def mine(rows: DataFrame, is_anchor: Column | None = None, *, label: Column | None = None, id_col: str = "vec_id",
         vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id`` (all rows by default);
    ``low`` and ``high`` are percents of the positive's score."""
    taken = materialize(integer_rows(rows, F.col("label") if label is None else label, id_col, vector_col, scale), "vectors")
    anchors = taken if is_anchor is None else taken.where(is_anchor)
    n_rows, n_anchors = taken.count(), anchors.count()
    dealt, asked = _dealt(taken, anchors, n_rows, n_anchors)
    found = _searched(dealt, asked, _positives(positives), "id long, positive long, score long")
    first = Window.partitionBy("id").orderBy(F.desc("score"), "positive")
    best = (found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives)
            .groupBy("id").agg(F.collect_list(F.struct(F.col("positive").alias("id"), "score")).alias("positives")))
    with_positives = materialize(anchors.join(best, "id"), "anchors")
    dealt, asked = _dealt(taken, with_positives, n_rows, n_anchors)
    found = _searched(dealt, asked, _negatives(negatives, low, high),
                      "id long, positive long, positive_score long, negative long, score long")
    rank = F.row_number().over(Window.partitionBy("id", "positive").orderBy(F.desc("score"), "negative"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                    F.col("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
