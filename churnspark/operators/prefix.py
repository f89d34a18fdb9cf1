"""Distributed ordered prefix sums (ranks, cumulative counts) without a
single-task window.

A window ``OVER (ORDER BY x)`` with no PARTITION BY moves every row into one
task.  Exact AUC, exact medians and the stratified split all need such
ordered running totals, so they share this two-level form:

1. every row gets a *bucket* that is monotone in the order key
   (quantile boundaries computed once and embedded as literals, or a
   hash prefix);
2. per-(group, bucket) totals form a small table (groups x buckets rows);
   a window over that small table gives each bucket its starting offset;
3. inside each (group, bucket) a partitioned window adds the local running
   total -- these windows run in parallel, one task per bucket.

The offsets table has at most ``groups x buckets`` rows; callers pass
low-cardinality group columns, so broadcasting it is size-bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MIN_BUCKETS = 16
# rows that one (group, bucket) window task sorts, about
TARGET_ROWS_PER_BUCKET = 500_000


def adaptive_buckets(spark: SparkSession, n_rows: int, target: int | None = None) -> int:
    """Buckets for ``n_rows`` ordered rows: enough for ``target`` rows each."""
    return max(MIN_BUCKETS, -(-n_rows // (target or TARGET_ROWS_PER_BUCKET)))


def quantile_splits(df: DataFrame, cols: Sequence[str], n_buckets: int,
                    rel_error: float | None = None) -> list[list[float]]:
    """Strictly increasing bucket splits per column, from ONE approximate
    quantile pass.  Only ``len(cols) x n_buckets`` numbers reach the driver."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    # bucket balance needs rank error well below 1/n_buckets, not more
    acc = int(max(1000, 16 * n_buckets)) if rel_error is None else int(1 / rel_error)
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, acc).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    out = []
    for i, _ in enumerate(cols):
        qs = row[f"q{i}"] or []
        inner = sorted({float(q) for q in qs if q is not None and q == q}) or [0.0]
        out.append([float("-inf")] + inner + [float("inf")])
    return out


def bucketize(df: DataFrame, cols: Sequence[str], splits: Sequence[Sequence[float]],
              out_cols: Sequence[str]) -> DataFrame:
    """Binary-search bucketing on the JVM (Spark ML Bucketizer)."""
    cast = df
    tmp = []
    for c in cols:
        t = f"__bk_in_{c}"
        cast = cast.withColumn(t, F.col(c).cast("double"))
        tmp.append(t)
    b = Bucketizer(splitsArray=[list(s) for s in splits], inputCols=tmp,
                   outputCols=list(out_cols), handleInvalid="keep")
    res = b.transform(cast).drop(*tmp)
    for o in out_cols:
        res = res.withColumn(o, F.col(o).cast("int"))
    return res


def range_bucketed(df: DataFrame, order_cols: Sequence[str], n_buckets: int,
                   bucket_col: str = "__bk") -> DataFrame:
    """Bucket = range partition of ``order_cols`` (any orderable types,
    strings included).  Range bounds are sampled, so the bucketed table is
    written once (``materialize``) and every later read -- and any retry --
    sees the same buckets."""
    from churnspark.session import materialize
    r = df.repartitionByRange(n_buckets, *order_cols).withColumn(bucket_col, F.spark_partition_id())
    return materialize(r, "range_buckets")


def prefix_sums(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str | Column],
                bucket_col: str, sum_cols: Sequence[str], prefix: str = "cum_",
                with_totals: bool = True) -> DataFrame:
    """Add ``<prefix><c>`` = exclusive running total of ``c`` within
    ``partition_cols`` ordered by ``order_cols`` (which must be unique within a
    partition), and optionally ``total_<c>`` = the partition total.

    ``bucket_col`` must be non-decreasing in the order key inside a partition.
    """
    pcols = list(partition_cols)
    keys = pcols + [bucket_col]
    tot = df.groupBy(*keys).agg(*[F.sum(c).alias(f"__bt_{c}") for c in sum_cols])
    wb = Window.partitionBy(*pcols).orderBy(bucket_col) if pcols else Window.orderBy(bucket_col)
    wb_prev = wb.rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(
        *keys,
        *[F.coalesce(F.sum(f"__bt_{c}").over(wb_prev), F.lit(0)).alias(f"__off_{c}") for c in sum_cols],
        *([F.sum(f"__bt_{c}").over(wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
           .alias(f"total_{c}") for c in sum_cols] if with_totals else []),
    )
    # null-safe: a NULL group or bucket keeps its rows
    offs = offs.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in offs.columns if c not in keys])
    same = [df[k].eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    joined = df.join(offs, on=same, how="inner").drop(*[f"__k_{k}" for k in keys])
    wl = (Window.partitionBy(*keys).orderBy(*order_cols)
          .rowsBetween(Window.unboundedPreceding, -1))
    out = joined
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}",
                             F.col(f"__off_{c}") + F.coalesce(F.sum(c).over(wl), F.lit(0)))
    return out.drop(*[f"__off_{c}" for c in sum_cols])
