"""Cleaning: numeric coercion, binary mapping, keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.scalar import coerce_numeric, map_binary


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order_by``.

    Null keys are equal to each other (one null-key row is kept), as in a
    pandas ``drop_duplicates``.  ``order_by`` must make the choice unique
    (append a row id for ties).

    Formulated as an aggregate ``min_by(row, order)`` instead of a
    ``row_number()`` window: the aggregate is combined map-side, so a hot key
    holding a third of the table is reduced to one candidate per task before
    the shuffle, instead of being sorted in a single task.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    if not order:
        raise ValueError("keep-first needs an explicit order")
    if not payload:
        return df.select(*keys).distinct()
    # the order is projected first, so it may be non-deterministic (a row id)
    ordered = df.withColumn("__order", F.struct(*order))
    best = F.min_by(F.struct(*[F.col(c) for c in payload]), F.col("__order")).alias("__row")
    return ordered.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in payload]) \
        .select(*df.columns)


def with_ingest_order(df: DataFrame, name: str = "__ingest_order") -> DataFrame:
    """File order for files without an order column: (file path, position).

    Taken directly on the scan, so the order is the one in the files.
    """
    return (df.withColumn("__file", F.col("_metadata.file_path"))
            .withColumn(name, F.struct(F.col("__file"), F.monotonically_increasing_id()))
            .drop("__file"))


def clean_raw(df: DataFrame, numeric_text: Sequence[str] = ("TotalCharges",), target: str = "Churn",
              key: str | None = "customerID", order_by: Sequence[str | Column] | None = None,
              positive: str = "Yes", negative: str = "No") -> DataFrame:
    """Coerce numeric text, map the target Yes/No -> 1/0 (other -> NULL) and
    keep the first row per key."""
    out = df
    for c in numeric_text:
        if c in out.columns:
            out = out.withColumn(c, coerce_numeric(c))
    if target in out.columns:
        out = out.withColumn(target, map_binary(target, positive, negative))
    if key:
        order = [o for o in order_by or [] if not (isinstance(o, str) and o == key)]
        if not order:
            raise ValueError("keep-first needs an order other than the key")
        out = dedup_keep_first(out, [key], order)
    return out


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; absent ones are ignored."""
    return df.drop(*cols)


def split_target(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """Features = all other columns; target cast to int as ``label``, last."""
    feats = [c for c in df.columns if c != target]
    return df.select(*feats, F.col(target).cast("int").alias(label))
