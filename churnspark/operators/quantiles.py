"""Exact order statistics of many columns at once, by narrowing brackets.

The values of every column are counted per bracket; a bracket that holds a
wanted rank and more than ``LAST_ROWS`` rows of different values is cut at the
quantiles of a sketch of its rows, and the counting starts again.  The bounds
of brackets only steer the search: whatever the sketch says, ranks come from
exact counts, so the result doesn't depend on it.  Every round divides the rows
of a bracket by about ``CUTS``.  At last the wanted brackets, of ``LAST_ROWS``
rows each at most, are sorted by value.

All columns share each pass.  Only one row per column and bracket reaches the
driver.  A bracket of one value is never cut, whatever it holds.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.functions.scalar import nan_to_null

#: Rows of a bracket that one task may sort.
LAST_ROWS = 200_000
#: Parts into which a bracket is cut.
CUTS = 256
LARGEST = sys.float_info.max


def _bracketed(df: DataFrame, n: int, bounds: dict[int, list[float]]) -> DataFrame:
    """(feature number, bracket, value) of the values that aren't null."""
    names = [f"x{i}" for i in range(n)]
    cut = [i for i in range(n) if bounds.get(i)]
    if cut:
        inf = float("inf")
        df = Bucketizer(splitsArray=[[-inf, *bounds[i], inf] for i in cut], inputCols=[names[i] for i in cut],
                        outputCols=[f"b{i}" for i in cut], handleInvalid="keep").transform(df)
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("f"), (F.col(f"b{i}").cast("int") if i in cut else F.lit(0)).alias("b"), F.col(names[i]).alias("v"))
        for i in range(n)])).alias("e")).select("e.*").where("v IS NOT NULL")


def order_statistics(df: DataFrame, cols: Sequence[str], ranks, last_rows: int | None = None) -> DataFrame:
    """(feature, n, rank, value): the values at the 0-based ``ranks(n)`` of every
    column with n values, in ascending order; nulls and NaN are left out."""
    from churnspark.session import materialize
    spark, cols, last_rows = df.sparkSession, list(cols), last_rows or LAST_ROWS
    schema = "feature string, n long, rank long, value double"
    if not cols:
        return spark.createDataFrame([], schema)
    wide = materialize(df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)]), "columns")
    bounds: dict[int, list[float]] = {}
    while True:
        rows = _bracketed(wide, len(cols), bounds)
        counted = rows.groupBy("f", "b").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        total = {i: sum(r["n"] for r in counted if r["f"] == i) for i in range(len(cols))}
        wanted = {}  # (feature, bracket): rows before it, its ranks
        for i in range(len(cols)):
            before, left = 0, sorted(set(ranks(total[i]))) if total[i] else []
            for r in sorted((r for r in counted if r["f"] == i), key=lambda r: r["b"]):
                own = [k for k in left if before <= k < before + r["n"]]
                if own:
                    wanted[i, r["b"]] = (before, own, r)
                before += r["n"]
        large = [key for key, (_, _, r) in wanted.items() if r["n"] > last_rows and r["lo"] < r["hi"]]
        if not large:
            break
        inside = spark.createDataFrame(large, "f int, b int")
        probs = [k / CUTS for k in range(1, CUTS)]
        cuts = (rows.join(F.broadcast(inside), ["f", "b"]).groupBy("f", "b")
                .agg(F.percentile_approx("v", probs, 8 * CUTS).alias("q")).collect())
        before = {f: len(b) for f, b in bounds.items()}
        for r in cuts:
            lo, hi = wanted[r["f"], r["b"]][2]["lo"], wanted[r["f"], r["b"]][2]["hi"]
            # a bound is the first value of its bracket: the least value is none, the greatest always is one
            fresh = {min(q, LARGEST) for q in (*r["q"], hi) if lo < q}
            bounds[r["f"]] = sorted(set(bounds.get(r["f"], [])) | fresh)
        if all(len(b) == before.get(f, 0) for f, b in bounds.items()):
            break  # nothing between infinity and the largest number
    known = [(cols[i], total[i], k, r["lo"]) for (i, _), (_, own, r) in wanted.items() if r["lo"] == r["hi"] for k in own]
    found = spark.createDataFrame(known, schema)
    open_ = [(i, b, before, total[i]) for (i, b), (before, _, r) in wanted.items() if r["lo"] < r["hi"]]
    if not open_:
        return found
    asked = spark.createDataFrame([(i, b, k) for (i, b), (_, own, r) in wanted.items() if r["lo"] < r["hi"] for k in own], "f int, b int, rank long")
    counts = (rows.join(F.broadcast(spark.createDataFrame(open_, "f int, b int, before long, total long")), ["f", "b"])
              .groupBy("f", "b", "before", "total", "v").agg(F.count("*").alias("n")))
    upto = Window.partitionBy("f", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("end", F.col("before") + F.sum("n").over(upto))
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("f") + 1)
    return found.unionByName(
        ranked.join(F.broadcast(asked), ["f", "b"]).where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))
        .select(name.alias("feature"), F.col("total").alias("n"), "rank", F.col("v").alias("value")))


def middle_ranks(n: int) -> list[int]:
    return [(n - 1) // 2, n // 2]
