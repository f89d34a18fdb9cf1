"""Deterministic stratified train/val/test split.

Inside each class, rows are ordered by ``md5('<seed>:<key>')``; row ``r``
(1-based) of a class with ``n`` rows goes to ``train`` when ``r <= round(0.70
n)``, to ``val`` when ``r <= round(0.85 n)``, else to ``test``.  The same rule in
any engine gives the same split on any cluster; class proportions match the
original 70/15/15 stratified split.

Scale: only the two rows of each class at which the cuts lie are looked for.
Rows are counted by class and hash prefix; the prefix that holds a cut is
counted by its next digits until it holds few rows, which are then sorted.  The
rows themselves are assigned by comparing their hash with the two boundaries of
their class, in a projection: no row is shuffled or sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42            # fixed value: the original split seed
TRAIN_FRACTION = 0.70
VAL_FRACTION = 0.15
#: Hash digits by which a prefix is refined, and rows that are sorted at last.
DIGITS, LAST_ROWS = 3, 100_000
_LENGTH = 48         # digits of the order: md5 of the key, then a hash of the row


def split_hash(key: str, seed: int = SEED):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def _cut_rows(counts: DataFrame, group: list[str]) -> list:
    """Of each group's counted prefixes (``p``, ``n``, and ``cut`` -> ``rank``),
    the one that holds the rank: (*group, p, n, rows before it)."""
    w = Window.partitionBy(*group)
    upto = w.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("end", F.sum("n").over(upto)).where((F.col("rank") > F.col("end") - F.col("n")) & (F.col("rank") <= F.col("end")))
            .select(*group, "rank", "p", "n", (F.col("end") - F.col("n")).alias("before")).collect())


def _boundaries(narrow: DataFrame, fractions: list[float], digits: int, last_rows: int) -> DataFrame:
    """(label, cut, s, share): the order string of the last row of each part of
    each class, and the share of rows equal to it that belong to the part.
    ``narrow`` is (label, s).  One row per class and cut reaches the driver."""
    spark = narrow.sparkSession
    kind = narrow.schema["label"].dataType.simpleString()
    counted = narrow.groupBy("label", F.substring("s", 1, digits).alias("p")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("label"))
    ranks = F.array(*[F.struct(F.lit(i).alias("cut"), F.round(F.lit(f) * F.col("total")).cast("long").alias("rank"))
                      for i, f in enumerate(fractions)])
    rows = _cut_rows(counted.withColumn("total", total).withColumn("e", F.explode(ranks)).select("label", "p", "n", "e.*"),
                     ["label", "cut"])
    cuts = [(r["label"], r["cut"], r["rank"] - r["before"], r["p"], r["n"]) for r in rows]
    schema = f"c_label {kind}, cut int, rank long, prefix string, rows long"
    while digits < _LENGTH and any(c[4] > last_rows for c in cuts):
        digits = min(_LENGTH, digits + DIGITS)
        near = _inside(narrow, spark.createDataFrame(cuts, schema))
        counted = near.groupBy("label", "cut", "rank", F.substring("s", 1, digits).alias("p")).agg(F.count("*").alias("n"))
        cuts = [(r["label"], r["cut"], r["rank"] - r["before"], r["p"], r["n"]) for r in _cut_rows(counted, ["label", "cut"])]
    counted = (_inside(narrow, spark.createDataFrame(cuts, schema)).groupBy("label", "cut", "rank", F.col("s").alias("p"))
               .agg(F.count("*").alias("n")))
    found = [(r["label"], r["cut"], r["p"], (r["rank"] - r["before"]) / r["n"]) for r in _cut_rows(counted, ["label", "cut"])]
    return spark.createDataFrame(found, f"label {kind}, cut int, s string, share double")


def _inside(narrow: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows of the prefixes that hold a cut (two rows per class are broadcast)."""
    same = F.col("label").eqNullSafe(F.col("c_label")) & F.col("s").startswith(F.col("prefix"))
    return narrow.join(F.broadcast(cuts), same).select("label", "cut", "rank", "s")


def stratified_split(df: DataFrame, key: str, label: str, seed: int = SEED,
                     train: float = TRAIN_FRACTION, val: float = VAL_FRACTION,
                     hex_digits: int | None = None, materialize_input: bool = True) -> DataFrame:
    """Return ``df`` with an added ``split`` column (train/val/test).

    With ``materialize_input`` the input is written once, so a derived input
    (joins, aggregates) is not recomputed by the passes; pass ``False`` when
    ``df`` is already a plain table scan.

    No row is lost: rows with a NULL label are a class of their own, a NULL
    key hashes as the empty text.  Rows that share a key are ordered by a hash
    of the whole row; if rows equal in every column stand at a cut, each goes
    to either part by its row number, so the sizes may be off by a few of them.
    """
    if materialize_input:
        from churnspark.session import materialize
        df = materialize(df, "split_input")
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.concat(split_hash(key, seed), F.lpad(F.lower(F.hex(F.xxhash64(*hashable))), 16, "0"))
    narrow = df.select(F.col(f"`{label}`").alias("label"), order.alias("s"))
    ends = [train, round(train + val, 10)]
    found = _boundaries(narrow, ends, hex_digits or DIGITS, LAST_ROWS)
    # one row per class; a part without rows has no end
    of = lambda i, c: F.max(F.when(F.col("cut") == i, F.col(c)))
    bounds = found.groupBy(F.col("label").alias("__label")).agg(
        *[of(i, c).alias(f"__{c}{i}") for i in (0, 1) for c in ("s", "share")])
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1_000_003)) / 1_000_003
    rows = df.select("*", order.alias("__s"), deal.alias("__deal"))
    joined = rows.join(F.broadcast(bounds), rows[f"`{label}`"].eqNullSafe(F.col("__label")), "left")

    def within(i: int):
        s, end = F.col("__s"), F.col(f"__s{i}")
        return F.coalesce((s < end) | ((s == end) & (F.col("__deal") < F.col(f"__share{i}"))), F.lit(False))
    split = F.when(within(0), F.lit("train")).when(within(1), F.lit("val")).otherwise(F.lit("test"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], split.alias("split"))


def window_split(df: DataFrame, key: str, label: str, seed: int = SEED,
                 train: float = TRAIN_FRACTION, val: float = VAL_FRACTION) -> DataFrame:
    """Small-data reference form of :func:`stratified_split` (plain windows;
    one task per class).  Used only to test the distributed form."""
    h = split_hash(key, seed)
    w = Window.partitionBy(label).orderBy(h, F.col(key))
    r = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(label))
    return df.withColumn("split", F.when(r <= F.round(F.lit(train) * n), "train")
                         .when(r <= F.round(F.lit(round(train + val, 10)) * n), "val").otherwise("test"))
