"""Mixing sources to target weights, on DataFrame functions only.

Method: a low-discrepancy source schedule.  Slot i of the mix gets the point
frac(i / golden ratio); the cumulative slot shares of the sources map it to a
source.  Slots are ranked per source, and rank k takes block k of the source:
its documents, shuffled by hash, are one stream of words cut into blocks of
equal size; the stream starts anew when it is used up.  The last slot of a
source is cut so that the source's words meet its quota (target rounded down).
A document's ``first_slot`` is the slot of the schedule that first takes words
of it: in this order the documents are the mix, and every stretch from its
start on holds the sources in their shares, up to the discrepancy of the points
(at most 1 + ln(slots) slots of a source too many or too few).

Targets: sources by code point, null last, weigh ``weights`` in turn and share
``factor`` times all words; a target stops at ``max_repeats`` times its
source's size and the excess is reshared by weight (closed form: sources fill
up in the order of size / weight).

Scale: every ranking and running sum has two levels -- sums by (source,
bucket), their running sum, then a window inside each bucket -- so a source
with a third of all rows is never one task.  Points meet sources by an
equi-join on cells of the unit interval.  Source tables hold one row per
source.  Documents travel as id, source and size; texts are read once.

Defined cases: null text has size 0 and is never taken; null source is a
source of its own; repeated rows count each; equal ids and sizes are
interchangeable; no rows or no words give taken 0 and no first slot; very long
texts are words like any other (only their number travels); extra columns aren't
read; result order is free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import n_words, packed, text_of
from churnspark.session import materialize

GOLDEN = 0.6180339887498949
#: Hash buckets of each source's running sum, and slots in a schedule chunk.
BUCKET_HEX = 3
CHUNK = 4096
#: Slots beyond the sum of all quotas, as a source's count may lag behind its
#: expectation; what is lacking even then is added at the end.
SPARE = 0.125


def source_targets(docs: DataFrame, weights: tuple[float, ...], factor: float, max_repeats: float,
                   block_words: int, min_slots: int) -> DataFrame:
    """One row per source: number, size, target, quota, block length, number
    of blocks, slots it needs, and its interval of the unit interval."""
    by_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = by_source.withColumn("k", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    fill = Window.orderBy("ratio", "k")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = (ranked.withColumn("weight", weight)
              .withColumn("cap", max_repeats * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight"))
              .withColumn("budget", factor * F.sum("source_size").over(everything))
              .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
                          / F.sum("weight").over(rest))
              # the first source that isn't filled up sets the level for all
              .withColumn("water", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "k", "level")))
                          .over(everything)["level"]))
    target = F.when(F.col("water").isNull() | (F.col("ratio") <= F.col("water")), F.col("cap")).otherwise(
        F.col("water") * F.col("weight"))
    quotas = (levels.withColumn("target", target)
              .withColumn("quota", F.floor(F.least("target", "cap")).cast("long"))
              .withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("target") / min_slots)))
                          .cast("long"))
              .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long")))
    size = F.greatest(F.col("source_size"), F.lit(1))
    needed = quotas.withColumn("slots", F.when(F.col("source_size") > 0,
                               F.floor(F.col("quota") / size) * F.col("n_blocks")
                               + F.ceil((F.col("quota") % size) / F.col("block"))).otherwise(0).cast("long"))
    before = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    share = (needed.withColumn("all_slots", F.sum("slots").over(everything))
             .withColumn("lo", F.coalesce(F.sum("slots").over(before), F.lit(0)) / F.greatest("all_slots", F.lit(1)))
             .withColumn("hi", F.sum("slots").over(Window.orderBy("k")) / F.greatest("all_slots", F.lit(1))))
    return share.select("source", "k", "source_size", "target", "quota", "block", "n_blocks", "slots", "all_slots", "lo", "hi")


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of the mix: slot, source number k, rank within the source
    (ranks beyond the slots a source needs are left out)."""
    spark = sources.sparkSession
    total, n_sources = sources.agg(F.coalesce(F.max("all_slots"), F.lit(0)), F.count("*")).first()
    n_slots = int(total * (1 + SPARE)) + (64 if total else 0)
    cells = max(1024, 4 * n_sources)
    covers = (sources.where("slots > 0").select(
        "k", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.floor(F.col("hi") * cells))).alias("cell")))
    points = (spark.range(n_slots).select(F.col("id").alias("slot"),
                                          F.pmod((F.col("id") + 1) * F.lit(GOLDEN), F.lit(1.0)).alias("u"))
              .withColumn("cell", F.floor(F.col("u") * cells)))
    drawn = (points.join(covers, "cell").where("u >= lo AND u < hi")
             .select("slot", "k", F.floor(F.col("slot") / CHUNK).alias("chunk")))
    counts = drawn.groupBy("k", "chunk").count()
    earlier = (counts
               .select("k", "chunk", F.coalesce(F.sum("count").over(
                   Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before")))
    inside = drawn.withColumn("nth", F.row_number().over(Window.partitionBy("k", "chunk").orderBy("slot")) - 1)
    ranked = (inside.join(earlier, ["k", "chunk"]).withColumn("rank", F.col("before") + F.col("nth"))
              .join(sources.select("k", "slots"), "k").where("rank < slots").select("slot", "k", "rank"))
    # the interval of a tiny source may lie between points: what it lacks comes after all others
    got = counts.groupBy("k").agg(F.sum("count").alias("got"))
    lacking = (sources.join(got, "k", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < slots")
               .select("k", F.round(F.col("lo") * F.col("all_slots")).cast("long").alias("first"),
                       F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank")))
    return ranked.unionByName(lacking.select((F.lit(n_slots) + F.col("first") + F.col("rank")).alias("slot"), "k", "rank"))


def block_usage(slots: DataFrame, sources: DataFrame) -> DataFrame:
    """How often each block is taken whole, how many of its first words the
    source's last, cut slot takes, and the first slot of either kind."""
    used = (slots.join(sources, "k")
            .withColumn("epoch", F.floor(F.col("rank") / F.col("n_blocks")))
            .withColumn("nr", F.col("rank") % F.col("n_blocks"))
            .withColumn("length", F.least(F.col("block"), F.col("source_size") - F.col("nr") * F.col("block")))
            .withColumn("fill", F.least(F.col("length"), F.col("quota") - F.col("epoch") * F.col("source_size")
                                        - F.col("nr") * F.col("block"))))
    return used.groupBy("k", "nr").agg(
        F.sum(F.when(F.col("fill") == F.col("length"), 1).otherwise(0)).alias("whole"),
        F.max(F.when(F.col("fill") < F.col("length"), F.col("fill")).otherwise(0)).alias("part"),
        F.min(F.when(F.col("fill") == F.col("length"), F.col("slot"))).alias("whole_slot"),
        F.min(F.when(F.col("fill") < F.col("length"), F.col("slot"))).alias("part_slot"))


def stream_starts(rows: DataFrame) -> DataFrame:
    """``start``: words of the source before each document in hash order."""
    bucket = ["k", "bucket"]
    inside = Window.partitionBy(*bucket).orderBy("shuffled", "doc_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*bucket).agg(F.sum("size").alias("words"))
    before = sums.select(*bucket, F.coalesce(F.sum("words").over(
        Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return (rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(before, bucket).withColumn("start", F.col("base") + F.col("within")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = (5, 2, 1), factor: float = 1.5, max_repeats: float = 2.0,
        block_words: int = 4096, min_slots: int = 64) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken,
    first_slot (null if nothing is taken)."""
    sized = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                    n_words(text_of(text_col)).alias("size")), "sizes")
    sources = materialize(source_targets(sized, weights, factor, max_repeats, block_words, min_slots), "sources")
    usage = block_usage(schedule(sources), sources)
    key = F.col("doc_id")
    if "struct" in dict(sized.dtypes)["doc_id"]:
        key = F.to_json(key)
    key = F.coalesce(key.cast("string"), F.lit(""))
    s = sources.withColumnRenamed("source", "s_source")
    rows = (sized.join(s, sized["source"].eqNullSafe(s["s_source"]))
            .select("doc_id", "source", "size", "k", "source_size", "target", "block",
                    key.alias("doc_key"), F.md5(key).alias("shuffled"))
            .withColumn("bucket", F.substring("shuffled", 1, BUCKET_HEX)))
    placed = stream_starts(rows.where("size > 0"))
    first, last = F.floor(F.col("start") / F.col("block")), F.floor((F.col("start") + F.col("size") - 1) / F.col("block"))
    pieces = (placed.withColumn("nr", F.explode(F.sequence(first, last)))
              .withColumn("off", F.greatest(F.col("start") - F.col("nr") * F.col("block"), F.lit(0)))
              .withColumn("len", F.least(F.col("start") + F.col("size"), (F.col("nr") + 1) * F.col("block"))
                          - F.greatest(F.col("start"), F.col("nr") * F.col("block"))))
    out = ["doc_id", "source", "size", "source_size", "target"]
    last_words = F.greatest(F.lit(0), F.least(F.col("part") - F.col("off"), F.col("len")))
    took = F.coalesce(F.col("whole") * F.col("len") + last_words, F.lit(0))
    slot = F.least("whole_slot", F.when(last_words > 0, F.col("part_slot")))
    taken = (pieces.join(usage, ["k", "nr"], "left").groupBy(*out, "start")
             .agg(F.sum(took).cast("long").alias("taken"), F.min(slot).alias("first_slot")).drop("start"))
    empty = rows.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
    return taken.unionByName(empty)
