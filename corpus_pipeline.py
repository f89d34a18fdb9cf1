"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns of ``documents``; the last adds ``target`` (words wanted from the
document's source), ``taken`` (words of the document in the mix) and
``first_slot`` (its place in the mix).

Defined cases: null texts are empty; rows with a null id are judged by their
own text and never linked with others; rows that share an id but not the text
are judged each by its text, so no text goes for another one's sake; of rows
equal in id and text near dedup keeps one; extra columns are kept (one named as
a column that the last stage adds gets ``_given`` behind its name); ties go to
the smaller id; very long texts are read whole; empty tables give empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.llm import decontaminate, line_dedup, mixing, near_dedup, quality_classifier
from churnspark.llm.bloom import bloom_filter, with_possible
from churnspark.llm.common import fold, packed, table, text_of, unpacked
from churnspark.session import materialize

QUALITY_THRESHOLD = 0.3
#: Percent of shared five-word shingles from which documents are near copies.
NEAR_PERCENT = 80
#: SQL can't express the trees, the minima and the fingerprints.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    scored = quality_classifier.with_score(docs, model)
    return unpacked(scored.where(F.col("score") >= QUALITY_THRESHOLD), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of other documents go; ``n_chars`` follows the text."""
    clean = line_dedup.line_dedup(docs)
    changed = F.col("n_dropped") > 0
    old = lambda c: F.col("row").getField(c)
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(old("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length("clean_text").cast(docs.schema["n_chars"].dataType)).otherwise(old("n_chars"))
    return unpacked(clean, docs.columns, **new)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, and
    of rows that share it the one whose text's hash is smallest."""
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64(text_of()).alias("hash")))
    judged = materialize(near_dedup.near_dedup(docs.select(key.alias("doc_id"), "text"), NEAR_PERCENT)
                         .where("doc_id IS NOT NULL"), "near")
    gone = judged.where("NOT kept").select("doc_id").distinct()
    repeated = judged.groupBy("doc_id").count().where("count > 1").select("doc_id")
    keys = materialize(gone.unionByName(repeated).distinct(), "near_keys")
    rows = packed(docs, key.alias("id"))
    blocks, n_blocks = bloom_filter(keys, "doc_id")
    tested = with_possible(rows, F.col("id"), blocks, n_blocks)
    maybe = tested.where("possible").join(gone.withColumnRenamed("doc_id", "id"), "id", "left_anti")
    one = maybe.groupBy("id").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return unpacked(tested.where("NOT possible").select("row").unionByName(one.select("row")), docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    hit = materialize(decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
                      .select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash")).distinct(), "leaks")
    rows = packed(docs, F.col("doc_id").alias("id"), F.xxhash64(text_of()).alias("hash"))
    blocks, n_blocks = bloom_filter(hit, "h_hash")
    tested = with_possible(rows, F.col("hash"), blocks, n_blocks)
    maybe = tested.where("possible").join(hit, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("hash") == F.col("h_hash")), "left_anti")
    return unpacked(tested.where("NOT possible").select("row").unionByName(maybe.select("row")), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with ``target``, ``taken`` and ``first_slot``;
    rows equal in id, text and source share their words evenly (rounded down)."""
    key = F.xxhash64(text_of())
    with_hash = docs.select(F.struct(F.col("doc_id").alias("doc_id"), key.alias("hash")).alias("doc_id"), "source", "text")
    taken = (mixing.mix(with_hash).groupBy(F.col("doc_id.doc_id").alias("t_id"), F.col("doc_id.hash").alias("t_hash"),
                                           F.col("source").alias("t_source"))
             .agg(F.max("target").alias("target"), F.floor(F.sum("taken") / F.count("*")).cast("long").alias("taken"),
                  F.min("first_slot").alias("first_slot"))
             .where("taken > 0"))
    rows = packed(docs, F.col("doc_id").alias("id"), key.alias("hash"), F.col("source").cast("string").alias("s"))
    met = rows.join(taken, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("hash") == F.col("t_hash"))
                    & F.col("s").eqNullSafe(F.col("t_source")))
    added = ("target", "taken", "first_slot")
    used = {c.lower() for c in docs.columns}
    own = []
    for c in docs.columns:
        name = c
        if c.lower() in added:
            name += "_given"
            while name.lower() in used:
                name += "_"
            used.add(name.lower())
        own.append(F.col("row").getField(c).alias(name))
    return met.select(*own, *added)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near dedup", near),
          ("benchmark decontamination", benchmark_leaks), ("source mix", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
