"""Line dedup on DataFrame functions only (no Python on the executors).

Method: explode the lines of every text, normalise and hash each to a key,
count the distinct documents of each key, drop the lines of keys found in at
least ``min_docs`` documents everywhere but in the smallest id that holds
them, and reassemble the texts by position.

Scale: lines travel as two 64-bit hashes with id and position; counting goes
by (key, document) first, so a line that a third of all documents share is
spread over all tasks and arrives pre-aggregated at the key.  The join of the
lines with the repeated keys has one row per key on its small side, so a hot
key can be split (AQE skew join).  Texts are shuffled once, to meet their
dropped positions.

Defined cases: a null text is one empty line; a null id counts for no key and
its row stays as it is; repeated rows of one id are one document (its lines
are not repeated *across* documents); an empty table gives an empty table;
extra columns travel inside a struct, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import SPACES, ascii_lower, let, packed, text_of
from churnspark.session import materialize


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_table(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line that can be a repeat: id, hash of the text it stands
    in, position, and the 128-bit hash of its key."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
        F.posexplode(F.split(text_of(text_col), "\n")).alias("pos", "line"))
    return (lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
            .where(F.char_length("key") >= min_chars)
            .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")))


def repeated_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` distinct documents, with the smallest id."""
    per_doc = lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
    return (per_doc.groupBy("h1", "h2").agg(F.count("one").alias("n_docs"), F.min("id").alias("first_id"))
            .where(F.col("n_docs") >= min_docs).select("h1", "h2", "first_id"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = 2, min_chars: int = 10) -> DataFrame:
    """Rows of ``docs`` as struct ``row`` with ``clean_text``, ``n_lines``
    (before) and ``n_dropped``."""
    lines = materialize(line_table(docs, id_col, text_col, min_chars), "lines")
    # written, so that both sides of the join are dealt out for it alone and a hot key can be split
    repeated = materialize(repeated_keys(lines, min_docs), "repeated")
    dropped = (lines.join(repeated, ["h1", "h2"])
               .where(F.col("id") != F.col("first_id"))
               .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone")))
    rows = packed(docs, F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    joined = rows.join(dropped, ["id", "text_hash"], "left")
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))

    def kept(all_lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
        return F.array_join(F.transform(left, lambda p: F.get(all_lines, p)), "\n")

    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), text).otherwise(let(F.split(text, "\n"), kept)).alias("clean_text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
