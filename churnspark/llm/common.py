"""Column helpers shared by the text operators.

A *word* is a maximal run of characters other than space and U+0009..U+000D;
``ascii_lower`` changes A-Z alone.  All helpers are Spark expressions.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import churnspark

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
NON_SPACE = "[^\\x20\\x09-\\x0D]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``
    (a lambda variable: Catalyst can't inline it into every use)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of ``text`` (empty for a text without words)."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def n_words(text: Column) -> Column:
    """Number of words of ``text`` as long."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_RUN))).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged.  Pure ASCII strings take
    the byte-wise ``lower``; only others pay for the per-character map."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def fold(mod: int, id_col: str = "doc_id") -> Column:
    """``crc32(id as text) mod``; a null id gets -1 (it is in no fold)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod, F.lit(-1)).cast("int")


def packed(docs: DataFrame, *extra: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``row`` plus named extras, so that
    helper columns never clash with the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *extra)


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The caller's columns back from ``row``; ``replaced`` overrides some."""
    return df.select(*[(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in columns])


@cache
def _shipped(application: str) -> None:
    """Send this package to the executors' Python workers, once per application."""
    home = Path(churnspark.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="churnspark-ship-"), "churnspark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(home.rglob("*.py")):
            out.write(f, f.relative_to(home.parent))
    SparkSession.active().sparkContext.addPyFile(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable for Python functions on any executor."""
    _shipped(spark.sparkContext.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` whose workers can import this package wherever they run."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
