"""Inference-log sink and source (JSON lines, partitioned by model and day).

Layout: ``<root>/model=<m>/date=<YYYY-MM-DD>/part-*.json`` -- the model/day
folders of the original layout as Hive-style partitions, so a filter on
``model`` or ``date`` prunes whole folders at read time.  Writes are
append-only file commits (no read-modify-write of a day file).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.session import read_or_empty

CORRUPT = "_corrupt_record"


def log_record_schema(inputs: T.StructType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("inputs", inputs or T.MapType(T.StringType(), T.StringType())),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
    ])


def sink_log(log: DataFrame, root: str, mode: str = "append") -> None:
    """Append log rows; ``timestamp`` is written as ISO-8601 UTC text."""
    out = log.select(
        F.col("id").cast("string").alias("id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        "inputs", "prediction", "probability", "risk_level", "model",
        F.to_date("timestamp").cast("string").alias("date"))
    out.write.mode(mode).partitionBy("model", "date").json(root)


def scan_log(spark: SparkSession, root: str, inputs: T.StructType | None = None,
             with_corrupt: bool = False) -> DataFrame:
    """All log records: empty lines skipped, corrupt lines quarantined (kept
    only with ``with_corrupt``), timestamp parsed.  Only files of the
    partition layout are listed (no stray files such as a baseline)."""
    schema = log_record_schema(inputs).add(CORRUPT, T.StringType())
    # no log file yet: an empty, fully typed table
    df = read_or_empty(
        lambda: (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                 .option("basePath", root).json(f"{root}/model=*/date=*/*.json")),
        lambda: spark.createDataFrame([], schema.add("model", T.StringType()).add("date", T.DateType())))
    df = df.withColumn("timestamp", F.to_timestamp("timestamp"))
    if not with_corrupt:
        # a usable record parses and carries a timestamp; everything else is
        # quarantined (see corrupt_lines)
        df = df.where(F.col(CORRUPT).isNull() & F.col("timestamp").isNotNull()).drop(CORRUPT)
    return df


def corrupt_lines(spark: SparkSession, root: str) -> DataFrame:
    df = scan_log(spark, root, with_corrupt=True)
    return df.where(F.col(CORRUPT).isNotNull() | F.col("timestamp").isNull()).select("model", "date", CORRUPT)
