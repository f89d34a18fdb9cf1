"""Header CSV with an explicit all-string schema (no inference pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.functions.scalar import NA_TOKENS, null_tokens_to_null


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str], tokens=NA_TOKENS,
             corrupt_col: str | None = None) -> DataFrame:
    """Read header CSV files as text columns; pandas NA tokens -> NULL.

    Malformed lines are kept (PERMISSIVE); with ``corrupt_col`` their raw
    text lands in that column.
    """
    schema = string_schema(columns)
    r = (spark.read.option("header", True).option("mode", "PERMISSIVE")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if corrupt_col:
        schema = schema.add(corrupt_col, T.StringType())
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    df = r.schema(schema).csv(path)
    return df.select(*[null_tokens_to_null(c, tokens).alias(c) for c in columns],
                     *([F.col(corrupt_col)] if corrupt_col else []))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; NULL is written as an empty field; blanks are kept."""
    (df.write.mode("overwrite").option("header", True).option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
