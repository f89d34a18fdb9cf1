"""Baseline profile as two Parquet tables under one folder: ``numeric``
(feature, mean, std), one row per feature, and ``categorical`` (feature,
value, p), one row per feature and value.  The data bound the number of
values, so no row or task holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnspark.session import read_or_empty

NUMERIC = "feature string, mean double, std double"
CATEGORICAL = "feature string, value string, p double"


def write_profile(num: DataFrame, cat: DataFrame, path: str) -> None:
    num.select("feature", "mean", "std").write.mode("overwrite").parquet(f"{path}/numeric")
    cat.select("feature", "value", "p").write.mode("overwrite").parquet(f"{path}/categorical")


def read_profile(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(num_profile, cat_profile); empty tables when they are absent."""

    def read(name: str, schema: str) -> DataFrame:
        return read_or_empty(lambda: spark.read.schema(schema).parquet(f"{path}/{name}"),
                             lambda: spark.createDataFrame([], schema))

    return read("numeric", NUMERIC), read("categorical", CATEGORICAL)
