"""NULL labels, keys and groups, NaN inputs and unreadable tables."""

import pytest
from pyspark.errors import AnalysisException

from churnspark.operators import features, metrics, stats
from churnspark.operators.split import stratified_split
from churnspark.session import read_or_empty


def test_split_keeps_null_labels_and_keys(spark):
    rows = [(f"k{i}", i % 2) for i in range(40)] + [(f"n{i}", None) for i in range(20)] + [(None, 1), (None, None)]
    out = stratified_split(spark.createDataFrame(rows, "key string, y int"), "key", "y").collect()
    assert sorted(map(str, ((r.key, r.y) for r in out))) == sorted(map(str, rows))
    assert {r.split for r in out if r.y is None} == {"train", "val", "test"}


def test_auc_keeps_the_null_group(spark):
    rows = [(g, i % 2, i / 10) for g in ("a", None) for i in range(10)]
    out = metrics.roc_auc(spark.createDataFrame(rows, "g string, y int, s double"), "y", "s", group_cols=["g"]).collect()
    assert {r.g for r in out} == {"a", None}


def test_nan_is_missing_in_fill_and_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,)], "x double")
    assert sorted(r.x for r in features.fill_apply(df, {"x": 2.0}).collect()) == [1.0, 2.0, 2.0, 4.0]
    r = stats.mean_std(df, ["x"]).first()
    assert abs(r["mean"] - 7 / 3) < 1e-12 and r["n"] == 3


def test_distinct_values_are_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "v string")
    assert [r.value for r in stats.distinct_sorted(df, ["v"]).collect()] == ["a", "b", "c"]


def test_only_a_missing_path_reads_as_empty(spark, tmp_dir):
    empty = lambda: spark.createDataFrame([], "a int")
    assert read_or_empty(lambda: spark.read.parquet(f"{tmp_dir}/none"), empty).count() == 0
    with open(f"{tmp_dir}/part.parquet", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception):  # noqa: B017
        read_or_empty(lambda: spark.read.parquet(f"{tmp_dir}/part.parquet"), empty).count()
    with pytest.raises(AnalysisException):
        read_or_empty(lambda: spark.range(1).select("missing"), empty)
