"""Feature preparation: fills, encoders, scaler (fit on train only)."""

import pytest
from pyspark.sql import functions as F

from churnspark.operators import features as FE, stats as ST
from churnspark.profile import TELCO
from telco import random_rows, schema_ddl

CAT = list(TELCO.categorical)
NUM = list(TELCO.numeric)


@pytest.fixture(scope="module")
def telco(spark):
    rows = random_rows(100, 42)
    return spark.createDataFrame([tuple(r[c] for c, _ in TELCO.contract) for r in rows], schema_ddl())


def nulls(df, cols):
    return df.select([F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()


def test_impute_numeric_and_categorical(telco):
    out = FE.impute_self(telco, NUM, CAT)
    assert all(v == 0 for v in nulls(out, NUM + CAT).values())


def test_mode_ties_and_median(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 10.0), (None, None)], "c string, x double")
    assert ST.mode(df, ["c"]).first()["mode_value"] == "a"
    assert ST.median(df, ["x"]).first()["median"] == 2.5


def test_median_matches_percentile(spark):
    df = spark.range(0, 5001).select((F.col("id") * 7919 % 1009).cast("double").alias("x"),
                                     (F.col("id") % 13).cast("double").alias("y"))
    got = {r[0]: r[1] for r in ST.median(df, ["x", "y"], n_buckets=16).collect()}
    exp = df.agg(F.percentile("x", 0.5), F.percentile("y", 0.5)).first()
    assert got == {"x": exp[0], "y": exp[1]}


def test_all_null_categorical(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "c string, x double")
    fills = {r["col_name"]: r for r in FE.fill_fit(df, ["x"], ["c"]).collect()}
    assert fills["c"]["cat_fill"] == "Unknown" and fills["x"]["num_fill"] == 1.5
    with pytest.raises(ValueError):
        FE.impute_self(df, ["x"], ["c"])


def test_encode_ints(telco):
    filled = FE.impute_self(telco, NUM, CAT)
    enc = FE.label_encode_fit(filled, CAT)
    assert enc.select("col_name").distinct().count() == 15
    codes = FE.label_encode_apply(filled, enc, CAT)
    assert all(dict(codes.dtypes)[c] == "int" for c in CAT)
    contract = {r["value"]: r["code"] for r in enc.where("col_name = 'Contract'").collect()}
    assert contract == {"Month-to-month": 0, "One year": 1, "Two year": 2}   # sorted text order


def test_encode_reuse_unseen(spark, telco):
    filled = FE.impute_self(telco, NUM, CAT)
    enc = FE.label_encode_fit(filled, CAT)
    other = spark.createDataFrame([("Female", "Carrier pigeon"), (None, "DSL")], "gender string, InternetService string")
    for strategy in ("literal", "join"):
        got = FE.label_encode_apply(other, enc, ["gender", "InternetService"], strategy=strategy).collect()
        assert [tuple(r) for r in got] == [(0, -1), (-1, 0)]


def test_literal_over_cap_uses_join(spark, telco):
    filled = FE.impute_self(telco, NUM, CAT)
    enc = FE.label_encode_fit(filled, CAT)
    other = spark.createDataFrame([("Female", "Carrier pigeon"), (None, "DSL")], "gender string, InternetService string")
    # a cap below the dictionary size: the literal request must not collect it whole
    got = FE.label_encode_apply(other, enc, ["gender", "InternetService"], strategy="literal",
                                max_literal=2).collect()
    assert [tuple(r) for r in got] == [(0, -1), (-1, 0)]


def test_scale(telco):
    filled = FE.impute_self(telco, NUM, CAT)
    sc = FE.scale_fit(filled, NUM)
    out = FE.scale_apply(filled, sc)
    stats = out.agg(*[F.avg(c).alias(f"m_{c}") for c in NUM], *[F.stddev_pop(c).alias(f"s_{c}") for c in NUM]).first()
    for c in NUM:
        assert abs(stats[f"m_{c}"]) < 1e-9 and abs(stats[f"s_{c}"] - 1) < 1e-9


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    sc = FE.scale_fit(df, ["x"])
    assert sc.first()["scale"] == 1.0
    assert [r[0] for r in FE.scale_apply(df, sc).collect()] == [0.0, 0.0]


def test_fit_on_train_only(spark, telco):
    """Changing non-train rows must not change any fitted parameter."""
    df = telco.withColumn("split", F.when(F.col("customerID") < "C0070", "train").otherwise("test"))
    a = FE.fit_all(df.where("split = 'train'"), NUM, CAT)
    changed = df.withColumn("tenure", F.when(F.col("split") == "test", F.lit(999)).otherwise(F.col("tenure")))
    b = FE.fit_all(changed.where("split = 'train'"), NUM, CAT)
    for x, y in ((a.fills, b.fills), (a.encoders, b.encoders), (a.scaler, b.scaler)):
        assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
    applied = FE.apply_all(df, a, CAT, NUM)
    assert all(v == 0 for v in nulls(applied, NUM + CAT).values())


def test_state_roundtrip(spark, telco, tmp_dir):
    st = FE.fit_all(telco, NUM, CAT)
    st.save(tmp_dir + "/state")
    back = FE.FittedState.load(spark, tmp_dir + "/state")
    for x, y in ((st.fills, back.fills), (st.encoders, back.encoders), (st.scaler, back.scaler)):
        assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
