"""Property tests: distributed forms equal their plain definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnspark.operators import drift as D, metrics as M, stats as ST
from churnspark.sources import profiles as PR

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

scores = st.lists(st.tuples(st.integers(0, 20).map(lambda x: x / 20.0), st.integers(0, 1)), min_size=2, max_size=60)


@settings(**SETTINGS)
@given(rows=scores)
def test_auc_equals_pairwise_definition(spark, rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    df = spark.createDataFrame(rows, "s double, y int")
    got = M.roc_auc(df, "y", "s", n_buckets=4).first()["roc_auc"]
    if not pos or not neg:
        assert got is None
        return
    exp = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-12


@settings(**SETTINGS)
@given(xs=st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40))
def test_median_equals_sorted_middle(spark, xs):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")
    got = ST.median(df, ["x"], n_buckets=4).first()["median"]
    v = sorted(x for x in xs if x is not None)
    if not v:
        assert got is None
        return
    n = len(v)
    assert got == (v[(n - 1) // 2] + v[n // 2]) / 2


def test_profile_json_roundtrip(spark, tmp_dir):
    base = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (5.0, "b")], "x double, c string")
    num, cat = D.baseline_profile(base, ["x"], ["c"])
    PR.write_profile(num, cat, tmp_dir + "/p")
    n2, c2 = PR.read_profile(spark, tmp_dir + "/p")
    assert sorted(map(tuple, num.collect())) == sorted(map(tuple, n2.collect()))
    assert sorted(map(tuple, cat.collect())) == sorted(map(tuple, c2.collect()))
    e1, e2 = PR.read_profile(spark, tmp_dir + "/absent")
    assert e1.count() == 0 and e2.count() == 0
    assert D.drift_report(base, e1, e2).count() == 0       # no baseline -> empty typed report
    assert D.drift_report(base.where(F.lit(False)), num, cat).where("drift_score is not null").count() == 1


def test_profile_is_written_one_row_per_value(spark, tmp_dir):
    num = spark.createDataFrame([("x", 1.0, 2.0)], "feature string, mean double, std double")
    cat = spark.range(3000).selectExpr("'c' AS feature", "cast(id AS string) AS value", "1 / 3000D AS p").repartition(4)
    PR.write_profile(num, cat, tmp_dir + "/p")
    assert spark.read.parquet(tmp_dir + "/p/categorical").count() == 3000
    assert PR.read_profile(spark, tmp_dir + "/p")[1].rdd.getNumPartitions() > 1
