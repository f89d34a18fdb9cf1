"""Inference-log sink/scan, log analytics, payload parsing, streams."""

import os

from pyspark.sql import functions as F

from churnspark.operators import logs as L
from churnspark.plans import fixtures as fx
from churnspark.sources import logs as LG, payload as PL
from churnspark.streaming import streams as SS
from conftest import SF0001


def test_log_roundtrip_corrupt_and_empty_lines(spark, tmp_dir):
    root = tmp_dir + "/log"
    log = fx.inference_log(spark, SF0001)
    LG.sink_log(log, root)
    # a stray file outside the layout, an empty line and a corrupt line
    part = next(d for d in os.listdir(root) if d.startswith("model="))
    day = next(d for d in os.listdir(f"{root}/{part}") if d.startswith("date="))
    with open(f"{root}/{part}/{day}/extra.json", "w") as fh:
        fh.write("\n{not json\n")
    with open(f"{root}/feature_baseline.json", "w") as fh:
        fh.write('{"numeric": {}}\n')
    back = LG.scan_log(spark, root)
    assert back.count() == log.count()
    assert LG.corrupt_lines(spark, root).count() == 1
    assert back.where(F.col("model") == "click").count() == log.where(F.col("model") == "click").count()


def test_log_tables(spark):
    log = fx.inference_log(spark, SF0001)
    models = list(fx.LOG_MODELS)
    vol = L.pivot_volume(log, models)
    assert vol.count() == log.select(F.to_date("timestamp")).distinct().count()
    assert vol.select(*[F.sum(m) for m in models]).first() is not None
    assert sum(vol.select(*models).first()) >= 0
    total = sum(sum(r) for r in vol.select(*models).collect())
    assert total == log.count()
    rec = L.recent(log, 20).collect()
    assert len(rec) == 20 and [r["timestamp"] for r in rec] == sorted([r["timestamp"] for r in rec], reverse=True)
    assert {r["prediction"] for r in rec} <= {"Churn", "Stay"}
    s = L.log_summary(log, models).first()
    assert s["total"] == sum(s[f"n_{m}"] for m in models)


def test_payload_forms(spark):
    req = spark.createDataFrame([
        (1, '{"input_data": {"columns": ["b", "a"], "data": [[2, 1], [4, 3]]}}'),
        (2, '{"data": [[5, 6]]}'),
        (3, '{"rows": []}'),
        (4, "not json"),
        (5, '{"columns": ["a", "b"], "data": [[1]]}'),
    ], "request_id int, body string")
    rows, errs = PL.parse_payload(req, "body", ["a", "b"], value_type="double")
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [(1, 0, 1.0, 2.0), (1, 1, 3.0, 4.0), (2, 0, 5.0, 6.0)]
    e = {r[0]: r[1] for r in errs.collect()}
    assert e == {3: "missing 'data'", 4: "body is not a JSON object", 5: "row width differs from columns"}


def test_stream_daily_rate_equals_batch(spark, tmp_dir):
    from churnspark.plans.jobs import _stream_log
    src = (spark.readStream.schema(fx.table(spark, SF0001, "events").schema)
           .parquet(fx.stream_path(SF0001, "events")))
    SS.daily_rate_stream(_stream_log(src), tmp_dir + "/out", tmp_dir + "/ck")
    s = {(str(r[0]), r[1]): round(r[2], 12) for r in SS.daily_rate_result(spark, tmp_dir + "/out").collect()}
    b = {(str(r[0]), r[1]): round(r[2], 12) for r in L.daily_rate(fx.inference_log(spark, SF0001)).collect()}
    assert s == b
    # re-running on the same checkpoint processes nothing new and keeps the result
    SS.daily_rate_stream(_stream_log(src), tmp_dir + "/out", tmp_dir + "/ck")
    assert SS.daily_rate_result(spark, tmp_dir + "/out").count() == len(b)


def test_stream_daily_rate_counts_late_rows(spark, tmp_dir):
    schema = "timestamp timestamp, model string, prediction int"
    for days in (["2024-01-10"] * 5, ["2024-01-20"] * 5, ["2024-01-10"] * 4 + ["2024-01-01"] * 3):
        rows = spark.createDataFrame([(d, i % 2) for i, d in enumerate(days)], "d string, p int")
        rows.selectExpr("to_timestamp(d) timestamp", "'m' model", "p prediction").coalesce(1).write.mode("append").parquet(tmp_dir + "/in")
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(tmp_dir + "/in")
    SS.daily_rate_stream(log, tmp_dir + "/out", tmp_dir + "/ck")
    got = {(str(r["date"]), r["n"], round(r["churn_rate"], 9)) for r in SS.daily_rate_result(spark, tmp_dir + "/out").collect()}
    assert got == {("2024-01-10", 9, round(4 / 9, 9)), ("2024-01-20", 5, 0.4), ("2024-01-01", 3, round(1 / 3, 9))}
