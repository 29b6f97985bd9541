from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.inputs import clf_lines, logs, series
from tidemark.plans.q_capacity import CONFIG
from tidemark.sources import clf
from tidemark.streaming import traffic as ST


def write_in_order(df, path, cuts, ts):
    """One directory part per time slice, written one after another, so files arrive in order."""
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        part = df
        part = part if lo is None else part.where(F.col(ts) >= F.lit(lo).cast("timestamp_ntz"))
        part = part if hi is None else part.where(F.col(ts) < F.lit(hi).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(path)


def files(spark, schema, path, per_trigger=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


@pytest.mark.parametrize("exact", [True, False])
def test_stream_equals_batch_on_closed_bins(spark, sf_dir, tmp_path, exact):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    log = logs(spark, sf_dir)
    write_in_order(log, src, ["2024-01-09", "2024-01-20"], "timestamp")
    ST.run_to_parquet(ST.traffic_stream(files(spark, log.schema, src), "1h", ["event_type"], exact=exact), out, str(tmp_path / "c"))
    got = spark.read.parquet(out)
    end = log.agg(F.max("timestamp")).first()[0]
    want = series(spark, sf_dir, "1h", fill=False).where(F.col("ts") + F.expr("INTERVAL 2 HOURS") <= F.lit(str(end)).cast("timestamp_ntz"))
    cols = ["event_type", "ts", "request_count", "bytes_total", "success_count", "error_count", "server_error_count"] + (["unique_hosts"] if exact else [])
    assert got.count() == want.count() > 0
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    diff = got.join(want.select("event_type", "ts", F.col("bytes_std").alias("s")), ["event_type", "ts"])
    assert diff.where(F.abs(F.col("bytes_std") - F.col("s")) > 1e-6).count() == 0


def test_late_rows_are_dropped(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    row = lambda t: ("h", datetime.fromisoformat(t), 200, 5)
    schema = "host string, timestamp timestamp_ntz, status_code int, bytes bigint"
    for day in (["2024-01-01T00:05"], ["2024-01-01T05:00"], ["2024-01-01T09:00"], ["2024-01-01T00:06", "2024-01-01T12:00"]):
        spark.createDataFrame([row(t) for t in day], schema).coalesce(1).write.mode("append").parquet(src)
    ST.run_to_parquet(ST.traffic_stream(files(spark, schema, src), "1h"), out, str(tmp_path / "c"))
    assert {(str(r.ts), r.request_count) for r in spark.read.parquet(out).collect()} == {
        (f"2024-01-01 0{h}:00:00", 1) for h in (0, 5, 9)}


def test_needs_utc(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            ST.traffic_stream(logs(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_stream_keeps_every_line(spark, sf_dir, tmp_path):
    lines = clf_lines(spark, sf_dir)
    src = str(tmp_path / "in")
    lines.repartition(3).write.parquet(src)
    stream = files(spark, lines.schema, src)
    ST.parse_stream(stream, str(tmp_path / "g"), str(tmp_path / "r"), str(tmp_path / "c"), keep=("event_id",)).awaitTermination()
    good, bad = spark.read.parquet(str(tmp_path / "g")), spark.read.parquet(str(tmp_path / "r"))
    stats = clf.parse_stats(clf.parse(lines)).first()
    assert (good.count(), bad.count()) == (stats.success, stats.failed)
