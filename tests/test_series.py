import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import exact_quantiles, sample_kurtosis, sample_skewness
from tidemark.functions.timebins import bin_start, from_seconds, ntz, seconds_of
from tidemark.operators import series as S
from tidemark.operators.blocks import with_successor
from tidemark.operators.correlation import feature_correlation
from tidemark.operators.features import feature_columns
from tidemark.plans.inputs import OUTAGE, logs, series


def test_status_classes(spark):
    df = spark.createDataFrame([(c, "/") for c in (-1, 0, 99, 199, 200, 299, 399, 404, 599, 600)], "status_code int, url string")
    got = [r.status_category for r in S.add_derived_columns(df).collect()]
    assert got == [None, "1xx", "1xx", "1xx", "2xx", "2xx", "3xx", "4xx", "5xx", None]


def test_url_parts(spark):
    df = spark.createDataFrame([(200, u) for u in ("/a.b/c", "/x.GIF?y=1.z", "/p/", "/q.tar.gz")], "status_code int, url string")
    assert [r.url_extension for r in S.add_derived_columns(df).collect()] == ["none", "GIF", "none", "gz"]


@pytest.mark.parametrize("freq,width", [("1min", 60), ("15min", 900), ("1h", 3600)])
def test_counts_and_grid(spark, sf_dir, freq, width):
    total, s = logs(spark, sf_dir).count(), series(spark, sf_dir, freq, ())
    r = s.agg(F.sum("request_count").alias("n"), F.count("*").alias("bins"), F.min("ts").alias("lo"), F.max("ts").alias("hi"),
              F.max(F.col("success_count") + F.col("error_count") - F.col("request_count")).alias("over")).first()
    assert r.n == total and r.over <= 0
    assert r.bins == (r.hi - r.lo).total_seconds() / width + 1


def test_one_row_bin_has_zero_spread_and_empty_bin_no_mean(spark):
    df = spark.sql("SELECT 'h' AS host, t AS timestamp, 200 AS status_code, CAST(5 AS BIGINT) AS bytes FROM VALUES "
                   "(TIMESTAMP_NTZ'2024-01-01 00:00:10'), (TIMESTAMP_NTZ'2024-01-01 00:45:00') AS v(t)")
    rows = S.traffic_series(df, "15min").orderBy("ts").collect()
    assert [r.request_count for r in rows] == [1, 0, 0, 1] and rows[0].bytes_std == 0.0
    assert rows[1].bytes_mean is None and rows[1].error_rate == 0.0


def test_long_gap_is_filled_whole(spark):
    df = spark.sql("SELECT 'h' AS host, t AS timestamp, 200 AS status_code, CAST(5 AS BIGINT) AS bytes FROM VALUES "
                   "(TIMESTAMP_NTZ'2024-01-01 00:00:10'), (TIMESTAMP_NTZ'2024-01-04 00:00:00') AS v(t)")
    s = S.traffic_series(df, "1min")
    assert s.count() == s.select("ts").distinct().count() == 3 * 1440 + 1


def test_successors_cross_chunks_and_holes(spark):
    rng = np.random.default_rng(5)
    parts = [("a", np.sort(rng.choice(400 * 1440, 300, replace=False))), ("b", np.array([0, 1, 300 * 1440])), (None, np.array([7]))]
    rows = [(k, int(m) * 60) for k, x in parts for m in x]
    df = spark.createDataFrame(rows, "k string, s bigint").select("k", from_seconds(F.col("s")).alias("ts"), F.lit(1).cast("bigint").alias("request_count"))
    for k, x in parts:
        own = df.where(F.col("k").eqNullSafe(F.lit(k)))
        for frame, keys in ((own, ["k"]), (own.drop("k"), [])):
            got = with_successor(frame, keys, "ts").select(seconds_of("ts").alias("s"), seconds_of("_next").alias("n")).orderBy("s").collect()
            assert [(r.s, r.n) for r in got] == [(int(m) * 60, int(x[i + 1]) * 60 if i + 1 < len(x) else None) for i, m in enumerate(x)]
    gaps = {(r.k, r.duration_minutes) for r in S.detect_gaps(df, 5, ["k"]).collect()}
    assert gaps == {(k, float(d)) for k, x in parts for d in np.diff(x) if d > 5}
    grid = S.fill_grid(df.where("k = 'b'"), "1min", ["k"])
    assert grid.count() == grid.select("ts").distinct().count() == 300 * 1440 + 1 and grid.agg(F.sum("request_count")).first()[0] == 3


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (2.0, 1.0, None), (3.0, 1.0, 5.0)], "t double, flat double, x double")
    got = {r.feature: r.correlation for r in feature_correlation(df, ["flat", "x"], "t").collect()}
    assert got["flat"] is None and abs(got["x"] - 1) < 1e-12


def test_bins_before_1970_and_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:52:00.5' AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert str(df.select(bin_start("t", "15min")).first()[0]) == "1969-12-31 23:45:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_outage_flag_uses_bin_start(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'1995-08-01 14:45:00', TIMESTAMP_NTZ'1995-08-01 15:15:00', INTERVAL 15 MINUTES)) AS ts")
    assert [r.is_storm_period for r in S.mark_outages(df).orderBy("ts").collect()] == [0, 1, 1]


def test_outage_table_equals_list(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", "is_storm_period")
    table = spark.createDataFrame([OUTAGE, (OUTAGE[0], "2024-01-11 00:00:00")], "a string, b string") \
        .select(ntz_col("a").alias("outage_start"), ntz_col("b").alias("outage_end"))
    out = S.mark_outages_from_table(s, table, name="flag")
    assert out.count() == s.count() and out.where("flag <> is_storm_period").count() == 0


def ntz_col(c):
    return F.col(c).cast("timestamp_ntz")


def test_exact_quantiles_with_a_dominant_value(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.full(4000, 7.0), rng.normal(0, 100, 3001)])
    df = spark.createDataFrame([("a", float(v)) for v in vals] + [("b", 1.0), ("b", 2.0), (None, 4.0)], "k string, v double")
    got = {r.k: r for r in exact_quantiles(df, "v", {"q1": .25, "q2": .5, "q9": .901}, ["k"], pieces=16).collect()}
    for name, p in (("q1", .25), ("q2", .5), ("q9", .901)):
        assert abs(got["a"][name] - np.quantile(vals, p)) < 1e-9
    assert got["b"].q2 == 1.5 and got[None].q2 == 4.0


def test_bias_corrected_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = df.agg(sample_skewness("x").alias("s"), sample_kurtosis("x").alias("k")).first()
    x = pd.Series([1.0, 2.0, 3.0, 10.0])
    assert abs(r.s - x.skew()) < 1e-12 and abs(r.k - x.kurt()) < 1e-12


def test_feature_column_selection(spark, sf_dir):
    s = series(spark, sf_dir, "1h").withColumn("hour", F.hour("ts"))
    assert feature_columns(s, keys=["event_type"]) == ["hour"]
    assert "request_count" in feature_columns(s, exclude_targets=False, keys=["event_type"])


def test_inputs_are_checked(spark):
    with pytest.raises(ValueError):
        S.traffic_series(spark.range(1), "15min")


def test_summary_counts_missing_sizes_and_nothing(spark):
    rows = [("a", 200, 10, "1995-07-01 00:00:00"), ("a", 200, 10, "1995-07-01 00:10:00"), ("b", 304, None, "1995-07-02 00:00:00"), (None, 404, 40, "1995-07-04 01:00:00"),
            ("b", 503, 30, "1995-07-03 00:00:00"), ("c", None, None, "1995-07-03 00:00:00")]
    logs = spark.createDataFrame(rows, "host string, status_code int, bytes bigint, t string").withColumn("timestamp", F.to_timestamp_ntz("t")).drop("t")
    r = S.data_summary(logs).first()
    assert (r.total_records, r.success_2xx, r.redirect_3xx, r.client_error_4xx, r.server_error_5xx) == (6, 2, 1, 1, 1)
    assert (r.bytes_total, r.bytes_mean, r.bytes_median, r.bytes_max, r.unique_hosts, r.duration_days) == (90, 22.5, 20.0, 40, 3, 3)
    e = S.data_summary(logs.limit(0)).first()
    assert (e.total_records, e.success_2xx, e.unique_hosts, e.bytes_total, e.bytes_mean, e.bytes_median, e.start) == (0, 0, 0, None, None, None, None)
