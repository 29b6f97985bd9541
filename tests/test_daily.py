import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.correlation import acf
from tidemark.operators.cv import cutoff_products, cutoff_scores
from tidemark.operators.series import traffic_series
from tidemark.sources import daily

LOG = "host string, timestamp timestamp_ntz, url string, status_code int, bytes bigint"


def records(spark, stamps):
    return spark.createDataFrame([(f"h{i % 3}", None if s is None else pd.Timestamp(s).to_pydatetime(), "/", 200, i) for i, s in enumerate(stamps)], LOG)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_two_batches_equal_one_and_leave_other_days_alone(spark, tmp_path):
    first = records(spark, ["1995-07-01 00:05:00", "1995-07-02 10:00:00", "1995-07-02 11:00:00", None])
    second = records(spark, ["1995-07-02 11:30:00", "1995-07-02 11:00:30", "1995-07-05 23:59:59"])
    store, path = str(tmp_path / "store"), str(tmp_path / "series")
    daily.ingest_batch(first, "a", store, path, ("15min", "1h"))
    before = files(path)
    daily.ingest_batch(second, "b", store, path, ("15min", "1h"))
    after = files(path)
    kept = {f: t for f, t in before.items() if "day=1995-07-01" in f}
    assert kept and all(after.get(f) == t for f, t in kept.items())
    assert not any(f in after for f in before if "day=1995-07-02" in f)
    whole = first.where("timestamp is not null").unionByName(second)
    for g in ("15min", "1h"):
        got = rows(daily.load_days(spark, path, g))
        assert got == rows(traffic_series(whole, g))
        daily.ingest_batch(second, "b", store, path, ("15min", "1h"))
        assert rows(daily.load_days(spark, path, g)) == got


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    store, path = str(tmp_path / "store"), str(tmp_path / "series")
    daily.ingest_batch(records(spark, ["1995-07-01 00:05:00"]), "a", store, path, ("1h",))
    before = files(path)
    daily.ingest_batch(records(spark, [None]), "b", store, path, ("1h",))
    assert files(path) == before


@pytest.mark.parametrize("lags, block", [(7, 16), (1440, 2048)])
def test_spectral_products_equal_direct_sums(spark, lags, block):
    x = np.random.default_rng(5).poisson(20, 3000).astype("float64")
    at = pd.date_range("2024-01-01", periods=len(x), freq="1min")
    df = spark.createDataFrame(pd.DataFrame({"ts": at, "x": x})).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = acf(df, "x", lags, block_rows=block).toPandas().sort_values("lag")["acf"].to_numpy()
    d = x - x.mean()
    want = [d[k:] @ d[: len(d) - k] / (d @ d) for k in range(lags + 1)]
    assert np.abs(got - want).max() < 1e-9


def test_a_series_shorter_than_the_lags(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) as ts, double(id % 3) as x from range(5)")
    got = acf(df, "x", 8).toPandas().sort_values("lag")["acf"].to_numpy()
    assert got[0] == pytest.approx(1) and np.abs(got[5:]).max() < 1e-12


@pytest.mark.parametrize("horizon", [0.5, 1, 2.25])
def test_cutoffs_by_running_sums_equal_one_fit_each(spark, horizon):
    rng = np.random.default_rng(3)
    n = 24 * 12
    frame = pd.DataFrame({"k": np.repeat(["a", "b"], n), "ts": np.tile(pd.date_range("2024-01-01", periods=n, freq="1h"), 2), "x": rng.normal(size=2 * n)})
    frame["y"] = 2 + 3 * frame["x"] + rng.normal(size=2 * n)
    holes = (frame["k"] == "b") & frame["ts"].between("2024-01-06", "2024-01-09")
    frame.loc[rng.random(2 * n) < 0.05, "x"] = np.nan
    frame = frame[~holes]
    df = spark.createDataFrame(frame).withColumns({"ts": F.col("ts").cast("timestamp_ntz"), "x": F.when(~F.isnan("x"), F.col("x"))})
    got = cutoff_scores(df, ["x"], "y", 4, 1, horizon, ["k"]).toPandas()
    assert len(got) > 8 and got["gradient"].max() < 1e-9
    for r in got.itertuples():
        part = frame[(frame["k"] == r.k) & frame["x"].notna()]
        train = part[part["ts"] <= r.cutoff]
        test = part[(part["ts"] > r.cutoff) & (part["ts"] <= r.cutoff + pd.Timedelta(days=horizon))]
        assert (r.n_train, r.n_test) == (len(train), len(test))
        beta = np.linalg.lstsq(np.column_stack([np.ones(len(train)), train["x"]]), train["y"], rcond=None)[0]
        assert np.allclose(r.coef, beta)
        if len(test):
            assert r.mse == pytest.approx(((test["y"] - beta[0] - beta[1] * test["x"]) ** 2).mean(), rel=1e-9)
        else:
            assert np.isnan(r.mse)


def test_cutoffs_without_keys_and_of_short_series(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as ts, double(id) as x, double(id * 2) as y from range(240)")
    assert cutoff_products(df, ["x"], "y", 20, 1, 1).count() == 0
    got = cutoff_scores(df, ["x"], "y", 5, 2, 1).toPandas()
    assert len(got) == 2 and got["rmse"].max() < 1e-6
