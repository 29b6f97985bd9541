"""Blocked windows equal plain ones, whatever the block size and however positions are found."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomaly as A
from tidemark.operators import correlation as R
from tidemark.operators import features as X
from tidemark.operators import isolation as I


def collect(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


@pytest.mark.parametrize("options", [{"width": "1h"}, {}, {"width": "1h", "block_rows": 64}, {"block_rows": 70}])
def test_features_equal_pandas(hourly, options):
    pdf, df = hourly
    got = collect(X.all_features(df, "x", None, ["k"], lags=[1, 24], windows=[5, 24], diff_periods=[1, 24], ewm_spans=[2, 5], **options), "k", "ts")
    for k, g in pdf.groupby("k"):
        mine, x = got[got.k == k].reset_index(drop=True), g.x.reset_index(drop=True)
        want = {
            "x_lag_24": x.shift(24), "x_rolling_mean_24": x.rolling(24, min_periods=1).mean(),
            "x_rolling_std_5": x.rolling(5, min_periods=1).std().fillna(0), "x_rolling_max_24": x.rolling(24, min_periods=1).max(),
            "x_rolling_min_5": x.rolling(5, min_periods=1).min(), "x_diff_24": x.diff(24),
            "x_pct_change_1": x.pct_change(1).replace([np.inf, -np.inf], np.nan),
            "x_ewm_2": x.ewm(span=2, adjust=False).mean(), "x_ewm_5": x.ewm(span=5, adjust=False).mean(),
        }
        assert len(mine) == len(x)
        for name, w in want.items():
            np.testing.assert_allclose(mine[name].astype(float), w.astype(float), rtol=1e-9, atol=1e-9, err_msg=f"{k} {name}")


def test_positions_skip_removed_rows(hourly):
    pdf, df = hourly
    cut = ("2024-01-03 05:00:01", "2024-01-05 07:00:00")
    clean = df.where(~F.col("ts").between(F.lit(cut[0]).cast("timestamp_ntz"), F.lit(cut[1]).cast("timestamp_ntz")))
    a = collect(X.add_lags(clean, "x", [1, 3], ["k"], width="1h", removed=[cut], block_rows=16), "k", "ts")
    b = collect(X.add_lags(clean, "x", [1, 3], ["k"]), "k", "ts")
    pd.testing.assert_frame_equal(a, b)


@pytest.mark.parametrize("block_rows", [32, 8192])
def test_ordered_helpers(hourly, block_rows):
    pdf, df = hourly
    naive = collect(X.naive_forecast(df, "x", 4, ["k"], width="1h", block_rows=block_rows), "k", "ts")
    ahead = collect(X.look_ahead(df, "x", 15, ["k"], width="1h", block_rows=block_rows), "k", "ts")
    mean = collect(X.centered_mean(df, "x", 7, ["k"], width="1h", block_rows=block_rows), "k", "ts")
    full = collect(X.rolling_full(df, "x", 6, ["k"], width="1h", block_rows=block_rows), "k", "ts")
    sup = collect(X.supervised(df.withColumn("f", F.col("x")), "x", ["f"], 2, keys=["k"], width="1h", block_rows=block_rows), "k", "ts")
    for k, g in pdf.groupby("k"):
        x = g.x.reset_index(drop=True)
        eq = lambda f, c, w: np.testing.assert_allclose(f[f.k == k][c].astype(float), w.astype(float), rtol=1e-12)
        eq(naive, "prediction", x.rolling(4).mean().shift(1).bfill())
        eq(ahead, "x_ahead", x.iloc[np.minimum(np.arange(len(x)) + 15, len(x) - 1)])
        eq(mean, "x_centered_7", x.rolling(7, center=True).mean())
        eq(full, "x_mean_6", x.rolling(6).mean())
        eq(sup, "label", x.shift(-2).dropna())


def test_align_carries_across_chunks(spark):
    t = pd.date_range("2024-01-01", periods=200, freq="D")
    left = spark.createDataFrame(pd.DataFrame({"ts": t})).select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    right = left.where(F.dayofyear("ts").isin(3, 5)).withColumn("v", F.dayofyear("ts"))
    got = collect(X.align_ffill(left, right, "v"), "ts").v
    assert got.isna().sum() == 2 and got.iloc[2] == 3 and (got.iloc[4:] == 5).all()


@pytest.mark.parametrize("block_rows", [32, 8192])
def test_detectors_equal_pandas(hourly, block_rows):
    pdf, df = hourly
    got = collect(A.detect(df, "x", ["zscore", "iqr", "rolling", "spike", "drop"], keys=["k"], width="1h", block_rows=block_rows), "k", "ts")
    for k, g in pdf.groupby("k"):
        x = g.x.reset_index(drop=True).astype(float)
        m = got[got.k == k].reset_index(drop=True)
        with np.errstate(all="ignore"):
            z = (x - x.mean()) / x.std()
            rs = x.rolling(24, min_periods=1).std().replace(0, x.std())
            rz = (x - x.rolling(24, min_periods=1).mean()) / rs
            base = x.rolling(4, min_periods=1).mean().shift(1).fillna(x.mean())
            sd = x.rolling(4, min_periods=1).std().shift(1).fillna(x.std())
            q1, q3 = x.quantile(.25), x.quantile(.75)
            assert (m.is_zscore == (z.abs() > 3)).all() and (m.is_rolling == (rz.abs() > 2.5)).all()
            assert (m.is_iqr == ((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1)))).all()
            assert (m.is_spike == ((x > base + 2 * sd) & (x.pct_change().abs() > 1))).all()
            assert (m.is_drop == (x < .5 * base)).all()


def test_previous_zero_counts_as_spike(spark):
    t = pd.date_range("2024-01-01", periods=8, freq="h")
    df = spark.createDataFrame(pd.DataFrame({"ts": t, "x": [5, 5, 5, 0, 0, 0, 0, 40]})).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    flags = collect(A.detect_spikes(df, "x"), "ts").is_spike.tolist()
    assert flags == [False] * 7 + [True]


@pytest.mark.parametrize("block_rows", [64, 8192])
def test_autocorrelation(hourly, block_rows):
    pdf, df = hourly
    acf = collect(R.acf(df, "x", 30, ["k"], width="1h", block_rows=block_rows), "k", "lag")
    pacf = collect(R.pacf(df, "x", 10, ["k"], width="1h", block_rows=block_rows), "k", "lag")
    x = pdf[pdf.k == "a"].x.to_numpy(float)
    d = x - x.mean()
    want = np.array([d[k:] @ d[: len(d) - k] for k in range(31)]) / (d @ d)
    np.testing.assert_allclose(acf[acf.k == "a"].acf, want, atol=1e-10)
    mine = pacf[pacf.k == "a"].pacf.to_numpy()
    for k in (1, 2, 5, 10):
        m = np.array([[want[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(np.linalg.solve(m, want[1: k + 1])[-1] - mine[k]) < 1e-9
    assert acf[acf.k == "c"].acf.isna().all()


def test_unkeyed_forms(hourly):
    pdf, df = hourly
    one = df.where("k = 'a'").drop("k")
    z = collect(A.combined_score(one, "x", width="1h"), "ts")
    k = collect(A.combined_score(df, "x", keys=["k"], width="1h").where("k = 'a'"), "ts")
    assert (z.score == k.score).all()
    assert R.pacf(one, "x", 5, width="1h").count() == 6


@pytest.mark.parametrize("keys", [["k"], []])
def test_isolation_forest(hourly, keys):
    pdf, df = hourly
    df = df.where("k = 'a'")
    df = df.withColumn("x", F.when(F.hour("ts") + 24 * F.dayofmonth("ts") == 24 * 15 + 3, 900).otherwise(F.col("x")))
    df = df if keys else df.drop("k")
    out = collect(I.detect_isolation_forest(df, "x", trees=30, keys=keys, width="1h"), "ts")
    assert len(out) == 900 and not out.is_isolation_forest[:3].any() and out.anomaly_score[:3].isna().all()
    assert abs(out.is_isolation_forest.mean() - 0.05) < 0.01
    assert out.loc[out.x.idxmax(), "is_isolation_forest"]


@pytest.mark.parametrize("block_rows", [4, 16, 8192])
def test_series_with_random_holes(hourly, block_rows):
    """Lags, means and smoothed values by row, whatever rows are missing."""
    pdf, df = hourly
    kept = pdf[(pdf["ts"].dt.dayofyear * 7 + pdf["ts"].dt.hour * 5) % 11 > 2]
    kept = kept[~((kept["ts"] > "2024-01-09 03:00") & (kept["ts"] < "2024-01-11 09:00"))]
    holes = df.join(df.sparkSession.createDataFrame(kept[["k", "ts"]]).selectExpr("k", "cast(ts AS timestamp_ntz) AS ts"), ["k", "ts"])
    got = collect(X.add_ewm(X.add_rolling(X.add_lags(holes, "x", [1, 3], ["k"], width="1h", block_rows=block_rows), "x", [3], ["k"], block_rows=block_rows), "x", [4], ["k"], width="1h", block_rows=block_rows), "k", "ts")
    want = kept.sort_values(["k", "ts"]).reset_index(drop=True)
    g = want.groupby("k")["x"]
    pd.testing.assert_series_equal(got["x_lag_3"].astype("float64"), g.shift(3).astype("float64"), check_names=False)
    pd.testing.assert_series_equal(got["x_rolling_mean_3"].astype("float64"), g.transform(lambda v: v.rolling(3, min_periods=1).mean()), check_names=False)
    pd.testing.assert_series_equal(got["x_ewm_4"].astype("float64"), g.transform(lambda v: v.ewm(span=4, adjust=False).mean()), check_names=False)


def test_wide_windows_equal_plain_frames(spark, monkeypatch):
    import numpy as np
    import pandas as pd
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    t = pd.date_range("2024-01-01", periods=700, freq="min")
    x = np.round(rng.normal(0, 50, 700), 2)
    x[100:160] = 0.1
    y = np.where(rng.random(700) < 0.1, np.nan, x)
    pdf = pd.concat([pd.DataFrame({"k": "a", "ts": t, "x": y}), pd.DataFrame({"k": None, "ts": t[:37], "x": x[:37]}), pd.DataFrame({"k": "nothing", "ts": t[:90], "x": np.nan})])
    df = spark.createDataFrame(pdf).select("k", F.col("ts").cast("timestamp_ntz").alias("ts"), F.when(~F.isnan("x"), F.col("x")).alias("x"))
    for n in (25, 37, 90):
        got = X.add_rolling(df, "x", [3, n], ["k"], block_rows=100).toPandas()
        monkeypatch.setattr(X, "WIDE_ROWS", 1000)
        want = X.add_rolling(df, "x", [3, n], ["k"], block_rows=100).toPandas()
        monkeypatch.undo()
        assert list(got.columns) == list(want.columns) and len(got) == 827
        order = ["k", "ts"]
        pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), want.sort_values(order, ignore_index=True), rtol=1e-9, atol=1e-9)
    whole = df.withColumn("x", F.round("x").cast("bigint"))
    assert dict(X.add_rolling(whole, "x", [50], ["k"]).dtypes)["x_rolling_max_50"] == "bigint"
