import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import arma as M
from tidemark.operators import boosting as B
from tidemark.operators import fourier as Q
from tidemark.operators import regress
from tidemark.operators import seasonal as A
from tidemark.operators import trees
from tidemark.operators.cv import expanding_folds, rolling_cutoffs, with_cutoffs


def make(spark, frames):
    pdf = pd.concat(frames, ignore_index=True)
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_fit_equals_least_squares_with_gaps(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(0, 0.1, 200)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(y=y, k=["u", None] * 100)
    df = spark.createDataFrame(pdf)
    df = df.unionByName(spark.createDataFrame([("u", None, 1.0, 1.0, 1.0)], "k string, a double, b double, c double, y double"))
    for r in regress.fit(df, list("abc"), "y", ["k"]).collect():
        part = pdf[pdf.k.isna() if r.k is None else pdf.k == "u"]
        z = np.column_stack([np.ones(len(part)), part[list("abc")]])
        beta, sse = np.linalg.lstsq(z, part.y.to_numpy(), rcond=None)[:2]
        np.testing.assert_allclose(r.coef, beta, atol=1e-9)
        assert r.sse == pytest.approx(sse[0]) and r.n_obs == 100


def test_seasonal_autoregression_continues_a_pattern(spark):
    t = pd.date_range("2024-01-01", periods=24 * 20, freq="h")
    wave = 100 + 40 * np.sin(np.arange(len(t)) * 2 * np.pi / 24)
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": wave * s}) for k, s in (("a", 1), ("b", 3))])
    train = df.where(F.col("ts") < F.lit("2024-01-19").cast("timestamp_ntz"))
    fits = A.fit_seasonal_ar(train, "x", season=24, keys=["k"], width="1h")
    f = A.forecast_seasonal_ar(train, "x", fits, 24, "1h", keys=["k"], max_lag=25)
    both = f.join(df, ["k", "ts"]).toPandas()
    assert len(both) == 48 and (both.forecast - both.x).abs().max() < 1e-3
    assert (both.lower <= both.forecast).all() and (both.forecast <= both.upper).all() and (both.lower >= 0).all()
    res = A.in_sample(train, "x", fits, season=24, keys=["k"], width="1h").toPandas()
    assert res.residual.abs().max() < 1e-6


def test_interval_of_a_random_walk_grows_with_the_root(spark):
    rng = np.random.default_rng(5)
    t = pd.date_range("2024-01-01", periods=2000, freq="h")
    df = make(spark, [pd.DataFrame({"ts": t, "x": 5000 + np.cumsum(rng.normal(0, 1, len(t)))})])
    fits = A.fit_seasonal_ar(df, "x", p=0, seasonal_p=0, width="1h")
    f = A.forecast_seasonal_ar(df, "x", fits, 16, "1h", max_lag=1).orderBy("step").toPandas()
    half = (f.upper - f.forecast).to_numpy()
    assert half[15] / half[0] == pytest.approx(4.0) and half[0] == pytest.approx(1.96, rel=0.1)


def test_exogenous_column(spark):
    t = pd.date_range("2024-01-01", periods=300, freq="h")
    e = (np.arange(300) % 7 == 0).astype(float)
    df = make(spark, [pd.DataFrame({"ts": t, "x": 20 + 5 * e, "e": e})])
    past, future = df.where("ts < timestamp_ntz'2024-01-12'"), df.where("ts >= timestamp_ntz'2024-01-12'")
    fits = A.fit_seasonal_ar(past, "x", p=1, d=0, seasonal_p=0, width="1h", exog=["e"])
    f = A.forecast_seasonal_ar(past, "x", fits, 24, "1h", max_lag=1, d=0, future_exog=future.select("ts", "e"), exog=["e"])
    both = f.join(df, "ts").toPandas()
    assert len(both) == 24 and (both.forecast - both.x).abs().max() < 1e-6


def test_stationarity_and_differencing(spark):
    rng = np.random.default_rng(1)
    t, e = pd.date_range("2024-01-01", periods=1500, freq="h"), rng.normal(0, 1, (3, 1500))
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": v}) for k, v in (
        ("noise", e[0]), ("walk", np.cumsum(e[1])), ("double", np.cumsum(np.cumsum(e[2]))))])
    got = {r.k: r for r in A.check_stationarity(df, "x", 8, keys=["k"], width="1h").collect()}
    assert got["noise"].is_stationary and not got["walk"].is_stationary
    assert {r.k: r.d for r in A.select_d(df, "x", 2, ["k"], max_lag=8, width="1h").collect()} == {"noise": 0, "walk": 1, "double": 2}
    assert A.adf_p_value(-2.86) == pytest.approx(0.05, abs=0.001) and A.adf_p_value(-3.43) == pytest.approx(0.01, abs=0.001)


def test_order_search_prefers_the_true_order(spark):
    rng, x = np.random.default_rng(2), np.zeros(2000)
    for i in range(2, 2000):
        x[i] = 0.5 * x[i - 1] + 0.35 * x[i - 2] + rng.normal()
    df = make(spark, [pd.DataFrame({"ts": pd.date_range("2024-01-01", periods=2000, freq="h"), "x": x})])
    best = M.order_search(df, "x", d_range=[0], q_range=[0], season=24).where("rank = 1").first()
    assert (best.p, best.d, best.seasonal_p) == (2, 0, 0)


def test_trend_and_seasonality(spark):
    t = pd.date_range("2024-01-01", periods=24 * 35, freq="h")
    n = np.arange(len(t))
    y = 100 + 0.05 * n + 20 * np.sin(2 * np.pi * n / 24) + 10 * np.cos(2 * np.pi * n / 168)
    df = make(spark, [pd.DataFrame({"k": "a", "ts": t, "x": y})])
    m = Q.FourierModel(width="1h", multiplicative=False, keys=("k",))
    train = df.where("ts < timestamp_ntz'2024-02-03'")
    fits = Q.fit_fourier(train, "x", m)
    both = Q.predict_fourier(Q.future_grid(fits, 48, m), fits, m).join(df, ["k", "ts"]).toPandas()
    assert len(both) == 48 and (both.yhat - both.x).abs().max() < 2.0
    parts = both[[c for c in both.columns if c.endswith("_component")]].sum(axis=1)
    np.testing.assert_allclose(parts, both.yhat, rtol=1e-9)
    assert m.harmonics("hourly") == 0 and Q.FourierModel(width="15min").harmonics("hourly") == 2
    assert Q.changepoints(fits, m).count() == 25


def test_folds_and_cutoffs(spark):
    t = pd.date_range("2024-01-01", periods=103, freq="h")
    df = make(spark, [pd.DataFrame({"ts": t, "x": range(103)})])
    folds = expanding_folds(df, 4, width="1h").groupBy("fold", "role").agg(F.count("*").alias("n"), F.min("x").alias("lo")).collect()
    got = {(r.fold, r.role): (r.n, r.lo) for r in folds}
    assert got[(1, "train")] == (23, 0) and got[(1, "test")] == (20, 23) and got[(4, "test")] == (20, 83)
    cuts = rolling_cutoffs(df, 1, 1, 0.5).orderBy("cutoff").collect()
    assert [str(c.cutoff) for c in cuts] == ["2024-01-02 18:00:00", "2024-01-03 18:00:00", "2024-01-04 18:00:00"]
    assert with_cutoffs(df, rolling_cutoffs(df, 1, 1, 0.5), 0.5).where("role = 'test'").count() == 36


def test_boosted_trees(spark, tmp_path):
    from tidemark.sources import tables
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=600), "c": rng.choice(["u", "v"], 600)})
    pdf["label"] = np.where(pdf.a > 0, 20.0, 1.0) + (pdf.c == "u") * 5
    pdf["ts"] = pd.date_range("2024-01-01", periods=600, freq="h")
    df = make(spark, [pdf])
    fit, valid = B.holdout(df)
    assert fit.count() == 480 and valid.count() == 120
    model = B.fit_gbt(fit, ["a", "c"], validation=valid, categorical=["c"], max_iter=8, stepSize=0.5)
    out = B.predict_gbt(model, df)
    assert out.agg(F.avg(F.abs(F.col("prediction") - F.col("label"))).alias("e")).first().e < 1.0
    assert B.feature_importance(model).first().feature == "a"
    path = str(tmp_path / "m")
    tables.save_model(model, path)
    again = B.predict_gbt(tables.load_model(path), df)
    assert again.join(out.select("ts", F.col("prediction").alias("p")), "ts").where("p <> prediction").count() == 0
    missing = spark.createDataFrame([(None, "u")], "a double, c string")
    assert B.predict_gbt(model, missing).count() == 1
    rows = df.limit(1)
    assert B.recursive_forecast(model, rows, 3).select("prediction").distinct().count() == 1
    step = lambda d, s: d.withColumn("a", -F.col("a")).drop("prediction")
    assert B.recursive_forecast(model, rows, 3, step, checkpoint_every=2).orderBy("step").count() == 3


def test_direct_labels(spark):
    t = pd.date_range("2024-01-01", periods=10, freq="h")
    df = make(spark, [pd.DataFrame({"ts": t, "x": range(10)})])
    got = B.direct_labels(df, "x", [1, 3], width="1h").where("label is not null").toPandas()
    assert len(got) == 9 + 7 and (got.label - got.x == got.horizon).all()


def test_short_and_constant_series_are_reported(spark):
    noise = np.random.default_rng(3).normal(size=300)
    rows = [("long", i, float(50 + 5 * noise[i])) for i in range(300)] + [("short", i, float(i)) for i in range(10)] + [("flat", i, 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, x double").selectExpr("k", "cast(timestamp_seconds(1704067200 + i * 3600) AS timestamp_ntz) AS ts", "x")
    keys = {"long", "short", "flat"}
    tests = {r.k: r for r in A.check_stationarity(df, "x", 24, keys=["k"]).collect()}
    assert set(tests) == keys and tests["short"].is_stationary is None and tests["flat"].conclusion is None and tests["long"].is_stationary is not None
    d = {r.k: r.d for r in A.select_d(df, "x", 1, ["k"], max_lag=12).collect()}
    assert set(d) == keys and d["short"] is None
    assert {r.k for r in M.order_search(df, "x", d_range=[0], season=24, keys=["k"]).collect()} == keys
    fits = A.fit_seasonal_ar(df, "x", season=24, keys=["k"])
    assert {r.k: r.coef is None for r in fits.collect()} == {"long": False, "short": True, "flat": False}
    assert {r.k for r in A.forecast_seasonal_ar(df, "x", fits, 5, "1h", keys=["k"], max_lag=25).collect()} == {"long", "flat"}


def test_seasonal_differences_continue_trend_and_pattern(spark):
    t = pd.date_range("2024-01-01", periods=24 * 12, freq="h")
    n = np.arange(len(t))
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": 200.0 + 3 * n * s + 40 * (n % 24 > 12)}) for k, s in (("a", 1), ("b", 2))])
    train = df.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))
    order = {"d": 1, "seasonal_d": 1, "season": 24}
    fits = A.fit_seasonal_ar(train, "x", p=1, keys=["k"], width="1h", **order)
    f = A.forecast_seasonal_ar(train, "x", fits, 48, "1h", keys=["k"], max_lag=25, **order)
    both = f.join(df, ["k", "ts"]).toPandas()
    assert len(both) == 96 and (both.forecast - both.x).abs().max() < 1e-6


def test_lag_polynomial_and_spread():
    assert A.lag_polynomial(1, 1, 4) == {0: 1, 4: -1, 1: -1, 5: 1}
    assert A.lag_polynomial(2) == {0: 1, 1: -2, 2: 1}
    path, spread = A._extend(np.array([5.0, 1, 2, 3, 4]), np.array([0.0]), [], A.lag_polynomial(0, 1, 4), 8)
    np.testing.assert_allclose(path, [1, 2, 3, 4, 1, 2, 3, 4])
    np.testing.assert_allclose(spread ** 2, [1, 1, 1, 1, 2, 2, 2, 2])
    rng = np.random.default_rng(3)
    tail, coef = rng.normal(size=30).cumsum(), np.array([0.2, 0.5])
    path, spread = A._extend(tail, coef, [1], A.lag_polynomial(1), 5)
    w, y = tail[-1] - tail[-2], tail[-1]
    for s in range(5):
        w = 0.2 + 0.5 * w
        y += w
        assert path[s] == pytest.approx(y)
    np.testing.assert_allclose(spread, np.sqrt(np.cumsum(np.cumsum(0.5 ** np.arange(5)) ** 2)))


def _arma(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 50)
    w = np.zeros(n + 50)
    for t in range(1, n + 50):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    return w[50:]


def test_arma_finds_simulated_coefficients(spark):
    t = pd.date_range("2024-01-01", periods=6000, freq="h")
    truth = {"a": (0.6, 0.4), "b": (0.3, -0.5), "c": (-0.4, 0.7)}
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": 40 + _arma(len(t), *pq, seed)}) for seed, (k, pq) in enumerate(truth.items())]
              + [pd.DataFrame({"k": "short", "ts": t[:9], "x": np.arange(9.0)})])
    fits = {r.k: r for r in M.fit_arma(df, "x", 1, 0, 1, keys=["k"]).collect()}
    for k, (phi, theta) in truth.items():
        r = fits[k]
        assert abs(r.coef[1] - phi) < 2 * r.stderr[1] and abs(r.coef[2] - theta) < 2 * r.stderr[2]
        assert r.sigma == pytest.approx(1, rel=0.05) and list(r.lags) == [1] and list(r.ma_lags) == [1]
    assert fits["short"].coef is None


def test_arma_search_sees_the_moving_average(spark):
    t = pd.date_range("2024-01-01", periods=5000, freq="h")
    df = make(spark, [pd.DataFrame({"ts": t, "x": _arma(len(t), 0.0, 0.8, 4)})])
    best = M.order_search(df, "x", d_range=[0], seasonal_range=[0], season=24).where("rank = 1").first()
    assert best.q >= 1
    plain = M.order_search(df, "x", d_range=[0], q_range=[0], seasonal_range=[0], season=24).where("rank = 1").first()
    assert best.aic < plain.aic - 100


def test_arma_forecast_against_its_recursion(spark):
    w = _arma(900, 0.7, 0.5, 6)
    tail, coef = 5000 + np.cumsum(w), np.array([0.1, 0.7, 0.5])
    path, spread = M.extend(tail, coef, [1], [1], {0: 1.0, 1: -1.0}, 6)
    e = np.zeros(899)
    d = np.diff(tail)
    for k in range(1, 899):
        e[k] = d[k] - 0.1 - 0.7 * d[k - 1] - 0.5 * e[k - 1]
    first = 0.1 + 0.7 * d[-1] + 0.5 * e[-1]
    want, y = [], tail[-1]
    for _ in range(6):
        y += first
        want.append(y)
        first = 0.1 + 0.7 * first
    np.testing.assert_allclose(path, want, rtol=1e-12)
    psi = [1.0]
    for s in range(1, 6):
        psi.append(1.2 * 0.7 ** (s - 1))
    np.testing.assert_allclose(spread, np.sqrt(np.cumsum(np.cumsum(psi) ** 2)), rtol=1e-12)
    t = pd.date_range("2024-01-01", periods=900, freq="h")
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": tail}) for k in "ab"])
    fits = M.fit_arma(df, "x", 1, 1, 1, keys=["k"])
    got = M.forecast_arma(df, "x", fits, 6, "1h", keys=["k"], season=24).toPandas()
    r = fits.where("k = 'a'").first()
    want = M.extend(tail[-(M.BURN_IN + 26) :], np.array(r.coef), [1], [1], {0: 1.0, 1: -1.0}, 6)[0]
    assert len(got) == 12 and got.ts.min() == t[-1] + pd.Timedelta("1h")
    np.testing.assert_allclose(got[got.k == "a"].sort_values("step").forecast, np.clip(want, 0, None), rtol=1e-9)
    assert (got.lower <= got.forecast).all() and (got.forecast <= got.upper).all()


def test_seasonal_moving_average(spark):
    """A season's lag of the innovations is found, and the residuals are clean of it."""
    rng = np.random.default_rng(11)
    e = rng.normal(0, 1, 4024)
    t = pd.date_range("2024-01-01", periods=4000, freq="h")
    df = make(spark, [pd.DataFrame({"ts": t, "x": 9 + e[24:] + 0.6 * e[:-24]})])
    r = M.fit_arma(df, "x", 0, 0, 0, seasonal_q=1, season=24, long=60).first()
    assert list(r.ma_lags) == [24, 25] and abs(r.coef[1] - 0.6) < 0.08 and abs(r.coef[2]) < 0.08


def test_one_break_leaves_few_hinges(spark):
    rng = np.random.default_rng(3)
    t = pd.date_range("2024-01-01", periods=24 * 60, freq="h")
    u = np.arange(len(t)) / (len(t) - 1)
    bent = 20 + 30 * u - 55 * np.maximum(u - 0.32, 0) + 3 * np.sin(np.arange(len(t)) * 2 * np.pi / 24)
    flat = 20 + 30 * u
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": y + rng.normal(0, 1, len(t))}) for k, y in (("bent", bent), ("flat", flat), ("still", 7 + 0 * u))])
    m = Q.FourierModel(width="1h", multiplicative=False, keys=("k",), changepoint_prior_scale=0.02)
    fits = Q.fit_fourier(df, "x", m)
    deltas = Q.changepoints(fits, m).toPandas()
    on = deltas[deltas.delta != 0]
    bends = on[on.k == "bent"]
    assert 1 <= len(bends) <= 3 and len(on[on.k == "flat"]) <= 3
    big = bends.loc[bends.delta.abs().idxmax()]
    assert abs((big.ds - t[0]) / (t[-1] - t[0]) - 0.32) < 0.04 and bends.delta.sum() == pytest.approx(-55, rel=0.15)
    assert Q.optimality(df, "x", fits, m).toPandas().violation.max() < 1e-6
    tight = Q.fit_fourier(df, "x", Q.FourierModel(width="1h", multiplicative=False, keys=("k",), changepoint_prior_scale=1e-9))
    assert all(c == 0 for r in tight.collect() for c in r.coef[2:27])


def test_soft_thresholds_against_a_grid():
    """Two coefficients, one thresholded: the least of the penalised error on a fine grid."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = x @ [1.0, 0.15] + rng.normal(0, 1, 300)
    z = np.column_stack([np.ones(300), x, y])
    for scale in (0.01, 0.05, 1.0):
        beta, l1, l2 = regress.sparse_least_squares(z.T @ z, np.array([np.inf, np.inf, scale]), np.array([np.inf, 0.5, np.inf]))

        def cost(c):
            return 0.5 * ((y - z[:, :3] @ c) ** 2).sum() + (l1 * np.abs(c)).sum() + 0.5 * (l2 * c**2).sum()

        best = cost(beta)
        for step in (1e-1, 1e-3, 1e-5):
            assert all(cost(beta + step * np.array(d)) >= best - 1e-9 for d in [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)])
        assert (scale > 0.02) == (beta[2] != 0)


def test_cross_products_of_many_keys_are_handed_on(spark, monkeypatch):
    pdf = pd.DataFrame({"k": [None if i % 7 == 0 else f"k{i % 7}" for i in range(700)], "a": np.arange(700.0), "y": np.arange(700.0) % 5})
    df = spark.createDataFrame(pdf)
    want = regress.cross_products(df, ["a"], "y", ["k"]).toPandas()
    monkeypatch.setattr(regress, "HELD_NUMBERS", 1)
    got = regress.cross_products(df, ["a"], "y", ["k"]).toPandas()
    order = ["k", "i", "j"]
    pd.testing.assert_frame_equal(want.sort_values(order, ignore_index=True), got.sort_values(order, ignore_index=True))
    assert len(want) == 7 * 6


@pytest.fixture(scope="module")
def grown(spark):
    """An hourly series of two keys, its features and an ensemble on them."""
    from tidemark.operators import features as X

    rng = np.random.default_rng(0)
    t = pd.date_range("2024-01-01", periods=400, freq="h")
    df = make(spark, [pd.DataFrame({"k": k, "ts": t, "x": s + s * np.sin(np.arange(len(t)) * 2 * np.pi / 24) + rng.normal(0, 1, len(t))}) for k, s in (("a", 40), ("b", 90))])
    config = {"lags": [1, 2, 24], "windows": [3, 24], "diff_periods": [1], "ewm_spans": [4]}
    feats = X.all_features(df, "x", None, ["k"], **config)
    names = [c for c in feats.columns if c.startswith("x_") or c in ("hour", "is_weekend", "hour_sin", "dow_cos", "week_of_year")]
    sup = X.supervised(feats, "x", names, 1, keys=["k"]).persist()
    return df, config, feats, names, sup, B.fit_gbt(sup, names, max_iter=12, stepSize=0.3)


def test_walk_equals_the_model(spark, grown):
    *_, names, sup, model = grown
    nodes = trees.NodeArrays.of(model.stages[-1], spark)
    both = trees.walk(nodes, B.predict_gbt(model, sup, "p"), names).select("p", "walked").toPandas()
    np.testing.assert_allclose(both.walked.clip(lower=0), both.p, rtol=1e-12)
    assert len(nodes.roots) == 12 and (nodes.feature >= 0).any()


def test_folds_are_fitted_on_saved_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = make(spark, [pd.DataFrame({"k": k, "ts": pd.date_range("2024-01-01", periods=120, freq="h"), "a": rng.normal(size=120), "label": rng.normal(9, 1, 120)}) for k in "uv"])
    seen, fit = [], B.fit_gbt

    def noted(train, *args, **params):
        seen.append((train.count(), train.rdd.getNumPartitions(), train._jdf.queryExecution().executedPlan().toString()))
        return fit(train, *args, **params)

    monkeypatch.setattr(B, "fit_gbt", noted)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        scores = B.cross_validate(df, ["a"], folds=3, keys=["k"], max_iter=1).orderBy("fold").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert [r.fold for r in scores] == [1, 2, 3] and sorted(n for n, *_ in seen) == [60, 120, 180]
    # A fit takes as many tasks as its rows need, whatever was shuffled before, and carries no plan but a scan.
    assert all(parts <= 8 for _, parts, _ in seen)
    assert not any(word in plan for *_, plan in seen for word in ("Exchange", "InMemoryTableScan", "Window"))


def test_walk_with_splits_on_categories(spark):
    from pyspark.ml import PipelineModel

    rng, kinds = np.random.default_rng(3), np.array(list("abcdefg"))
    pdf = pd.DataFrame({"x": rng.normal(size=900), "c": rng.choice(kinds, 900), "d": rng.choice(["u", "v", None], 900), "ts": pd.date_range("2024-01-01", periods=900, freq="h")})
    pdf["label"] = pdf.c.map(dict(zip(kinds, [9, 1, 7, 3, 30, 2, 8]))) + np.where(pdf.x > 0, 5.0, 0) + (pdf.d == "u") * 4 + rng.normal(0, 0.5, 900)
    df = make(spark, [pdf])
    fit, valid = B.holdout(df)
    model = B.fit_gbt(fit.where("c <> 'g'"), ["x", "c", "d"], validation=valid, categorical=["c", "d"], max_iter=10, patience=10, stepSize=0.3)
    nodes = trees.NodeArrays.of(model.stages[-1], spark)
    assert (nodes.subset >= 0).any() and (nodes.subset[nodes.feature < 0] < 0).all()
    indexed = PipelineModel(model.stages[:-2]).transform(B.predict_gbt(model, df, "p"))
    both = trees.walk(nodes, indexed, trees.inputs(model)).select("c", "p", "walked").toPandas()
    assert set(both.c) == set(kinds)
    np.testing.assert_allclose(both.walked.clip(lower=0), both.p, rtol=1e-12)
    # Values that are no category go as in the model, too.
    odd = spark.createDataFrame([(0.1 * k, float(c), 0.0) for k in range(-2, 3) for c in (0, 5, 6, 7, 99, float("nan"))], ["x", "_i_c", "_i_d"])
    both = trees.walk(nodes, PipelineModel(model.stages[-2:]).transform(odd).drop("_features"), trees.inputs(model)).select("_raw", "walked").toPandas()
    np.testing.assert_allclose(both.walked, both._raw, rtol=1e-12)
    curve = B.validation_curve(model, valid).orderBy("round").toPandas()
    error = B.predict_gbt(model, valid).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]
    assert curve.mse.iloc[-1] == pytest.approx(error, rel=1e-9) and curve.mse.idxmin() == len(curve) - 1


def test_patience_keeps_the_least_error(spark, grown):
    *_, names, sup, model = grown
    fit, valid = B.holdout(sup)
    curve = B.validation_curve(B.fit_gbt(fit, names, max_iter=12, stepSize=0.9), valid).orderBy("round").toPandas()
    stopped = B.fit_gbt(fit, names, validation=valid, max_iter=12, patience=12, stepSize=0.9)
    kept = stopped.stages[-1].getNumTrees
    assert kept == curve.mse.idxmin() + 1
    error = B.predict_gbt(stopped, valid).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]
    assert error == pytest.approx(curve.mse.min(), rel=1e-9)
    assert trees.best_round([5, 4, 6, 6, 1], 2) == 2 and trees.best_round([5, 4, 6, 6, 1], 3) == 5 and trees.best_round([1.0], 1) == 1


def test_recursive_forecast_equals_one_plan_for_each_step(spark, grown):
    from tidemark.operators import features as X

    df, config, feats, names, _, model = grown
    got = trees.forecast_recursive(model, feats, "x", 4, "1h", ["k"]).toPandas().sort_values(["k", "step"], ignore_index=True)
    rows = df.toPandas()
    want = []
    for step in range(1, 5):
        last = X.all_features(make(spark, [rows]), "x", None, ["k"], **config).groupBy("k").agg(F.max_by(F.struct("ts", *names), "ts").alias("r")).select("k", "r.*")
        one = B.predict_gbt(model, last).select("k", "ts", "prediction").toPandas()
        want.append(one.assign(step=step))
        rows = pd.concat([rows, pd.DataFrame({"k": one.k, "ts": one.ts + pd.Timedelta("1h"), "x": one.prediction})], ignore_index=True)
    want = pd.concat(want).sort_values(["k", "step"], ignore_index=True)
    np.testing.assert_allclose(got.prediction, want.prediction, rtol=1e-9)
    assert (got.ts == want.ts + pd.Timedelta("1h")).all() and got.groupby("k").size().tolist() == [4, 4]
    with pytest.raises(ValueError):
        trees.forecast_recursive(B.fit_gbt(feats.withColumnRenamed("x_lag_1", "other_lag_1"), ["other_lag_1"], "x", max_iter=1), feats, "x", 2, "1h", ["k"])


def test_fits_run_side_by_side_and_nothing_stays_cached(spark, grown):
    import threading
    import time

    seen, most = set(), []

    def work(k):
        seen.add(threading.get_ident())
        most.append(k)
        time.sleep(0.2)
        return spark.range(k).count()

    assert B.side_by_side(work, [3, 1, 2, 5, 4], 3) == [3, 1, 2, 5, 4] and len(seen) == 3
    *_, names, sup, _ = grown
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    scores = B.cross_validate(sup, names, folds=2, keys=["k"], max_iter=2)
    assert sorted(r.fold for r in scores.collect()) == [1, 2] and all(r.RMSE > 0 for r in scores.collect())
    found = B.grid_search(sup.where("k = 'a'"), sup.where("k = 'b'"), names, grid={"maxDepth": [2, 3], "stepSize": [0.1, 0.5]}, max_iter=2)
    assert found.count() == 4
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
