"""Seasonal autoregression: stationarity, fit, interval forecasts, residuals."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.functions.timebins import from_seconds, seconds_of, width_seconds
from tidemark.operators import regress
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, own_rows, positioned

# Seasons recommended per granularity, in rows; a day for hourly series.
SEASONS = {"1min": 60, "5min": 12, "15min": 96, "1h": 24}

# Published asymptotic critical values of the unit-root test with a constant, and the
# published response-surface coefficients of its p-value (below and above tau = -1.61).
ADF_CRITICAL = {"critical_1": -3.43, "critical_5": -2.86, "critical_10": -2.57}
_P_LOW = (2.1659, 1.4412, 0.038269)
_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)
_P_SPLIT, _P_MIN, _P_MAX = -1.61, -18.83, 2.74


def lag_polynomial(d: int, seasonal_d: int = 0, season: int = 1) -> dict[int, float]:
    """Coefficient of every lag in (1 - B)^d (1 - B^season)^seasonal_d; lag 0 has 1."""
    out: dict[int, float] = {}
    for i in range(d + 1):
        for j in range(seasonal_d + 1):
            out[i + season * j] = out.get(i + season * j, 0.0) + float((-1) ** (i + j) * math.comb(d, i) * math.comb(seasonal_d, j))
    return out


def difference_column(value: str, d: int, w, seasonal_d: int = 0, season: int = 1) -> Column:
    """The d-th difference, and the seasonal_d-th over a season, of a column over an ordered window."""
    out = F.col(value).cast("double")
    for k, c in lag_polynomial(d, seasonal_d, season).items():
        if k:
            out = out + F.lit(c) * F.lag(F.col(value).cast("double"), k).over(w)
    return out


def lag_set(p: int, seasonal_p: int, season: int) -> list[int]:
    """1..p, and each seasonal lag with its successor."""
    lags = set(range(1, p + 1))
    for j in range(1, seasonal_p + 1):
        lags |= {season * j, season * j + 1}
    return sorted(lags)


def lagged_frame(series, value, lags, d=1, keys=(), ts="ts", width=None, removed=(), exog=(), block_rows=BLOCK_ROWS, seasonal_d=0, season=1) -> DataFrame:
    """Keys, `ts`, `w` = the d-th (and seasonal) difference, `w_<k>` its lags, and the exogenous columns."""
    keys, lags = list(keys), list(lags)
    reach = max([0, *lags]) + d + season * seasonal_d
    df = overlapping(positioned(series.select(*keys, ts, value, *exog), keys, ts), reach, block_rows=block_rows)
    win = block_window(keys)
    df = df.withColumn("w", difference_column(value, d, win, seasonal_d, season))
    df = df.withColumns({f"w_{k}": F.lag("w", k).over(win) for k in lags})
    return own_rows(df).select(*keys, ts, "w", *[f"w_{k}" for k in lags], *exog)


def fit_seasonal_ar(series, value, p=2, d=1, seasonal_p=1, season=96, keys=(), ts="ts", width=None, removed=(), exog=(), block_rows=BLOCK_ROWS, seasonal_d=0) -> DataFrame:
    """One row per series with the coefficients of the differenced value on its lags."""
    lags = lag_set(p, seasonal_p, season)
    frame = lagged_frame(series, value, lags, d, keys, ts, width, removed, exog, block_rows, seasonal_d, season)
    return regress.fit(frame, [*[f"w_{k}" for k in lags], *exog], "w", keys) \
        .withColumns({"d": F.lit(d), "lags": F.array(*[F.lit(k) for k in lags]) if lags else F.array().cast("array<int>")})


def in_sample(series, value, models, p=2, d=1, seasonal_p=1, season=96, keys=(), ts="ts", width=None, removed=(), exog=(), seasonal_d=0) -> DataFrame:
    """Keys, `ts`, `actual`, `fitted` and `residual` of the differenced value."""
    lags = lag_set(p, seasonal_p, season)
    frame = lagged_frame(series, value, lags, d, keys, ts, width, removed, exog, seasonal_d=seasonal_d, season=season)
    feats = [*[f"w_{k}" for k in lags], *exog]
    out = attach(frame, models.select(*keys, "coef"), list(keys)).withColumn("fitted", regress.linear_value(feats))
    return out.select(*keys, ts, F.col("w").alias("actual"), "fitted", (F.col("w") - F.col("fitted")).alias("residual")) \
        .where(F.col("residual").isNotNull())


def forecast_seasonal_ar(
    series, value, models, steps=96, width="15min", alpha=0.05, keys=(), ts="ts", removed=(), max_lag=97, d=1,
    future_exog: DataFrame | None = None, exog=(), seasonal_d=0, season=1,
) -> DataFrame:
    """`(keys, step, ts, forecast, lower, upper)` from each series' last rows, never below 0.

    Only the last max_lag + d + season * seasonal_d + 1 rows of a series matter; they and its model meet in one
    grouped task. Intervals widen by the model's impulse weights. `d`, `seasonal_d` and `season` are those of the fit.
    """
    keys, exog, w = list(keys), list(exog), width_seconds(width)
    poly = lag_polynomial(d, seasonal_d, season)
    placed = positioned(series.select(*keys, ts, value), keys, ts)
    ends = placed.groupBy(*keys).agg(F.max("_pos").alias("_last"))
    tail = attach(placed, ends, keys).where(F.col("_pos") > F.col("_last") - (max_lag + max(poly) + 1)).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_pos"), F.col(value).cast("double").alias("v")))).alias("_t"),
        F.max(ts).alias("_at"))
    rows = attach(tail.withColumn("tail", F.transform("_t", lambda r: r["v"])).drop("_t"), models.select(*keys, "coef", "sigma", "lags"), keys) \
        .where(F.col("coef").isNotNull())
    if exog:
        ahead = future_exog.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(ts), F.array(*[F.col(c).cast("double") for c in exog]).alias("x")))).alias("_e"))
        rows = attach(rows, ahead.withColumn("x", F.transform("_e", lambda r: r["x"])).drop("_e"), keys)
    z = NormalDist().inv_cdf(1 - alpha / 2)

    def run(batches):
        for pdf in batches:
            out = []
            for tail_v, coef, lags, sigma, x in zip(pdf["tail"], pdf["coef"], pdf["lags"], pdf["sigma"], pdf["x"] if exog else [None] * len(pdf)):
                path, spread = _extend(np.array(tail_v), np.array(coef), [int(k) for k in lags], poly, steps, x)
                band = z * sigma * spread
                out.append((np.clip(path, 0, None), np.clip(path - band, 0, None), path + band))
            yield pdf[[*keys, "_at"]].assign(**{n: [o[i].tolist() for o in out] for i, n in enumerate(("_f", "_l", "_u"))})

    fields = regress._key_fields(series, keys)
    done = rows.mapInPandas(run, ", ".join([*fields, "_at timestamp_ntz, _f array<double>, _l array<double>, _u array<double>"]))
    long = done.select(*keys, "_at", F.posexplode(F.arrays_zip("_f", "_l", "_u")).alias("_s", "_z"))
    return long.select(
        *keys, (F.col("_s") + 1).alias("step"), from_seconds(seconds_of("_at") + (F.col("_s") + 1) * w).alias("ts"),
        F.col("_z._f").alias("forecast"), F.col("_z._l").alias("lower"), F.col("_z._u").alias("upper"))


def _extend(tail: np.ndarray, coef: np.ndarray, lags: list[int], poly: dict[int, float], steps: int, exog=None):
    """Point path and relative spread of the next `steps` values after `tail`; `poly` is the differencing's lag polynomial."""
    degree, n_lags = max(poly), len(lags)
    y, w = list(tail), list(sum(c * tail[degree - k: len(tail) - k] for k, c in poly.items()))
    for s in range(steps):
        nxt = coef[0] + sum(coef[1 + i] * w[-k] for i, k in enumerate(lags))
        if exog is not None:
            nxt += float(np.dot(coef[1 + n_lags:], exog[s]))
        w.append(nxt)
        y.append(nxt - sum(c * y[-k] for k, c in poly.items() if k))
    # Impulse weights of the undifferenced process.
    psi, phi = np.zeros(steps), dict(zip(lags, coef[1: 1 + n_lags]))
    for s in range(steps):
        psi[s] = 1.0 if s == 0 else sum(c * psi[s - k] for k, c in phi.items() if k <= s)
    for s in range(steps):
        psi[s] -= sum(c * psi[s - k] for k, c in poly.items() if 0 < k <= s)
    return np.array(y[len(tail):]), np.sqrt(np.cumsum(psi ** 2))


def adf_p_value(tau: float) -> float:
    """Approximate p-value of the unit-root statistic with a constant."""
    if tau <= _P_MIN:
        return 0.0
    if tau >= _P_MAX:
        return 1.0
    poly = _P_LOW if tau <= _P_SPLIT else _P_HIGH
    return NormalDist().cdf(sum(c * tau ** i for i, c in enumerate(poly)))


def check_stationarity(series, value, max_lag=24, d=0, keys=(), ts="ts", width=None, removed=(), significance=0.05, block_rows=BLOCK_ROWS) -> DataFrame:
    """Augmented Dickey-Fuller test of the d-th difference, lag order chosen by AIC.

    All lag orders 0..max_lag are sub-models of one set of cross products, compared on the
    same rows. A series too short or constant has NULL results.
    """
    keys = list(keys)
    df = overlapping(positioned(series.select(*keys, ts, value), keys, ts), max_lag + d + 2, block_rows=block_rows)
    win = block_window(keys)
    df = df.withColumn("_y", difference_column(value, d, win)).withColumn("_dy", F.col("_y") - F.lag("_y").over(win))
    names = {"_level": F.lag("_y").over(win), **{f"_d{k}": F.lag("_dy", k).over(win) for k in range(1, max_lag + 1)}}
    frame = own_rows(df.withColumns(names))

    def solve(g: np.ndarray) -> list[dict]:
        n, best = g[0, 0], None
        for k in range(max_lag + 1):
            use = [0, 1, *range(2, 2 + k)]
            beta, sse, se = regress.least_squares(g, use)
            aic = n * math.log(max(sse, 1e-300) / n) + 2 * len(use)
            if best is None or aic < best[0]:
                best = (aic, k, beta[1] / se[1] if se[1] > 0 else float("nan"))
        tau = float(best[2])
        p = adf_p_value(tau) if tau == tau else float("nan")
        known = True if tau == tau else None  # a constant series decides nothing
        return [{"test_statistic": tau if known else None, "p_value": p if known else None, "used_lag": best[1], "n_obs": n, **ADF_CRITICAL,
                 "is_stationary": known and p < significance, "conclusion": known and ("Stationary" if p < significance else "Non-stationary")}]

    products = regress.cross_products(frame, list(names), "_dy", keys)
    done = regress.per_series(products, keys, solve, "test_statistic double, p_value double, used_lag int, n_obs double, "
                              "critical_1 double, critical_5 double, critical_10 double, is_stationary boolean, conclusion string")
    return regress.with_every_key(done, series, keys)


def select_d(series, value, max_d=2, keys=(), **options) -> DataFrame:
    """The smallest differencing order whose series tests stationary, `max_d` if none does, NULL if nothing could be tested."""
    keys = list(keys)
    tests = None
    for d in range(max_d + 1):
        one = check_stationarity(series, value, d=d, keys=keys, **options).withColumn("d", F.lit(d))
        tests = one if tests is None else tests.unionByName(one)
    first = F.coalesce(F.min(F.when(F.col("is_stationary"), F.col("d"))), F.lit(max_d))
    return tests.groupBy(*keys).agg(F.when(F.count("is_stationary") > 0, first).alias("d"))
