"""Autoregression with moving-average terms, by two-stage innovations regression.

A long autoregression gives every row its innovation; the value is then regressed on its own lags and on the lags of
the innovations. Both stages are least squares on cross products summed over the cluster, so any number of series is
fitted in two passes, and every smaller model (p, q) on the same rows is a sub-block of the same sums. Rows are numbered
once and written once; both stages read that table.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.functions.timebins import from_seconds, seconds_of, width_seconds
from tidemark.operators import regress
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, positioned
from tidemark.operators.seasonal import difference_column, lag_polynomial, lag_set
from tidemark.session import settled

#: Lags of the long autoregression, unless asked for otherwise.
LONG_LAGS = 20
#: Rows before a forecast over which innovations are run from zero.
BURN_IN = 400


def long_lags(count: int, seasonal: int, season: int) -> list[int]:
    """1..count, and the neighbours of each seasonal lag."""
    return sorted(set(range(1, count + 1)) | {season * j + o for j in range(1, seasonal + 1) for o in (-1, 0, 1)})


def innovations(
    series: DataFrame, value: str, d: int = 1, keys: list[str] = (), ts: str = "ts", lags: list[int] | None = None,
    seasonal_d: int = 0, season: int = 1, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`(keys, ts, _pos, w, e)`: the differenced value, and its innovation by a long autoregression, written once.

    `e` is NULL where the long autoregression lacks a lag, and in series too short to fit it.
    """
    keys, lags = list(keys), list(lags or range(1, LONG_LAGS + 1))
    placed = settled(positioned(series.select(*keys, ts, value), keys, ts), "placed")
    reach = max(lags) + d + season * seasonal_d
    df = overlapping(placed, reach, block_rows=block_rows)
    win = block_window(keys)
    df = df.withColumn("w", difference_column(value, d, win, seasonal_d, season)).withColumns({f"w_{k}": F.lag("w", k).over(win) for k in lags})
    names = [f"w_{k}" for k in lags]
    frame = df.where("_own").select(*keys, ts, "_pos", "w", *names)
    fits = regress.fit(frame, names, "w", keys).select(*keys, "coef")
    out = attach(frame, fits, keys).withColumn("e", F.col("w") - regress.linear_value(names))
    return settled(out.select(*keys, ts, "_pos", "w", "e"), "innovations")


def arma_frame(told: DataFrame, ar: list[int], ma: list[int], keys: list[str] = (), ts: str = "ts", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The innovations table with `w_<k>` and `e_<k>`, the lags of value and innovation."""
    keys = list(keys)
    df = overlapping(told, max([0, *ar, *ma]), block_rows=block_rows)
    win = block_window(keys)
    df = df.withColumns({**{f"w_{k}": F.lag("w", k).over(win) for k in ar}, **{f"e_{k}": F.lag("e", k).over(win) for k in ma}})
    return df.where("_own").drop("_blk", "_own", "_pos")


def _names(ar: list[int], ma: list[int]) -> list[str]:
    return [*[f"w_{k}" for k in ar], *[f"e_{k}" for k in ma]]


def fit_arma(
    series: DataFrame, value: str, p: int = 1, d: int = 1, q: int = 1, seasonal_p: int = 0, seasonal_q: int = 0, season: int = 96,
    keys: list[str] = (), ts: str = "ts", seasonal_d: int = 0, long: int = LONG_LAGS, told: DataFrame | None = None,
) -> DataFrame:
    """One row per series: intercept, lag and innovation coefficients with their errors, `lags` and `ma_lags`.

    `told` is the innovations table where it exists already. Series too short have NULL results.
    """
    ar, ma = lag_set(p, seasonal_p, season), lag_set(q, seasonal_q, season)
    if told is None:
        told = innovations(series, value, d, keys, ts, long_lags(max(long, p + q), max(seasonal_p, seasonal_q), season), seasonal_d, season)
    listed = lambda lags: F.array(*[F.lit(k) for k in lags]).cast("array<int>")
    return regress.fit(arma_frame(told, ar, ma, keys, ts), _names(ar, ma), "w", keys).withColumns({"d": F.lit(d), "lags": listed(ar), "ma_lags": listed(ma)})


def arma_residuals(told: DataFrame, models: DataFrame, p: int, q: int, seasonal_p: int = 0, seasonal_q: int = 0, season: int = 96, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Keys, `ts`, `actual`, `fitted`, `residual` and the regressors of every row that has them all."""
    ar, ma = lag_set(p, seasonal_p, season), lag_set(q, seasonal_q, season)
    rows = attach(arma_frame(told, ar, ma, keys, ts), models.select(*keys, "coef"), list(keys)).withColumn("fitted", regress.linear_value(_names(ar, ma)))
    return rows.withColumn("residual", F.col("w") - F.col("fitted")).where("residual is not null").select(
        *keys, ts, F.col("w").alias("actual"), "fitted", "residual", *_names(ar, ma))


def order_search(
    series: DataFrame, value: str, p_range=range(0, 3), d_range=range(0, 2), q_range=range(0, 3), seasonal_range=range(0, 2), season: int = 96,
    keys: list[str] = (), ts: str = "ts", long: int = LONG_LAGS,
) -> DataFrame:
    """`(keys, p, d, q, seasonal_p, aic, rank)`: every order of the grid, best first; a series too short to fit has one row of NULLs.

    One innovations table per differencing order; all (p, q, seasonal_p) are sub-blocks of its cross products and are
    compared on the same rows.
    """
    keys = list(keys)
    ar, ma = lag_set(max(p_range), max(seasonal_range), season), lag_set(max(q_range), 0, season)
    grid = [
        (p, q, sp, [0, *[1 + ar.index(k) for k in lag_set(p, sp, season)], *[1 + len(ar) + ma.index(k) for k in lag_set(q, 0, season)]])
        for p in p_range for q in q_range for sp in seasonal_range]
    out = None
    for d in d_range:
        told = innovations(series, value, d, keys, ts, long_lags(long, max(seasonal_range), season))

        def solve(g: np.ndarray, d=d) -> list[dict]:
            n, found = g[0, 0], []
            for p, q, sp, use in grid:
                sse = regress.least_squares(g, use)[1]
                found.append({"p": p, "d": d, "q": q, "seasonal_p": sp, "aic": n * math.log(max(sse, 1e-300) / n) + 2 * len(use)})
            return found

        one = regress.per_series(regress.cross_products(arma_frame(told, ar, ma, keys, ts), _names(ar, ma), "w", keys), keys, solve,
                                 "p int, d int, q int, seasonal_p int, aic double")
        out = one if out is None else out.unionByName(one)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("aic", "p", "d", "q", "seasonal_p")))
    return regress.with_every_key(ranked, series, keys)


def forecast_arma(
    series: DataFrame, value: str, models: DataFrame, steps: int = 96, width="15min", alpha: float = 0.05, keys: list[str] = (), ts: str = "ts",
    d: int = 1, seasonal_d: int = 0, season: int = 96, max_lag: int | None = None,
) -> DataFrame:
    """`(keys, step, ts, forecast, lower, upper)` from each series' last rows, never below 0.

    Innovations run from zero over the last rows (`BURN_IN` and the longest lag); they, the rows and the model of a
    series meet in one grouped task. Bands widen by the joint impulse weights of both lag kinds. `d`, `seasonal_d` and
    `season` are those of the fit; `max_lag` is the longest lag of any model, the season and one where it isn't given.
    """
    keys, w = list(keys), width_seconds(width)
    poly = lag_polynomial(d, seasonal_d, season)
    rows_back = BURN_IN + (max_lag or season + 1) + max(poly)
    placed = positioned(series.select(*keys, ts, value), keys, ts)
    # The last rows of a series lie in its last blocks, whose ends are known without a second reading.
    size = max(BLOCK_ROWS, rows_back)
    blocks = placed.groupBy(*keys, F.floor(F.col("_pos") / size).alias("_blk")).agg(F.sort_array(F.collect_list(F.struct("_pos", F.col(ts).alias("t"), F.col(value).cast("double").alias("v")))).alias("_r"))
    blocks = blocks.select(*keys, "_blk", F.slice("_r", F.greatest(F.lit(1), F.size("_r") - rows_back + 1), rows_back).alias("_r"))
    tail = blocks.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("_r"))).alias("_r"))
    tail = tail.select(*keys, F.slice("_r", F.greatest(F.lit(1), F.size("_r") - rows_back + 1), rows_back).alias("_r"))
    tail = tail.select(*keys, F.transform("_r", lambda r: r["v"]).alias("tail"), F.element_at("_r", -1)["t"].alias("_at"))
    rows = attach(tail, models.select(*keys, "coef", "sigma", "lags", "ma_lags"), keys).where(F.col("coef").isNotNull())
    z = NormalDist().inv_cdf(1 - alpha / 2)

    def run(batches):
        for pdf in batches:
            out = []
            for values, coef, ar, ma, sigma in zip(pdf["tail"], pdf["coef"], pdf["lags"], pdf["ma_lags"], pdf["sigma"]):
                path, spread = extend(np.array(values), np.array(coef), [int(k) for k in ar], [int(k) for k in ma], poly, steps)
                band = z * sigma * spread
                out.append((np.clip(path, 0, None), np.clip(path - band, 0, None), np.clip(path + band, 0, None)))
            yield pdf[[*keys, "_at"]].assign(**{n: [o[i].tolist() for o in out] for i, n in enumerate(("_f", "_l", "_u"))})

    fields = regress._key_fields(series, keys)
    done = rows.mapInPandas(run, ", ".join([*fields, "_at timestamp_ntz, _f array<double>, _l array<double>, _u array<double>"]))
    long = done.select(*keys, "_at", F.posexplode(F.arrays_zip("_f", "_l", "_u")).alias("_s", "_z"))
    return long.select(
        *keys, (F.col("_s") + 1).alias("step"), from_seconds(seconds_of("_at") + (F.col("_s") + 1) * w).alias("ts"),
        F.col("_z._f").alias("forecast"), F.col("_z._l").alias("lower"), F.col("_z._u").alias("upper"))


def impulse_weights(ar: dict[int, float], ma: dict[int, float], poly: dict[int, float], steps: int) -> np.ndarray:
    """How an innovation moves the undifferenced value 0, 1, .. steps later."""
    psi = np.zeros(steps)
    for s in range(steps):
        psi[s] = (1.0 if s == 0 else ma.get(s, 0.0)) + sum(c * psi[s - k] for k, c in ar.items() if k <= s)
    for s in range(steps):
        psi[s] -= sum(c * psi[s - k] for k, c in poly.items() if 0 < k <= s)
    return psi


def extend(tail: np.ndarray, coef: np.ndarray, ar: list[int], ma: list[int], poly: dict[int, float], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Point path and relative spread of the next values after `tail`; `coef` has the intercept, then `ar`, then `ma`."""
    degree = max(poly)
    phi, theta = dict(zip(ar, coef[1 : 1 + len(ar)])), dict(zip(ma, coef[1 + len(ar) :]))
    w = list(sum(c * tail[degree - k : len(tail) - k] for k, c in poly.items()))
    first, e = max([0, *ar]), [0.0] * len(w)
    for t in range(first, len(w)):
        e[t] = w[t] - coef[0] - sum(c * w[t - k] for k, c in phi.items()) - sum(c * e[t - k] for k, c in theta.items() if k <= t)
    y = list(tail)
    for _ in range(steps):
        nxt = coef[0] + sum(c * w[-k] for k, c in phi.items()) + sum(c * e[-k] for k, c in theta.items())
        w.append(nxt)
        e.append(0.0)
        y.append(nxt - sum(c * y[-k] for k, c in poly.items() if k))
    psi = impulse_weights(phi, theta, poly, steps)
    return np.array(y[len(tail) :]), np.sqrt(np.cumsum(psi**2))
