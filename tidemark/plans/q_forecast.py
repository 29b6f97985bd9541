"""Registered queries: regression forecasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.operators import arma as M
from tidemark.operators import evaluate as E
from tidemark.operators import fourier as Q
from tidemark.operators import regress
from tidemark.operators import seasonal as A
from tidemark.operators.cv import cutoff_products, cutoff_scores, rolling_cutoffs, with_cutoffs
from tidemark.operators.series import drop_outages, split_train_test
from tidemark.plans.inputs import OUTAGE, TEST_START, series, series_ctes
from tidemark.plans.registry import query

KEY = ["event_type"]
T = "request_count"
_LAGS = A.lag_set(2, 1, 96)


def _series(spark, sf_dir):
    return series(spark, sf_dir).select("event_type", "ts", T)


_COLS = ["CAST(1 AS DOUBLE)", *[f"w_{k}" for k in _LAGS], "w"]
_W = "OVER (PARTITION BY event_type ORDER BY ts)"
SAR_SQL = f"""{series_ctes('15min')},
diffed AS (SELECT event_type, ts, CAST({T} - lag({T}) {_W} AS DOUBLE) AS w FROM series),
frame AS (SELECT event_type, ts, w, {', '.join(f'lag(w, {k}) {_W} AS w_{k}' for k in _LAGS)} FROM diffed),
complete AS (SELECT * FROM frame WHERE w IS NOT NULL AND {' AND '.join(f'w_{k} IS NOT NULL' for k in _LAGS)})"""


@query("sar_normal_eq", f"WITH {SAR_SQL} " + " UNION ALL ".join(
    f"SELECT event_type, {i} AS i, {j} AS j, sum({_COLS[i]} * {_COLS[j]}) AS \"value\" FROM complete GROUP BY event_type"
    for i in range(len(_COLS)) for j in range(i, len(_COLS))), doubles="value")
def sar_normal_eq(spark, sf_dir):
    frame = A.lagged_frame(_series(spark, sf_dir), T, _LAGS, 1, KEY, width="15min")
    return regress.cross_products(frame, [f"w_{k}" for k in _LAGS], "w", KEY)


@query("sar_optimality", f"WITH {SAR_SQL} SELECT event_type, count(*) AS n_obs, CAST(0 AS DOUBLE) AS gradient FROM complete GROUP BY ALL", doubles="gradient")
def sar_optimality(spark, sf_dir):
    """The largest mean product of the fit's residuals with any regressor: 0 where the normal equations are solved."""
    s = _series(spark, sf_dir)
    names = [f"w_{k}" for k in _LAGS]
    models = A.fit_seasonal_ar(s, T, keys=KEY, width="15min")
    rows = attach(A.lagged_frame(s, T, _LAGS, 1, KEY, width="15min"), models.select(*KEY, "coef"), KEY)
    rows = rows.withColumn("r", F.col("w") - regress.linear_value(names)).where("r is not null")
    return rows.groupBy(*KEY).agg(F.count("r").alias("n_obs"), F.greatest(F.abs(F.avg("r")), *[F.abs(F.avg(F.col("r") * F.col(c))) for c in names]).alias("gradient"))


_LAG_OF = lambda k: f"lag({T}, {k}) {_W}"


@query("seasonal_difference", f"""WITH {series_ctes('15min')},
s AS (SELECT event_type, ts, CAST({T} - {_LAG_OF(1)} - {_LAG_OF(96)} + {_LAG_OF(97)} AS DOUBLE) AS w FROM series)
SELECT event_type, ts, w, lag(w, 1) {_W} AS w_1, lag(w, 96) {_W} AS w_96 FROM s""", doubles="w w_1 w_96")
def seasonal_difference(spark, sf_dir):
    """Values differenced by row and by day, with the lags a seasonal model takes."""
    return A.lagged_frame(_series(spark, sf_dir), T, [1, 96], 1, KEY, width="15min", seasonal_d=1, season=96)


@query("forecast_sar_seasonal")
def forecast_sar_seasonal(spark, sf_dir):
    """The next day after the training split from a model of the daily differences, orders 1, 1 and season 96."""
    train, _ = split_train_test(drop_outages(series(spark, sf_dir)).select("event_type", "ts", T), TEST_START)
    order = {"d": 1, "seasonal_d": 1, "season": 96}
    models = A.fit_seasonal_ar(train, T, p=1, keys=KEY, width="15min", **order)
    return A.forecast_seasonal_ar(train, T, models, 96, keys=KEY, **order)


def _sar(spark, sf_dir):
    s = drop_outages(series(spark, sf_dir)).select("event_type", "ts", T)
    train, _ = split_train_test(s, TEST_START)
    return train, A.fit_seasonal_ar(train, T, keys=KEY, width="15min", removed=[OUTAGE])


@query("forecast_sar")
def forecast_sar(spark, sf_dir):
    """The next day of each series after the training split, with 95 % intervals."""
    train, models = _sar(spark, sf_dir)
    return A.forecast_seasonal_ar(train, T, models, 96, keys=KEY, removed=[OUTAGE])


@query("sar_diagnostics")
def sar_diagnostics(spark, sf_dir):
    train, models = _sar(spark, sf_dir)
    fitted = A.in_sample(train, T, models, keys=KEY, width="15min", removed=[OUTAGE])
    return E.residual_diagnostics(fitted, "residual", len(_LAGS) + 1, KEY)


_CUT_LAGS = A.lag_set(2, 1, 96)
_CUT_SPAN = dict(initial_days=14, period_days=4, horizon_days=6)
_CUTS_SQL = f"""{SAR_SQL},
span AS (SELECT event_type, CAST(epoch(min(ts)) AS BIGINT) AS lo, CAST(epoch(max(ts)) AS BIGINT) - {6 * 86400} AS hi FROM frame GROUP BY event_type),
cuts AS (SELECT event_type, make_timestamp(c * 1000000) AS cutoff
  FROM (SELECT event_type, unnest(generate_series(hi - ((hi - lo - {14 * 86400}) // {4 * 86400}) * {4 * 86400}, hi, {4 * 86400})) AS c FROM span WHERE hi >= lo + {14 * 86400}) AS u)"""


def _cut_frame(spark, sf_dir):
    return A.lagged_frame(_series(spark, sf_dir), T, _CUT_LAGS, 1, KEY, width="15min"), [f"w_{k}" for k in _CUT_LAGS]


@query("cv_normal_eq", f"""WITH {_CUTS_SQL},
z AS MATERIALIZED (SELECT event_type, ts, [{', '.join(_COLS)}] AS z FROM complete)
SELECT z.event_type, cutoff, CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j,
  coalesce(sum(z[a.i + 1] * z[b.j + 1]) FILTER (WHERE ts <= cutoff), 0) AS train, coalesce(sum(z[a.i + 1] * z[b.j + 1]) FILTER (WHERE ts > cutoff), 0) AS test
FROM z JOIN cuts c ON z.event_type = c.event_type AND z.ts <= c.cutoff + INTERVAL '6 days', range({len(_COLS)}) a(i), range({len(_COLS)}) b(j)
WHERE a.i <= b.j GROUP BY ALL""", doubles="train test")
def cv_normal_eq(spark, sf_dir):
    """The systems of the seasonal autoregression at every cut-off, training and test rows."""
    frame, names = _cut_frame(spark, sf_dir)
    return cutoff_products(frame, names, "w", keys=KEY, **_CUT_SPAN)


@query("cv_sar_scores")
def cv_sar_scores(spark, sf_dir):
    """One-step errors of the seasonal autoregression after every cut-off."""
    frame, names = _cut_frame(spark, sf_dir)
    return cutoff_scores(frame, names, "w", keys=KEY, **_CUT_SPAN)


@query("cv_sar_optimality", f"""WITH {_CUTS_SQL}
SELECT c.event_type, cutoff, CAST(count(*) FILTER (WHERE ts <= cutoff) AS DOUBLE) AS n_train, CAST(count(*) FILTER (WHERE ts > cutoff) AS DOUBLE) AS n_test, CAST(0 AS DOUBLE) AS gradient
FROM complete z JOIN cuts c ON z.event_type = c.event_type AND z.ts <= c.cutoff + INTERVAL '6 days' GROUP BY ALL""", doubles="gradient")
def cv_sar_optimality(spark, sf_dir):
    """Rows of every cut-off, and how far its fit is from solving the normal equations."""
    return cv_sar_scores(spark, sf_dir).select(*KEY, "cutoff", "n_train", "n_test", "gradient")


@query("adf_stat")
def adf_stat(spark, sf_dir):
    return A.check_stationarity(_series(spark, sf_dir), T, 24, keys=KEY, width="15min")


@query("auto_select_d")
def auto_select_d(spark, sf_dir):
    return A.select_d(_series(spark, sf_dir), T, 2, KEY, max_lag=12, width="15min")


@query("order_search")
def order_search(spark, sf_dir):
    """Lag, differencing and moving-average orders of every series by AIC."""
    return M.order_search(_series(spark, sf_dir), T, keys=KEY)


@query("order_search_ranks", f"""WITH {series_ctes('15min')}
SELECT event_type, CAST(36 AS BIGINT) AS orders, true AS by_aic, true AS distinct_ranks FROM series GROUP BY event_type HAVING count(*) > 200""")
def order_search_ranks(spark, sf_dir):
    """Whether the ranks of all orders follow their AIC, for every series."""
    found = order_search(spark, sf_dir).withColumn("lower", F.lag("aic").over(Window.partitionBy(*KEY).orderBy("rank")))
    return found.where("aic is not null").groupBy(*KEY).agg(
        F.count("*").alias("orders"), F.coalesce(F.bool_and(F.col("lower") <= F.col("aic")), F.lit(False)).alias("by_aic"), (F.countDistinct("rank") == F.count("*")).alias("distinct_ranks"))


@query("arma_optimality", f"""WITH {series_ctes('15min')}
SELECT event_type, count(*) - 23 AS n_obs, CAST(0 AS DOUBLE) AS gradient FROM series GROUP BY event_type HAVING count(*) > 23""", doubles="gradient")
def arma_optimality(spark, sf_dir):
    """The largest mean product of the residuals with any lag of the value or of the innovations: 0 where the second stage is solved."""
    told = M.innovations(_series(spark, sf_dir), T, 1, KEY)
    models = M.fit_arma(None, T, 2, 1, 2, keys=KEY, told=told)
    rows = M.arma_residuals(told, models, 2, 2, keys=KEY)
    return rows.groupBy(*KEY).agg(F.count("residual").alias("n_obs"), F.greatest(
        F.abs(F.avg("residual")), *[F.abs(F.avg(F.col("residual") * F.col(c))) for c in ("w_1", "w_2", "e_1", "e_2")]).alias("gradient"))


@query("forecast_arma")
def forecast_arma(spark, sf_dir):
    """The next day after the training split from lags and innovations, with 95 % intervals."""
    train, _ = split_train_test(drop_outages(series(spark, sf_dir)).select("event_type", "ts", T), TEST_START)
    models = M.fit_arma(train, T, 2, 1, 2, seasonal_p=1, keys=KEY)
    return M.forecast_arma(train, T, models, 96, keys=KEY)


_MODEL = Q.FourierModel(width="15min", keys=("event_type",))
_SEC = "epoch(s.ts)"


def _fourier_sql() -> str:
    cols = [f"({_SEC} - lo) / (hi - lo) AS trend"]
    cols += [f"greatest(({_SEC} - lo) / (hi - lo) - {0.8 * i / 25!r}, 0.0) AS hinge_{i}" for i in range(1, 26)]
    for s in _MODEL.seasons:
        period = Q.SEASONALITIES[s][0]
        for k in range(1, _MODEL.harmonics(s) + 1):
            cols += [f"{f}(2 * pi() * {k} * ({_SEC} % {period}) / {period}) AS {s}_{f}_{k}" for f in ("sin", "cos")]
    return f"""WITH {series_ctes('15min')},
sp AS (SELECT event_type, epoch(min(ts)) AS lo, epoch(max(ts)) AS hi FROM series GROUP BY ALL)
SELECT s.event_type, s.ts, {', '.join(cols)} FROM series s JOIN sp ON s.event_type = sp.event_type"""


@query("fourier_features", _fourier_sql(), doubles=" ".join(_MODEL.features()))
def fourier_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts")
    return Q.named_design(s, Q.history_spans(s, _MODEL), _MODEL).drop("_lo", "_hi")


def _fourier(spark, sf_dir):
    s = drop_outages(series(spark, sf_dir)).select("event_type", "ts", T)
    train, _ = split_train_test(s, TEST_START)
    return Q.fit_fourier(train, T, _MODEL)


@query("forecast_fourier")
def forecast_fourier(spark, sf_dir):
    """The next day of each series with interval and components."""
    models = _fourier(spark, sf_dir)
    return Q.predict_fourier(Q.future_grid(models, 96, _MODEL), models, _MODEL)


@query("changepoints")
def changepoints(spark, sf_dir):
    return Q.changepoints(_fourier(spark, sf_dir), _MODEL)


@query("changepoint_optimality", f"""WITH {series_ctes('15min')}
SELECT event_type, count(*) AS n_obs, CAST(0 AS DOUBLE) AS violation FROM series
WHERE is_storm_period = 0 AND ts < TIMESTAMP '{TEST_START}' GROUP BY ALL""", doubles="violation")
def changepoint_optimality(spark, sf_dir):
    """By how much the trend model's coefficients, zeros included, miss the conditions of a least penalised error."""
    train, _ = split_train_test(drop_outages(series(spark, sf_dir)).select("event_type", "ts", T), TEST_START)
    return Q.optimality(train, T, Q.fit_fourier(train, T, _MODEL), _MODEL)


@query("cv_fourier_scores")
def cv_fourier_scores(spark, sf_dir):
    """Rolling-origin cross-validation: every cut-off is one more series key, fitted in the same job."""
    s = _series(spark, sf_dir)
    rows = with_cutoffs(s, rolling_cutoffs(s, 14, 7, 1, KEY), 1, KEY)
    model = Q.FourierModel(width="15min", keys=("event_type", "cutoff"))
    fits = Q.fit_fourier(rows.where("role = 'train'"), T, model)
    test = rows.where("role = 'test'").select("event_type", "cutoff", "ts", F.col(T).cast("double").alias("actual"))
    scored = Q.predict_fourier(test, fits, model)
    return E.metrics(scored, "actual", "yhat", by=["event_type", "cutoff"])
