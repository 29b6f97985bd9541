"""Registered queries: forecast evaluation, with lagged means and values as the models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators.cv import expanding_folds, rolling_cutoffs, with_cutoffs
from tidemark.plans.inputs import TEST_START, series, series_ctes
from tidemark.plans.q_features import NAIVE_SQL, naive
from tidemark.plans.registry import query

KEY = ["event_type"]
T = "request_count"

# Three models in long form: mean of the last four bins, last bin, same bin a day before.
PRED_SQL = f"""{series_ctes('15min')}, {NAIVE_SQL},
long AS (
  SELECT event_type, ts, 'mean_4' AS model, CAST({T} AS DOUBLE) AS actual, prediction AS predicted FROM naive
  UNION ALL SELECT event_type, ts, 'lag_1', CAST({T} AS DOUBLE), CAST(lag({T}, 1) OVER (PARTITION BY event_type ORDER BY ts) AS DOUBLE) FROM series
  UNION ALL SELECT event_type, ts, 'lag_96', CAST({T} AS DOUBLE), CAST(lag({T}, 96) OVER (PARTITION BY event_type ORDER BY ts) AS DOUBLE) FROM series),
test AS (SELECT *, predicted - actual AS error, abs(predicted - actual) AS abs_error,
    abs(predicted - actual) / nullif(actual, 0) * 100 AS pct_error
  FROM long WHERE ts >= TIMESTAMP '{TEST_START}'),
metrics AS (SELECT model, avg(error * error) AS MSE, sqrt(avg(error * error)) AS RMSE, avg(abs_error) AS MAE,
    avg(abs(error / nullif(actual, 0))) * 100 AS MAPE FROM test GROUP BY ALL)"""


def predictions(spark, sf_dir):
    s = naive(spark, sf_dir, lags=(1, 96))
    models = F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("predicted"))
        for n, c in (("mean_4", "prediction"), ("lag_1", f"{T}_lag_1"), ("lag_96", f"{T}_lag_96"))]))
    long = s.select(*KEY, "ts", F.col(T).cast("double").alias("actual"), models.alias("_m")).select(*KEY, "ts", "actual", "_m.*")
    return E.with_errors(long.where(F.col("ts") >= F.lit(TEST_START).cast("timestamp_ntz")))


@query("prediction_summary", f"""WITH {PRED_SQL}
SELECT event_type, ts, actual, predicted, error, abs_error, pct_error FROM test WHERE model = 'mean_4'""",
       doubles="actual predicted error abs_error pct_error")
def prediction_summary(spark, sf_dir):
    cut = F.col("ts") >= F.lit(TEST_START).cast("timestamp_ntz")
    actual = series(spark, sf_dir).select("event_type", "ts", T).where(cut)
    return E.prediction_summary(actual, naive(spark, sf_dir).where(cut), T, keys=KEY)


@query("metrics", f"WITH {PRED_SQL} SELECT * FROM metrics", doubles="MSE RMSE MAE MAPE")
def metrics(spark, sf_dir):
    return E.metrics(predictions(spark, sf_dir), by=["model"])


@query("model_rank", f"WITH {PRED_SQL} SELECT *, CAST(row_number() OVER (ORDER BY RMSE, model) AS INTEGER) AS rank FROM metrics", doubles="MSE RMSE MAE MAPE")
def model_rank(spark, sf_dir):
    return E.rank_models(E.metrics(predictions(spark, sf_dir), by=["model"]))


@query("forecast_accuracy", f"""WITH {PRED_SQL}
SELECT model, avg(CAST(p <= 10.0 AS DOUBLE)) * 100 AS accuracy_within_threshold, avg(error) AS mean_error, avg(p) AS mean_pct_error,
  max(error) AS max_overpredict, max(-error) AS max_underpredict
FROM (SELECT *, abs(error / CASE WHEN actual <> 0 THEN actual ELSE 1.0 END) * 100 AS p FROM test) GROUP BY ALL""",
       doubles="accuracy_within_threshold mean_error mean_pct_error max_overpredict max_underpredict")
def forecast_accuracy(spark, sf_dir):
    return E.forecast_accuracy(predictions(spark, sf_dir), by=["model"])


@query("error_by_hour", f"""WITH {PRED_SQL}
SELECT model, 'hour' AS part, CAST(hour(ts) AS INTEGER) AS slot, avg(abs_error) AS mean_abs_error FROM test GROUP BY ALL
UNION ALL SELECT model, 'day_of_week', CAST(isodow(ts) - 1 AS INTEGER), avg(abs_error) FROM test GROUP BY ALL""", doubles="mean_abs_error")
def error_by_hour(spark, sf_dir):
    return E.error_by_time(predictions(spark, sf_dir))


@query("residual_diagnostics", f"""WITH {PRED_SQL}
SELECT model, count(error) AS n, avg(error) AS residual_mean, stddev_samp(error) AS residual_std, skewness(error) AS residual_skew,
  kurtosis(error) AS residual_kurtosis,
  -0.5 * (count(error) * ln(sum(error * error) / count(error)) + count(error) * (1 + ln(2 * pi()))) AS llf,
  count(error) * ln(sum(error * error) / count(error)) + 2.0 * 1 AS aic,
  count(error) * ln(sum(error * error) / count(error)) + 1 * ln(count(error)) AS bic
FROM test GROUP BY ALL""", doubles="residual_mean residual_std residual_skew residual_kurtosis llf aic bic")
def residual_diagnostics(spark, sf_dir):
    return E.residual_diagnostics(predictions(spark, sf_dir), "error", 1, ["model"])


_FOLDS = f"""n AS (SELECT event_type, ts, {T}, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS pos,
    count(*) OVER (PARTITION BY event_type) AS n FROM series),
folds AS (SELECT event_type, ts, {T}, CAST(k AS INTEGER) AS fold,
    CASE WHEN pos < n - (5 - k + 1) * (n // 6) THEN 'train' ELSE 'test' END AS role
  FROM n, (SELECT unnest(range(1, 6)) AS k) WHERE pos < n - (5 - k) * (n // 6))"""


@query("cv_folds", f"""WITH {series_ctes('15min')}, {_FOLDS}
SELECT event_type, fold, role, count(*) AS rows, min(ts) AS "start", max(ts) AS "end", CAST(sum({T}) AS BIGINT) AS total FROM folds GROUP BY ALL""")
def cv_folds(spark, sf_dir):
    folds = expanding_folds(series(spark, sf_dir).select("event_type", "ts", T), 5, keys=KEY, width="15min")
    return folds.groupBy("event_type", "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.sum(T).alias("total"))


@query("cv_folds_gaps", f"""WITH {series_ctes('15min')}, clean AS (SELECT * FROM series WHERE is_storm_period = 0), {_FOLDS.replace('FROM series', 'FROM clean')}
SELECT event_type, fold, role, count(*) AS rows, min(ts) AS "start", max(ts) AS "end", CAST(sum({T}) AS BIGINT) AS total FROM folds GROUP BY ALL""")
def cv_folds_gaps(spark, sf_dir):
    clean = series(spark, sf_dir).where("is_storm_period = 0").select("event_type", "ts", T)
    return expanding_folds(clean, 5, keys=KEY, width="15min").groupBy("event_type", "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.sum(T).alias("total"))


@query("cv_summary", f"""WITH {PRED_SQL.replace("WHERE ts >= TIMESTAMP '" + TEST_START + "'", "")}, {_FOLDS},
m AS (SELECT t.model, fold, sqrt(avg(error * error)) AS RMSE, avg(abs_error) AS MAE, avg(abs(error / nullif(actual, 0))) * 100 AS MAPE
  FROM test t JOIN folds f ON t.event_type = f.event_type AND t.ts = f.ts WHERE role = 'test' GROUP BY ALL)
SELECT model, {', '.join(f'avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max' for c in ('RMSE', 'MAE', 'MAPE'))}
FROM m GROUP BY ALL""", doubles=" ".join(f"{c}_{s}" for c in ("RMSE", "MAE", "MAPE") for s in ("mean", "std", "min", "max")))
def cv_summary(spark, sf_dir):
    s = X.add_lags(naive(spark, sf_dir), T, [1, 96], KEY, width="15min")
    folds = expanding_folds(s, 5, keys=KEY, width="15min").where("role = 'test'")
    models = F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("predicted"))
        for n, c in (("mean_4", "prediction"), ("lag_1", f"{T}_lag_1"), ("lag_96", f"{T}_lag_96"))]))
    long = folds.select("fold", F.col(T).cast("double").alias("actual"), models.alias("_m")).select("fold", "actual", "_m.*")
    return E.cv_summary(E.metrics(long, by=["model", "fold"]), by=["model"])


_CUTOFFS = """spans AS (SELECT event_type, min(ts) AS lo, max(ts) AS hi FROM series GROUP BY ALL),
cutoffs AS (SELECT event_type, unnest(generate_series(
    hi - INTERVAL '1 day' - INTERVAL '7 days' * (date_diff('second', lo + INTERVAL '14 days', hi - INTERVAL '1 day') // (7 * 86400)),
    hi - INTERVAL '1 day', INTERVAL '7 days')) AS cutoff FROM spans)"""


@query("cv_cutoffs", f"""WITH {series_ctes('15min')}, {_CUTOFFS}
SELECT s.event_type, cutoff, CASE WHEN ts <= cutoff THEN 'train' ELSE 'test' END AS role, count(*) AS rows,
  min(ts) AS "start", max(ts) AS "end", CAST(sum({T}) AS BIGINT) AS total
FROM series s JOIN cutoffs c ON s.event_type = c.event_type AND s.ts <= c.cutoff + INTERVAL '1 day' GROUP BY ALL""")
def cv_cutoffs(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    rows = with_cutoffs(s, rolling_cutoffs(s, 14, 7, 1, KEY), 1, KEY)
    return rows.groupBy("event_type", "cutoff", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("start"), F.max("ts").alias("end"), F.sum(T).alias("total"))
