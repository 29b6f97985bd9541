"""Forecast evaluation: error metrics, ranking, cross-validation summary, prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_ratio
from tidemark.functions.stats import sample_kurtosis, sample_skewness


def prediction_summary(
    actual: DataFrame, predicted: DataFrame, value: str, prediction: str = "prediction", keys: list[str] = (), ts: str = "ts",
) -> DataFrame:
    """Actual and predicted values joined on key and time, with their errors.

    The percentage divides by the signed actual value and is NULL where that is 0.
    """
    on = [*keys, ts]
    joined = actual.select(*on, F.col(value).cast("double").alias("actual")).join(
        predicted.select(*on, F.col(prediction).cast("double").alias("predicted")), on)
    return with_errors(joined)


def with_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    error = F.col(predicted) - F.col(actual)
    return df.withColumns({
        "error": error, "abs_error": F.abs(error), "pct_error": safe_ratio(F.abs(error), F.col(actual)) * 100,
    })


def _metric_columns(y: Column, p: Column) -> dict[str, Column]:
    e = p - y
    return {
        "MSE": F.avg(e * e), "RMSE": F.sqrt(F.avg(e * e)), "MAE": F.avg(F.abs(e)),
        "MAPE": F.avg(F.abs(F.try_divide(e, y))) * 100,
    }


def metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] = (), prefix: str = "",
) -> DataFrame:
    """MSE, RMSE, MAE and MAPE in percent per group; MAPE skips zero actuals and may be NULL."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.groupBy(*by).agg(*[c.alias(f"{prefix}{n}") for n, c in _metric_columns(y, p).items()])


def rank_models(results: DataFrame, metric: str = "RMSE", ascending: bool = True, model: str = "model") -> DataFrame:
    """Models ordered by a metric with `rank` 1..n; one row per model, so one small sort."""
    order = [F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric), F.asc(model)]
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


def cv_summary(folds: DataFrame, names: list[str] = ("RMSE", "MAE", "MAPE"), by: list[str] = ()) -> DataFrame:
    """Mean, population spread, minimum and maximum of each metric over the folds."""
    out = []
    for n in names:
        out += [F.avg(n).alias(f"{n}_mean"), F.stddev_pop(n).alias(f"{n}_std"), F.min(n).alias(f"{n}_min"), F.max(n).alias(f"{n}_max")]
    return folds.groupBy(*by).agg(*out)


def forecast_accuracy(
    df: DataFrame, threshold_pct: float = 10.0, actual: str = "actual", predicted: str = "predicted", by: list[str] = (),
) -> DataFrame:
    """Share within a percentage threshold, mean errors, largest over- and under-prediction."""
    y, e = F.col(actual).cast("double"), F.col(predicted) - F.col(actual)
    pct = F.abs(e / F.when(y != 0, y).otherwise(F.lit(1.0))) * 100
    return df.groupBy(*by).agg(
        (F.avg((pct <= threshold_pct).cast("double")) * 100).alias("accuracy_within_threshold"),
        F.avg(e).alias("mean_error"), F.avg(pct).alias("mean_pct_error"),
        F.max(e).cast("double").alias("max_overpredict"), F.max(-e).cast("double").alias("max_underpredict"))


def error_by_time(df: DataFrame, by: list[str] = ("model",), ts: str = "ts") -> DataFrame:
    """Mean absolute error by hour of day and by day of week, `(by, part, slot, mean_abs_error)`."""
    slots = F.explode(F.array(
        F.struct(F.lit("hour").alias("part"), F.hour(ts).alias("slot")),
        F.struct(F.lit("day_of_week").alias("part"), F.weekday(ts).alias("slot"))))
    return df.select(*by, "abs_error", slots.alias("_s")).groupBy(*by, "_s.part", "_s.slot") \
        .agg(F.avg("abs_error").alias("mean_abs_error"))


def residual_diagnostics(df: DataFrame, residual: str, parameters: int, by: list[str] = ()) -> DataFrame:
    """Residual moments (bias-corrected), Gaussian log-likelihood, AIC and BIC."""
    n, sse = F.count(residual).cast("double"), F.sum(F.col(residual) * F.col(residual))
    fit = n * F.log(sse / n)
    return df.groupBy(*by).agg(
        F.count(residual).alias("n"), F.avg(residual).alias("residual_mean"), F.stddev_samp(residual).alias("residual_std"),
        sample_skewness(residual).alias("residual_skew"), sample_kurtosis(residual).alias("residual_kurtosis"),
        (-0.5 * (fit + n * (1 + F.log(F.lit(2.0) * F.pi())))).alias("llf"),
        (fit + 2.0 * parameters).alias("aic"), (fit + parameters * F.log(n)).alias("bic"))
