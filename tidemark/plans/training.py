"""Composed jobs: ingest a log, train and evaluate forecasts, tabulate forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import boosting as B
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import fourier as Q
from tidemark.operators import seasonal as A
from tidemark.operators import trees
from tidemark.operators.series import all_granularities, split_train_test
from tidemark.schemas import OUTAGE, TEST_START
from tidemark.session import settled
from tidemark.sources import clf, tables


def ingest(spark: SparkSession, paths: list[str], out: str, outages=(OUTAGE,)) -> DataFrame:
    """Log files to the saved 1-, 5- and 15-minute series; later jobs read the saved table."""
    tables.save_series(all_granularities(clf.read_log(spark, paths), outages=outages), out)
    return tables.load_series(spark, out)


def train_and_evaluate(
    clean: DataFrame, targets=("request_count", "bytes_total"), test_start: str = TEST_START, keys: list[str] = (),
    granularity: str = "15min", removed=(OUTAGE,), max_iter: int = 200, horizon: int = 96, models: str | None = None,
) -> DataFrame:
    """Errors of the three model families per target on the test split, `(target, model, horizon, ..)`.

    Trees are scored one step ahead with true lags; the regressions forecast the first
    `horizon` bins of the test split at once. `horizon` says which. With `models` the fitted models of every target are
    saved below that folder. Targets train side by side; nothing stays cached.
    """
    keys, season = list(keys), A.SEASONS[granularity]
    with B.cached(clean.select(*keys, "ts", *targets)) as table:
        def one(target: str) -> list[tuple]:
            train, test = split_train_test(table.select(*keys, "ts", target), test_start)
            feats = X.all_features(table.select(*keys, "ts", target), target, granularity, keys)
            # Relative changes are missing wherever the earlier value is 0, and rows with a gap do not train.
            names = [c for c in X.feature_columns(feats, keys=keys) if "_pct_change_" not in c]
            fit, hold = split_train_test(settled(X.supervised(feats, target, names, 1, keys=keys), "supervised"), test_start)
            grown = B.fit_gbt(fit, names, max_iter=max_iter)
            scored = [("boosted trees", 1, E.metrics(B.predict_gbt(grown, hold), "label", "prediction").first())]
            sar = A.fit_seasonal_ar(train, target, season=season, keys=keys)
            path = A.forecast_seasonal_ar(train, target, sar, horizon, granularity, keys=keys, max_lag=season + 1)
            model = Q.FourierModel(width=granularity, keys=tuple(keys))
            fits = Q.fit_fourier(train, target, model)
            curve = Q.predict_fourier(Q.future_grid(fits, horizon, model), fits, model)
            for name, df, col in (("seasonal autoregression", path, "forecast"), ("trend and seasonality", curve, "yhat")):
                scored.append((name, horizon, E.metrics(E.prediction_summary(test, df, target, col, keys)).first()))
            if models is not None:
                tables.save_model(grown, f"{models}/{target}/trees")
                tables.save_coefficients(sar, f"{models}/{target}/seasonal")
                tables.save_coefficients(fits, f"{models}/{target}/trend")
            return [(target, name, h, *found) for name, h, found in scored]

        rows = [r for found in B.side_by_side(one, list(targets)) for r in found]
    return clean.sparkSession.createDataFrame(rows, "target string, model string, horizon int, MSE double, RMSE double, MAE double, MAPE double")


def forecast_table(clean: DataFrame, target: str, model: str, horizon: int = 96, keys: list[str] = (), granularity: str = "15min", removed=(OUTAGE,), max_iter: int = 200, alpha: float = 0.05) -> DataFrame:
    """`(keys, ts, value, lower, upper)` of the next bins by one model family; deterministic."""
    keys = list(keys)
    if horizon < 1:
        raise ValueError("horizon must be positive")
    if model == "seasonal":
        season = A.SEASONS[granularity]
        fits = A.fit_seasonal_ar(clean, target, season=season, keys=keys, width=granularity, removed=removed)
        f = A.forecast_seasonal_ar(clean, target, fits, horizon, granularity, alpha, keys, removed=removed, max_lag=season + 1)
        return f.select(*keys, "ts", F.col("forecast").alias("value"), "lower", "upper")
    if model == "fourier":
        m = Q.FourierModel(width=granularity, keys=tuple(keys))
        fits = Q.fit_fourier(clean, target, m)
        f = Q.predict_fourier(Q.future_grid(fits, horizon, m), fits, m, alpha=alpha)
        return f.select(*keys, "ts", F.col("yhat").alias("value"), F.col("yhat_lower").alias("lower"), F.col("yhat_upper").alias("upper"))
    if model == "trees":
        feats = X.all_features(clean.select(*keys, "ts", target), target, granularity, keys, removed=removed)
        names = [c for c in X.feature_columns(feats, keys=keys) if "_pct_change_" not in c]
        sup = settled(X.supervised(feats, target, names, 1, keys=keys, width=granularity, removed=removed), "supervised")
        fitted = B.fit_gbt(sup, names, max_iter=max_iter)
        path = B.tree_band(trees.forecast_recursive(fitted, feats, target, horizon, granularity, keys))
        return path.select(*keys, "ts", F.col("prediction").alias("value"), "lower", "upper")
    raise ValueError(f"unknown model {model!r}")


def forecast_summary(table: DataFrame, keys: list[str] = ()) -> DataFrame:
    return table.groupBy(*keys).agg(F.avg("value").alias("mean"), F.max("value").alias("max"), F.min("value").alias("min"))
