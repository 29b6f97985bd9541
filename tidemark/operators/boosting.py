"""Boosted-tree forecasts with Spark ML: fit, predict, importance, validation, grids, horizons."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.timebins import seconds_of
from tidemark.operators import evaluate as E
from tidemark.operators import trees
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, own_rows, positioned
from tidemark.operators.cv import expanding_folds
from tidemark.session import settled

# Learning rate, feature and row fractions, seed. Depth 5 stands for 31 leaves.
GBT_DEFAULTS = {
    "stepSize": 0.05, "featureSubsetStrategy": "0.9", "subsamplingRate": 0.8, "maxDepth": 5, "maxBins": 64, "seed": 42,
}


#: Fits that run at the same time, and boosting rounds that may fail to better the validation error.
SIDE_BY_SIDE, PATIENCE = 4, 50


@contextmanager
def cached(*tables: DataFrame):
    """The tables kept by Spark while the block runs, and released at its end."""
    kept = [t.persist(StorageLevel.MEMORY_AND_DISK) for t in tables]
    try:
        yield kept if len(kept) > 1 else kept[0]
    finally:
        for t in kept:
            t.unpersist()


def side_by_side(work: Callable, items: list, workers: int = SIDE_BY_SIDE) -> list:
    """`work(item)` of every item, a bounded number at a time, each in a scheduler pool of its own; results in order."""
    context = SparkSession.getActiveSession().sparkContext

    def one(numbered):
        n, item = numbered
        context.setLocalProperty("spark.scheduler.pool", f"fit-{n % workers}")
        return work(item)

    with ThreadPool(workers) as pool:
        return pool.map(inheritable_thread_target(SparkSession.getActiveSession())(one), list(enumerate(items)), chunksize=1)


def fit_gbt(
    train: DataFrame, features: list[str], label: str = "label", validation: DataFrame | None = None,
    categorical: list[str] = (), max_iter: int = 200, patience: int | None = None, **params,
) -> PipelineModel:
    """Fit a boosted-tree regression; with a validation set boosting stops when it no longer helps.

    With `patience` the validation error is followed round by round, and the ensemble is cut to its best round before
    `patience` rounds in a row bettered nothing; without it Spark's own tolerance decides.
    """
    if validation is not None and patience is not None:
        model = fit_gbt(train, features, label, None, categorical, max_iter, **params)
        curve = validation_curve(model, validation, label)
        rounds = trees.best_round([r.mse for r in curve.orderBy("round").collect()], patience)
        return PipelineModel([*model.stages[:-1], trees.truncated(model.stages[-1], rounds)])
    numeric = [f for f in features if f not in categorical]
    # Rows with gaps do not train; at prediction a missing value takes the upper branch, so
    # every row gets a prediction.
    complete = lambda df: df.na.drop(subset=[*numeric, label])
    data = complete(train).withColumn("_valid", F.lit(False))
    gbt = GBTRegressor(featuresCol="_features", labelCol=label, predictionCol="_raw", maxIter=max_iter, **{**GBT_DEFAULTS, **params})
    if validation is not None:
        data = data.unionByName(complete(validation).withColumn("_valid", F.lit(True)))
        gbt = gbt.setValidationIndicatorCol("_valid")
    stages = [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep") for c in categorical]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"_i_{c}" for c in categorical]], outputCol="_features", handleInvalid="keep"))
    return Pipeline(stages=[*stages, gbt]).fit(data)


def validation_curve(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """`(round, mse)` of a fitted ensemble on the complete rows of `df`, after each of its rounds."""
    names = trees.inputs(model)
    indexed = PipelineModel(model.stages[:-2]).transform(df) if len(model.stages) > 2 else df
    return trees.staged_errors(trees.NodeArrays.of(model.stages[-1], df.sparkSession), indexed, names, label)


def predict_gbt(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Add the prediction, never below 0."""
    return model.transform(df).withColumn(name, F.greatest(F.col("_raw"), F.lit(0.0))).select(*df.columns, name)


def feature_importance(model: PipelineModel, top_n: int = 20) -> DataFrame:
    """`(feature, importance)`, the `top_n` largest; one row per model input."""
    gbt, names = model.stages[-1], model.stages[-2].getInputCols()
    spark = SparkSession.getActiveSession()
    rows = [(n.removeprefix("_i_"), float(v)) for n, v in zip(names, gbt.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top_n)


def holdout(df: DataFrame, share: float = 0.2, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Cut the last `share` of the time span off as a validation set."""
    at = seconds_of(ts)
    cut = df.agg((F.min(at) + (F.max(at) - F.min(at)) * (1 - share)).alias("c")).scalar()
    return df.where(at <= cut), df.where(at > cut)


_SCORES = "MSE double, RMSE double, MAE double, MAPE double"


def cross_validate(df: DataFrame, features: list[str], label: str = "label", folds: int = 5, keys: list[str] = (), ts: str = "ts", width=None, **params) -> DataFrame:
    """`(fold, MSE, RMSE, MAE, MAPE)` of expanding-window folds; the fits run side by side over one saved table.

    Every task of a fit reports the metrics of all plans in its lineage to the driver, thousands of times over; of a saved
    table that is a scan, in as many parts as its bytes need.
    """
    rows = expanding_folds(df, folds, keys=keys, ts=ts).select("fold", "role", *dict.fromkeys([*features, label]))
    table = settled(rows, "folds", ["fold"])

    def score(k: int):
        fold = table.where(F.col("fold") == k)
        model = fit_gbt(fold.where("role = 'train'"), features, label, **params)
        return (k, *E.metrics(predict_gbt(model, fold.where("role = 'test'")), label, "prediction").first())

    return df.sparkSession.createDataFrame(side_by_side(score, list(range(1, folds + 1))), f"fold int, {_SCORES}")


def grid_search(train: DataFrame, test: DataFrame, features: list[str], label: str = "label", grid: dict[str, list] | None = None, **params) -> DataFrame:
    """Error metrics for every combination of two or more parameters, in long form; the fits run side by side."""
    grid = grid or {"maxDepth": [4, 5, 6], "stepSize": [0.01, 0.05, 0.1]}
    combos: list[dict] = [{}]
    for name, values in grid.items():
        combos = [{**c, name: v} for c in combos for v in values]
    with cached(train, test) as (fit, hold):
        def score(c: dict):
            model = fit_gbt(fit, features, label, **{**params, **c})
            return (*(float(c[n]) for n in grid), *E.metrics(predict_gbt(model, hold), label, "prediction").first())

        return train.sparkSession.createDataFrame(side_by_side(score, combos), ", ".join([*(f"`{n}` double" for n in grid), _SCORES]))


def grid_pivot(results: DataFrame, rows: str, columns: str, values: list[float], metric: str = "RMSE") -> DataFrame:
    """One line per value of `rows`, one column per value of `columns`."""
    wide = results.groupBy(rows).pivot(columns, values).agg(F.first(metric))
    return wide.select(rows, *[F.col(f"`{v}`").alias(f"{columns}_{str(v).replace('.', '_')}") for v in values])


def direct_labels(df: DataFrame, target: str, horizons: list[int], keys: list[str] = (), ts: str = "ts", width=None, removed=(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows repeated per horizon with `horizon` and `label` = the target that many rows ahead (NULL past the end)."""
    keys = list(keys)
    placed = overlapping(positioned(df, keys, ts), 0, max(horizons), block_rows)
    w = block_window(keys)
    pairs = placed.withColumns({f"_h{h}": F.lead(F.col(target).cast("double"), h).over(w) for h in horizons})
    long = own_rows(pairs).withColumn("_p", F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"_h{h}").alias("label")) for h in horizons])))
    return long.withColumns({"horizon": F.col("_p.horizon"), "label": F.col("_p.label")}).drop("_p", *[f"_h{h}" for h in horizons])


def forecast_direct(df: DataFrame, target: str, features: list[str], horizons: list[int], keys: list[str] = (), ts: str = "ts", width=None, **params) -> DataFrame:
    """`(keys, horizon, prediction)` after each series' last row, from one model with the horizon as a feature."""
    keys = list(keys)
    long = direct_labels(df, target, horizons, keys, ts, width).where(F.col("label").isNotNull())
    model = fit_gbt(settled(long.select(*features, "horizon", "label"), "horizons"), [*features, "horizon"], "label", **params)
    ends = df.groupBy(*keys).agg(F.max_by(F.struct(ts, *features), ts).alias("_r")).select(*keys, "_r.*")
    last = ends.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return predict_gbt(model, last).select(*keys, F.col(ts).alias("origin"), "horizon", "prediction")


def recursive_forecast(
    model: PipelineModel, last_rows: DataFrame, steps: int, update: Callable[[DataFrame, int], DataFrame] | None = None,
    keys: list[str] = (), checkpoint_every: int = 16,
) -> DataFrame:
    """`(keys, step, prediction)`: predict, let `update(rows_with_prediction, step)` make the next feature rows, repeat.

    `last_rows` holds one feature row per series. Without `update` every step repeats the
    first prediction. Lineage is cut by checkpoints to the session's checkpoint folder.
    """
    rows, out = last_rows, None
    for step in range(1, steps + 1):
        predicted = predict_gbt(model, rows)
        one = predicted.select(*keys, F.lit(step).alias("step"), "prediction")
        out = one if out is None else out.unionByName(one)
        if update is None:
            return one.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), "prediction")
        if step < steps:
            rows = update(predicted, step)
            if step % checkpoint_every == 0:
                rows, out = rows.checkpoint(), out.checkpoint()
    return out


def tree_band(df: DataFrame, prediction: str = "prediction", share: float = 0.2) -> DataFrame:
    """`lower` and `upper`: a fixed share around the prediction, as trees give no interval."""
    return df.withColumns({"lower": F.greatest(F.col(prediction) * (1 - share), F.lit(0.0)), "upper": F.col(prediction) * (1 + share)})
