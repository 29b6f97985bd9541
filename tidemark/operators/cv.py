"""Time-ordered cross-validation: expanding folds and rolling cut-offs as tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.functions.timebins import from_seconds, seconds_of
from tidemark.operators.blocks import positioned
from tidemark.operators.regress import cross_products, least_squares, matrix_of


def expanding_folds(
    df: DataFrame, folds: int = 5, test_size: int | None = None, keys: list[str] = (), ts: str = "ts", width=None, removed=(),
) -> DataFrame:
    """Rows repeated per fold with `role`: train on everything before, test on the next part.

    With n rows the test parts are the last `folds` stretches of n // (folds + 1) rows.
    """
    keys = list(keys)
    placed = positioned(df, keys, ts)
    size = placed.groupBy(*keys).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    step = F.lit(test_size) if test_size else F.floor(F.col("_n") / F.lit(folds + 1))
    rank = F.col("_pos") - F.col("_first")
    rows = attach(placed, size, keys).withColumns({"_rank": rank, "_step": step})
    spread = rows.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    begin = F.col("_n") - (F.lit(folds + 1) - F.col("fold")) * F.col("_step")
    return spread.where(F.col("_rank") < begin + F.col("_step")) \
        .withColumn("role", F.when(F.col("_rank") < begin, "train").otherwise("test")) \
        .drop("_pos", "_first", "_n", "_rank", "_step")


def rolling_cutoffs(df: DataFrame, initial_days: float, period_days: float, horizon_days: float, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """`(keys, cutoff)`: from the last possible cut-off back in steps of the period.

    The last cut-off leaves one horizon of data, the first at least the initial span.
    """
    day = 86400
    period, horizon = int(period_days * day), int(horizon_days * day)
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    last = seconds_of("_hi") - horizon
    first = seconds_of("_lo") + int(initial_days * day)
    back = F.floor((last - first) / F.lit(period)).cast("bigint")
    return span.where(last >= first).select(
        *keys, F.explode(F.sequence(last - back * period, last, F.lit(period).cast("bigint"))).alias("_c")) \
        .select(*keys, from_seconds(F.col("_c")).alias("cutoff"))


def with_cutoffs(df: DataFrame, cutoffs: DataFrame, horizon_days: float, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Rows repeated per cut-off they serve: `train` up to it, `test` within the horizon after it.

    The cut-offs of a key are gathered in one short array (span / period entries), so the
    rows are joined by key alone and spread locally.
    """
    keys = list(keys)
    lists = cutoffs.groupBy(*keys).agg(F.sort_array(F.collect_list("cutoff")).alias("_cs"))
    end = F.col("cutoff") + F.make_dt_interval(secs=F.lit(int(horizon_days * 86400)).cast("decimal(18,6)"))
    return attach(df, lists, keys).withColumn("cutoff", F.explode("_cs")).drop("_cs") \
        .where(F.col(ts) <= end).withColumn("role", F.when(F.col(ts) <= F.col("cutoff"), "train").otherwise("test"))


def cutoff_products(
    df: DataFrame, features: list[str], label: str, initial_days: float, period_days: float, horizon_days: float, keys: list[str] = (), ts: str = "ts",
) -> DataFrame:
    """`(keys, cutoff, i, j, train, test)`: cross products of the rows up to each cut-off and of the horizon after it.

    Each row counts once: products are summed per series and stretch between neighbouring cut-offs (cut again where a
    horizon ends), and running sums over the short table of stretches give every cut-off's two systems. Rows with a
    missing value are left out.
    """
    keys = list(keys)
    period, horizon = int(period_days * 86400), int(horizon_days * 86400)
    whole, rest = divmod(horizon, period)
    cutoffs = rolling_cutoffs(df, initial_days, period_days, horizon_days, keys, ts)
    last = cutoffs.groupBy(*keys).agg(F.max("cutoff").alias("_last"))
    # Stretch 2p is the part of period p that a horizon ending inside it takes, stretch 2p + 1 what is left of the period.
    period_of = lambda at: F.ceil((at - seconds_of("_last")) / F.lit(period)).cast("bigint")
    at = seconds_of(ts)
    inside = at - seconds_of("_last") - (period_of(at) - 1) * period
    rows = attach(df.select(*keys, ts, *features, label), last, keys).where(F.col("_last").isNotNull()) \
        .withColumn("_q", 2 * period_of(at) + F.when(inside <= rest, 0).otherwise(1))
    size = len(features) + 2
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(size) for j in range(i, size)])
    marks = attach(cutoffs, last, keys).withColumn("_q", 2 * period_of(seconds_of("cutoff")) + 1) \
        .select(*keys, "_q", "cutoff", F.explode(pairs).alias("_ij")).select(*keys, "_q", "_ij.*", F.lit(0.0).alias("value"), "cutoff")
    sums = cross_products(rows, features, label, [*keys, "_q"]).withColumn("cutoff", F.lit(None).cast("timestamp_ntz"))
    order = Window.partitionBy(*keys, "i", "j").orderBy("_q")
    upto, after = order.rangeBetween(Window.unboundedPreceding, 0), order.rangeBetween(1, 2 * whole + 1)
    return sums.unionByName(marks).groupBy(*keys, "i", "j", "_q").agg(F.sum("value").alias("value"), F.max("cutoff").alias("cutoff")) \
        .withColumns({"train": F.sum("value").over(upto), "test": F.coalesce(F.sum("value").over(after), F.lit(0.0))}) \
        .where("cutoff is not null").select(*keys, "cutoff", "i", "j", "train", "test")


CUTOFF_SCHEMA = "n_train double, n_test double, coef array<double>, gradient double, mse double, rmse double"


def cutoff_scores(
    df: DataFrame, features: list[str], label: str, initial_days: float, period_days: float, horizon_days: float, keys: list[str] = (), ts: str = "ts",
) -> DataFrame:
    """One row per series and cut-off: the least-squares fit up to it and its one-step errors in the horizon after it.

    Both come from the cross products, in one pass over the rows. `gradient` is the largest mean product of the training
    residuals with a regressor. Cut-offs with no more training rows than coefficients have no fit, those without rows
    after them no errors.
    """
    keys = [*keys, "cutoff"]
    products = cutoff_products(df, features, label, initial_days, period_days, horizon_days, keys[:-1], ts)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        train, test = (matrix_of(pdf.assign(value=pdf[c])) for c in ("train", "test"))
        k = len(train) - 1
        n, m = train[0, 0], test[0, 0]
        row = {c: [pdf[c].iloc[0]] for c in keys} | {"n_train": [n], "n_test": [m], "coef": [None], "gradient": [None], "mse": [None], "rmse": [None]}
        if n > k:
            beta = least_squares(train, list(range(k)))[0]
            row |= {"coef": [beta.tolist()], "gradient": [float(np.abs(train[:k, -1] - train[:k, :k] @ beta).max() / n)]}
            if m > 0:
                mse = max(float(test[-1, -1] - 2 * beta @ test[:k, -1] + beta @ test[:k, :k] @ beta), 0.0) / m
                row |= {"mse": [mse], "rmse": [mse ** 0.5]}
        return pd.DataFrame(row)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in products.select(*keys).schema]
    return products.groupBy(*keys).applyInPandas(solve, ", ".join([*fields, CUTOFF_SCHEMA]))
