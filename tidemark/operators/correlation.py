"""Correlations between features, and auto- and partial autocorrelation of series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.operators.blocks import BLOCK_ROWS, overlapping, positioned


def correlation_column(a: str, b: str) -> Column:
    """Pearson correlation over rows where both are present; NULL where either is constant there."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y)))


def feature_correlation(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Pearson correlation of each feature with the target over rows where both are present."""
    one = df.agg(*[correlation_column(f, target).alias(f) for f in features])
    return one.unpivot([], features, "feature", "correlation")


def top_correlated(df: DataFrame, features: list[str], target: str, k: int = 15) -> DataFrame:
    c = feature_correlation(df, features, target)
    return c.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature").limit(k)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete correlations in long form `(a, b, correlation)`, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                 correlation_column(a, b).alias("correlation"))
        for a, b in pairs]).alias("_m"))
    half = one.select(F.explode("_m").alias("m")).select("m.*")
    flipped = half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation")
    return half.unionByName(flipped)


def autocovariance(
    series: DataFrame, value: str, lags: int, keys: list[str] = (), ts: str = "ts", width=None, removed=(),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`(keys, lag, c, n)`: sums of lagged products around the series mean, over n, for lags 0..K.

    Each block of rows, with the K rows before it, gives its share of all K+1 sums from one
    product of spectra, so its cost grows with log K; the shares are added up per key and lag.
    """
    keys = list(keys)
    data = series.where(F.col(value).isNotNull()).select(*keys, ts, F.col(value).cast("double").alias("_x"))
    means = data.groupBy(*keys).agg(F.avg("_x").alias("_m"), F.count("_x").alias("n"))
    placed = overlapping(positioned(data, keys, ts), lags, block_rows=max(block_rows, lags))
    centred = attach(placed, means, keys).select(*keys, "n", "_blk", "_pos", "_own", (F.col("_x") - F.col("_m")).alias("_d"))

    def share(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        d, own = pdf["_d"].to_numpy(), pdf["_own"].to_numpy()
        # Padded by the reach, so that no lag wraps around.
        size = 1 << int(len(d) + lags).bit_length()
        spectrum = np.fft.rfft(np.where(own, d, 0.0), size) * np.conj(np.fft.rfft(d, size))
        sums = np.fft.irfft(spectrum, size)[: lags + 1]
        out = pd.DataFrame({"lag": np.arange(lags + 1, dtype="int32"), "_s": sums, "n": pdf["n"].iloc[0]})
        for c in keys:
            out[c] = pdf[c].iloc[0]
        return out

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in centred.select(*keys, "n").schema]
    parts = centred.groupBy(*keys, "_blk").applyInPandas(share, ", ".join([*fields, "lag int", "_s double"]))
    return parts.groupBy(*keys, "lag").agg((F.sum("_s") / F.max("n")).alias("c"), F.max("n").alias("n"))


def acf(series, value, lags=60, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """Autocorrelation at lags 0..K by the biased estimator, `(keys, lag, acf)`."""
    keys = list(keys)
    cov = autocovariance(series, value, lags, keys, ts, width, removed, block_rows)
    zero = cov.where("lag = 0").select(*keys, F.col("c").alias("_c0"))
    return attach(cov, zero, keys).select(*keys, "lag", F.try_divide("c", "_c0").alias("acf"))


def pacf(series, value, lags=60, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """Partial autocorrelation at lags 0..K from the Yule-Walker equations, `(keys, lag, pacf)`.

    The autocovariances are the cluster's work; per key, K+1 of them are solved by the
    Levinson-Durbin recursion.
    """
    keys = list(keys)
    cov = autocovariance(series, value, lags, keys, ts, width, removed, block_rows).drop("n")

    def recurse(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["c"].to_numpy()
        out, phi, v = [1.0], np.zeros(0), r[0]
        for k in range(1, len(r)):
            last = (r[k] - phi @ r[k - 1:0:-1]) / v if v > 0 else np.nan
            phi = np.append(phi - last * phi[::-1], last)
            v *= 1 - last * last
            out.append(last)
        res = pd.DataFrame({"lag": np.arange(len(r), dtype="int32"), "pacf": out})
        for c in keys:
            res[c] = pdf[c].iloc[0]
        return res

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in cov.select(*keys).schema]
    out = cov.groupBy(*keys).applyInPandas(recurse, ", ".join([*fields, "lag int", "pacf double"]))
    return out.withColumn("pacf", F.when(~F.isnan("pacf"), F.col("pacf")))
