"""Anomaly detectors on keyed series; every detector is a column of one plan.

Whole-series statistics are one small aggregate joined back by key; frame statistics share
one blocked exchange. Flags are never NULL: where a score cannot be computed the flag is
false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach, exact_quantiles
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, own_rows, positioned

# The detectors' default parameters.
DEFAULTS = {
    "zscore": {"threshold": 3.0},
    "iqr": {"k": 1.5},
    "rolling": {"window": 24, "threshold": 2.5},
    "spike": {"window": 4, "threshold": 2.0},
    "drop": {"window": 4, "threshold": 0.5},
}
COMBINED_METHODS = ("zscore", "iqr", "rolling", "spike")
METHOD_LABELS = {
    "zscore": "Z-Score", "iqr": "IQR", "rolling": "Rolling Window", "spike": "Spike Detection",
    "drop": "Drop Detection", "ddos": "DDoS Pattern", "isolation_forest": "Isolation Forest",
}
SEVERE_SCORE = 3
COMBINED_THRESHOLD = 2

_FRAMED = ("rolling", "spike", "drop")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def detect(
    series: DataFrame, value: str, methods=COMBINED_METHODS, params: dict[str, dict] | None = None,
    keys: list[str] = (), ts: str = "ts", width=None, removed=(), block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `is_<method>` per method, and the z-scores `zscore` and `rolling_zscore` where computed."""
    unknown = set(methods) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown methods {sorted(unknown)}")
    keys = list(keys)
    p = {m: {**DEFAULTS[m], **(params or {}).get(m, {})} for m in methods}
    stats = [F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std")]
    df = attach(series, series.groupBy(*keys).agg(*stats), keys)
    if "iqr" in p:
        quartiles = exact_quantiles(series, value, {"_q1": 0.25, "_q3": 0.75}, keys)
        df = attach(df, quartiles, keys)
    x = F.col(value)
    new: dict[str, Column] = {}
    if "zscore" in p:
        z = F.try_divide(x - F.col("_mean"), F.col("_std"))
        new["zscore"] = z
        new["is_zscore"] = _flag(F.abs(z) > p["zscore"]["threshold"])
    if "iqr" in p:
        reach = p["iqr"]["k"] * (F.col("_q3") - F.col("_q1"))
        new["is_iqr"] = _flag((x < F.col("_q1") - reach) | (x > F.col("_q3") + reach))
    df = df.withColumns(new)
    if any(m in _FRAMED for m in p):
        back = max(p[m]["window"] for m in p if m in _FRAMED)
        df = overlapping(positioned(df, keys, ts), back, block_rows=block_rows)
        w = block_window(keys)
        framed: dict[str, Column] = {}
        if "rolling" in p:
            frame = w.rowsBetween(-(p["rolling"]["window"] - 1), 0)
            std = F.stddev_samp(value).over(frame)
            # Only a spread of exactly 0 falls back to the series' spread; a missing one does not.
            z = F.try_divide(x - F.avg(value).over(frame), F.when(std == 0, F.col("_std")).otherwise(std))
            framed["rolling_zscore"] = z
            framed["is_rolling"] = _flag(F.abs(z) > p["rolling"]["threshold"])
        if "spike" in p:
            frame = w.rowsBetween(-p["spike"]["window"], -1)
            base = F.coalesce(F.avg(value).over(frame), F.col("_mean"))
            spread = F.coalesce(F.stddev_samp(value).over(frame), F.col("_std"))
            prev = F.lag(value).over(w)
            jump = F.when(prev == 0, x != 0).otherwise(F.abs(F.try_divide(x - prev, prev)) > 1.0)
            framed["is_spike"] = _flag((x > base + p["spike"]["threshold"] * spread) & jump)
        if "drop" in p:
            frame = w.rowsBetween(-p["drop"]["window"], -1)
            base = F.coalesce(F.avg(value).over(frame), F.col("_mean"))
            framed["is_drop"] = _flag(x < p["drop"]["threshold"] * base)
        df = own_rows(df.withColumns(framed))
    return df.drop("_mean", "_std", "_q1", "_q3")


def detect_zscore(series, value, threshold=3.0, **options) -> DataFrame:
    return detect(series, value, ["zscore"], {"zscore": {"threshold": threshold}}, **options)


def detect_iqr(series, value, k=1.5, **options) -> DataFrame:
    return detect(series, value, ["iqr"], {"iqr": {"k": k}}, **options)


def detect_rolling(series, value, window=24, threshold=2.5, **options) -> DataFrame:
    return detect(series, value, ["rolling"], {"rolling": {"window": window, "threshold": threshold}}, **options)


def detect_spikes(series, value, window=4, threshold=2.0, **options) -> DataFrame:
    return detect(series, value, ["spike"], {"spike": {"window": window, "threshold": threshold}}, **options)


def detect_drops(series, value, window=4, threshold=0.5, **options) -> DataFrame:
    return detect(series, value, ["drop"], {"drop": {"window": window, "threshold": threshold}}, **options)


def detect_ddos(
    series: DataFrame, traffic: str = "request_count", hosts: str = "unique_hosts", traffic_threshold: float = 2.0,
    host_ratio_threshold: float = 0.5, keys: list[str] = (),
) -> DataFrame:
    """Add `is_ddos`: unusually much traffic from unusually few hosts."""
    keys = list(keys)
    stats = series.groupBy(*keys).agg(F.avg(traffic).alias("_mean"), F.stddev_samp(traffic).alias("_std"))
    z = F.try_divide(F.col(traffic) - F.col("_mean"), F.col("_std"))
    ratio = F.coalesce(F.try_divide(F.col(hosts), F.col(traffic)), F.lit(1.0))
    return attach(series, stats, keys) \
        .withColumn("is_ddos", _flag((z > traffic_threshold) & (ratio < host_ratio_threshold))).drop("_mean", "_std")


def combined_score(
    series: DataFrame, value: str, methods=COMBINED_METHODS, weights: dict[str, float] | None = None, **options,
) -> DataFrame:
    """Add the flags and `score`, the weighted number of methods that flag the row."""
    flagged = detect(series, value, methods, **options)
    score = F.lit(0.0)
    for m in methods:
        score = score + F.col(f"is_{m}").cast("double") * (weights or {}).get(m, 1.0)
    return flagged.withColumn("score", score)


def report(scored: DataFrame, methods=COMBINED_METHODS, keys: list[str] = ()) -> DataFrame:
    """One row per key and method: label, rows, anomalies and rate in percent."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(m).alias("method"), F.lit(METHOD_LABELS[m]).alias("label"), F.col(f"is_{m}").alias("hit"))
        for m in methods]))
    return scored.select(*keys, pairs.alias("_p")).groupBy(*keys, "_p.method", "_p.label").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("_p.hit").alias("anomaly_count"),
        (F.count_if("_p.hit") * 100.0 / F.count(F.lit(1))).alias("anomaly_rate"))


def severe(scored: DataFrame, value: str, keys: list[str] = (), ts: str = "ts", score: float = SEVERE_SCORE) -> DataFrame:
    """Rows flagged by at least `score` methods."""
    return scored.where(F.col("score") >= score).select(*keys, ts, value, "score")


def anomaly_timestamps(
    series: DataFrame, value: str, method: str = "combined", threshold: float = COMBINED_THRESHOLD,
    keys: list[str] = (), ts: str = "ts", **options,
) -> DataFrame:
    """Timestamps flagged by one method, or by at least `threshold` of the default ones."""
    keys = list(keys)
    if method == "combined":
        hits = combined_score(series, value, keys=keys, ts=ts, **options).where(F.col("score") >= threshold)
    else:
        hits = detect(series, value, [method], keys=keys, ts=ts, **options).where(f"is_{method}")
    return hits.select(*keys, ts)


def anomaly_points(
    series: DataFrame, value: str, method: str = "zscore", threshold: float = 3.0, window: int = 24,
    keys: list[str] = (), ts: str = "ts", limit: int | None = None, **options,
) -> DataFrame:
    """The anomalies (the first `limit`, where given) with value, score and whether they lie above or below the mean.

    The score is the threshold itself unless the combined score is asked for.
    """
    keys = list(keys)
    if method == "combined":
        hits = combined_score(series, value, keys=keys, ts=ts, **options)
        hit, score = F.col("score") >= threshold, F.col("score")
    else:
        own = {"zscore": {"threshold": threshold}, "iqr": {"k": threshold},
               "rolling": {"window": window, "threshold": threshold}}[method]
        hits = detect(series, value, [method], {method: own}, keys=keys, ts=ts, **options)
        hit, score = F.col(f"is_{method}"), F.lit(float(threshold))
    mean = series.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    out = attach(hits.where(hit).select(*keys, ts, value, score.alias("score")), mean, keys).select(
        *keys, ts, F.col(value).cast("double").alias("value"), "score",
        F.when(F.col(value) > F.col("_mean"), "high").otherwise("low").alias("type"))
    return out if limit is None else out.orderBy(ts, *keys).limit(limit)
