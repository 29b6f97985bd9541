"""Trend plus seasonality: linear trend with changepoints and Fourier terms, per series."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach
from tidemark.functions.timebins import from_seconds, seconds_of, width_seconds
from tidemark.operators import regress

DAY = 86400

# Season length in seconds and number of harmonics.
SEASONALITIES = {"daily": (DAY, 4), "weekly": (7 * DAY, 3), "hourly": (3600, 5)}
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8


@dataclass(frozen=True)
class FourierModel:
    """What to fit; `multiplicative` models log(1 + y)."""

    width: str | int = "15min"
    multiplicative: bool = True
    seasons: tuple[str, ...] = ("daily", "weekly", "hourly")
    changepoints: int = CHANGEPOINTS
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    keys: tuple[str, ...] = field(default=())

    def harmonics(self, season: str) -> int:
        """Harmonics the bin width can tell apart: at most half the bins per period."""
        period, order = SEASONALITIES[season]
        return min(order, int(period // (2 * width_seconds(self.width))))

    def seasonal_names(self, season: str) -> list[str]:
        return [f"{season}_{f}_{k}" for k in range(1, self.harmonics(season) + 1) for f in ("sin", "cos")]

    def hinge_names(self) -> list[str]:
        return [f"hinge_{i}" for i in range(1, self.changepoints + 1)]

    def features(self) -> list[str]:
        return ["trend", *self.hinge_names(), *[n for s in self.seasons for n in self.seasonal_names(s)]]

    def priors(self) -> tuple[list[float], list[float]]:
        """Scales of the Laplace priors of the slope changes and of the normal priors of the seasonal terms; infinite where there is none."""
        none, seasonal = float("inf"), sum(len(self.seasonal_names(s)) for s in self.seasons)
        laplace = [none, *[self.changepoint_prior_scale] * self.changepoints, *[none] * seasonal]
        return laplace, [none, *[none] * self.changepoints, *[self.seasonality_prior_scale] * seasonal]


def fourier_columns(model: FourierModel, ts: str = "ts") -> dict[str, Column]:
    """Sine and cosine terms of wall-clock time; the phase is taken inside the period to stay exact."""
    sec, out = seconds_of(ts), {}
    for s in model.seasons:
        period = SEASONALITIES[s][0]
        phase = F.pmod(sec, F.lit(period)) / F.lit(float(period))
        for k in range(1, model.harmonics(s) + 1):
            out[f"{s}_sin_{k}"] = F.sin(2 * math.pi * k * phase)
            out[f"{s}_cos_{k}"] = F.cos(2 * math.pi * k * phase)
    return out


def scaled_time(ts: str = "ts") -> Column:
    """Time as 0..1 over the history whose first and last second are `_lo` and `_hi`."""
    return (seconds_of(ts) - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1)).cast("double")


def hinge_starts(model: FourierModel) -> list[float]:
    return [CHANGEPOINT_RANGE * i / model.changepoints for i in range(1, model.changepoints + 1)]


def trend_columns(model: FourierModel, ts: str = "ts") -> dict[str, Column]:
    """Scaled time, and one hinge per changepoint in the history's first part."""
    t = scaled_time(ts)
    return {"trend": t, **{f"hinge_{i}": F.greatest(t - c, F.lit(0.0)) for i, c in enumerate(hinge_starts(model), 1)}}


def design_array(model: FourierModel, ts: str = "ts") -> Column:
    """All features of a row as one array, in the order of `model.features()`."""
    t, sec = scaled_time(ts), seconds_of(ts)
    hinges = F.transform(F.array(*[F.lit(c) for c in hinge_starts(model)]), lambda c: F.greatest(t - c, F.lit(0.0)))
    parts = [F.array(t), hinges]
    terms = [F.struct(F.lit(SEASONALITIES[s][0]).alias("period"), F.lit(k).alias("k"))
             for s in model.seasons for k in range(1, model.harmonics(s) + 1)]
    if terms:
        def pair(term):
            angle = F.lit(2 * math.pi) * term["k"] * (F.pmod(sec, term["period"]) / term["period"].cast("double"))
            return F.array(F.sin(angle), F.cos(angle))
        parts.append(F.flatten(F.transform(F.array(*terms), pair)))
    return F.concat(*parts)


def named_design(df: DataFrame, spans: DataFrame, model: FourierModel, ts: str = "ts") -> DataFrame:
    """The features as named columns, for inspection."""
    return attach(df, spans, list(model.keys)).withColumns({**trend_columns(model, ts), **fourier_columns(model, ts)})


def history_spans(df: DataFrame, model: FourierModel, ts: str = "ts") -> DataFrame:
    sec = seconds_of(ts)
    return df.groupBy(*model.keys).agg(F.min(sec).alias("_lo"), F.max(sec).alias("_hi"))


def _framed(df: DataFrame, value: str, spans: DataFrame, model: FourierModel, ts: str) -> DataFrame:
    y = F.col(value).cast("double")
    return attach(df.select(*model.keys, ts, (F.log1p(y) if model.multiplicative else y).alias("_y")), spans, list(model.keys)).withColumn("_x", design_array(model, ts))


def fit_fourier(df: DataFrame, value: str, model: FourierModel, ts: str = "ts") -> DataFrame:
    """One row per series: the regression's coefficients and spread, and the history's span.

    Slope changes are sparse: those that the history does not bear out are exactly 0.
    """
    keys = list(model.keys)
    spans = history_spans(df, model, ts)
    return attach(regress.fit_sparse(_framed(df, value, spans, model, ts), "_x", "_y", *model.priors(), keys), spans, keys)


def optimality(df: DataFrame, value: str, models: DataFrame, model: FourierModel, ts: str = "ts") -> DataFrame:
    """`(keys, n_obs, violation)`: by how much, per row, a coefficient misses its condition; 0 at the optimum.

    The summed products of residual and feature equal the slope of the coefficient's prior, or, where the coefficient is
    0, stay within the threshold.
    """
    keys = list(model.keys)
    rows = attach(_framed(df, value, models.select(*keys, "_lo", "_hi"), model, ts), models.select(*keys, "coef"), keys).where(F.col("_y").isNotNull() & F.col("coef").isNotNull())
    z = F.concat(F.array(F.lit(1.0)), F.col("_x"))
    rest = F.col("_y") - F.aggregate(F.zip_with(z, F.col("coef"), lambda x, c: x * c), F.lit(0.0), lambda s, v: s + v)
    pulls = rows.select(*keys, F.posexplode(F.transform(z, lambda x: x * rest)).alias("_j", "_g")).groupBy(*keys, "_j").agg(F.sum("_g").alias("_g"), F.count("_g").alias("n_obs"))
    at = attach(pulls, models.select(*keys, "coef", "l1", "l2"), keys)
    b, l1, l2 = (F.element_at(c, F.col("_j") + 1) for c in ("coef", "l1", "l2"))
    missed = F.when((b == 0) & (l1 > 0), F.greatest(F.abs(F.col("_g")) - l1, F.lit(0.0))).otherwise(F.abs(F.col("_g") - l2 * b - l1 * F.signum(b)))
    return at.groupBy(*keys).agg(F.max("n_obs").alias("n_obs"), (F.max(missed) / F.max("n_obs")).alias("violation"))


def future_grid(models: DataFrame, periods: int, model: FourierModel) -> DataFrame:
    """The `periods` bins after each series' history."""
    w = width_seconds(model.width)
    step = F.explode(F.sequence(F.lit(1), F.lit(periods)))
    return models.select(*model.keys, "_hi", step.alias("step")).select(
        *model.keys, "step", from_seconds(F.col("_hi") + F.col("step") * w).alias("ts"))


def predict_fourier(grid: DataFrame, models: DataFrame, model: FourierModel, ts: str = "ts", alpha: float = 0.2) -> DataFrame:
    """Adds `yhat`, `yhat_lower`, `yhat_upper` (never below 0) and the components of each row.

    Components are on the modelled scale: their sum is log(1 + yhat) when multiplicative.
    """
    keys = list(model.keys)
    z = NormalDist().inv_cdf(1 - alpha / 2)
    framed = attach(grid, models.select(*keys, "_lo", "_hi", "coef", "sigma"), keys).withColumn(
        "_c", F.zip_with(design_array(model, ts), F.slice("coef", 2, len(model.features())), lambda x, c: x * c))

    def part(first: int, n: int) -> Column:
        return F.aggregate(F.slice("_c", first + 1, n), F.lit(0.0), lambda acc, v: acc + v)

    at = 1 + model.changepoints
    comps = {"trend_component": F.col("coef")[0] + part(0, at)}
    for s in model.seasons:
        n = len(model.seasonal_names(s))
        comps[f"{s}_component"] = part(at, n) if n else F.lit(0.0)
        at += n
    back = (lambda c: F.expm1(c)) if model.multiplicative else (lambda c: c)
    band, total = F.lit(z) * F.col("sigma"), F.col("_total")
    return framed.withColumns(comps).withColumn("_total", sum((F.col(c) for c in comps), F.lit(0.0))).withColumns({
        "yhat": F.greatest(back(total), F.lit(0.0)), "yhat_lower": F.greatest(back(total - band), F.lit(0.0)),
        "yhat_upper": F.greatest(back(total + band), F.lit(0.0)),
    }).drop("_c", "_total", "_lo", "_hi", "coef", "sigma")


def changepoints(models: DataFrame, model: FourierModel) -> DataFrame:
    """`(keys, ds, delta)`: where the slope may change and by how much."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(CHANGEPOINT_RANGE * i / model.changepoints).alias("at"), F.col("coef")[1 + i].alias("delta"))
        for i in range(1, model.changepoints + 1)]))
    return models.select(*model.keys, "_lo", "_hi", pairs.alias("_p")).select(
        *model.keys, from_seconds(F.round(F.col("_lo") + F.col("_p.at") * (F.col("_hi") - F.col("_lo"))).cast("bigint")).alias("ds"),
        F.col("_p.delta").alias("delta"))
