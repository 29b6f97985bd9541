"""Fitted tree ensembles as plain node arrays: walks in tasks, staged errors, truncation, recursive forecasts.

An ensemble's nodes are a few thousand rows whatever the data; they travel to the tasks with the function that walks them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timebins import from_seconds, seconds_of, width_seconds
from tidemark.operators import regress
from tidemark.session import scratch_dir


@dataclass
class NodeArrays:
    """All trees' nodes one after the other; leaves have no feature (-1), only splits on categories have a subset (else -1).

    A row of `subsets` says which categories go left; its last entry stands for values that are none of the feature's categories.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    subset: np.ndarray
    subsets: np.ndarray

    @classmethod
    def of(cls, model: GBTRegressionModel, spark: SparkSession) -> NodeArrays:
        """Read from the model's own saved node table."""
        path = scratch_dir(spark, "trees")
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas().sort_values(["treeID", "id"], ignore_index=True)
        first = nodes.groupby("treeID").size().cumsum().shift(fill_value=0).to_numpy()
        base = first[nodes["treeID"].to_numpy()]
        split = nodes["split"].tolist()
        inner = nodes["leftChild"].to_numpy() >= 0
        grouped = np.array([bool(i) and s["numCategories"] != -1 for s, i in zip(split, inner)], bool)
        sets = [split[k] for k in np.flatnonzero(grouped)]
        subsets = np.zeros((len(sets), 1 + max([s["numCategories"] for s in sets], default=0)), bool)
        for row, s in zip(subsets, sets):
            # Spark tests for the smaller side, so that what is no category takes the larger one.
            left = np.array(s["leftCategoriesOrThreshold"], np.int64)
            row[s["numCategories"] :] = len(left) > s["numCategories"] // 2
            row[left] = True
        return cls(
            np.array([s["featureIndex"] if i else -1 for s, i in zip(split, inner)], np.int64),
            np.array([s["leftCategoriesOrThreshold"][0] if i and not g else 0.0 for s, i, g in zip(split, inner, grouped)]),
            np.where(inner, nodes["leftChild"] + base, -1), np.where(inner, nodes["rightChild"] + base, -1), nodes["prediction"].to_numpy(), first, np.array(model.treeWeights),
            np.where(grouped, np.cumsum(grouped) - 1, -1), subsets)

    def _left(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether values of the features of inner nodes go left."""
        down, by_set = x <= self.threshold[at], self.subset[at] >= 0
        if by_set.any():
            v, other = x[by_set], self.subsets.shape[1] - 1
            known = (v >= 0) & (v < other) & (v == np.floor(v))
            down[by_set] = self.subsets[self.subset[at[by_set]], np.where(known, v, other).astype(np.int64)]
        return down

    def staged(self, x: np.ndarray) -> np.ndarray:
        """A row per tree with the ensemble's value after it; a missing feature takes the right branch."""
        out, rows = np.zeros((len(self.roots), len(x))), np.arange(len(x))
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                here = at[inner]
                down = self._left(here, x[rows[inner], self.feature[here]])
                at[inner] = np.where(down, self.left[here], self.right[here])
            out[t] = self.weights[t] * self.value[at]
        return np.cumsum(out, axis=0)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.staged(x)[-1] if len(self.roots) else np.zeros(len(x))


def walk(nodes: NodeArrays, df: DataFrame, features: list[str], name: str = "walked") -> DataFrame:
    """Add the ensemble's value, from the node arrays."""
    names, fields = df.columns, [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf["_x"].tolist()
            yield pdf[names].assign(**{name: nodes.predict(np.array(x, np.float64).reshape(len(pdf), len(features)))})

    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    return df.withColumn("_x", x).mapInPandas(run, ", ".join([*fields, f"`{name}` double"]))


def staged_errors(nodes: NodeArrays, df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """`(round, mse)`: the ensemble's mean squared error on complete rows after each of its rounds; each task hands on one sum per round."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(nodes.roots)), 0
        for pdf in batches:
            if len(pdf):
                total += ((nodes.staged(np.array(pdf["_x"].tolist(), np.float64)) - pdf["_y"].to_numpy()) ** 2).sum(axis=1)
                n += len(pdf)
        if n:
            yield pd.DataFrame({"round": np.arange(1, len(total) + 1, dtype="int32"), "_s": total, "_n": n})

    rows = df.na.drop(subset=[*features, label]).select(F.array(*[F.col(f).cast("double") for f in features]).alias("_x"), F.col(label).cast("double").alias("_y"))
    return rows.mapInPandas(run, "round int, _s double, _n bigint").groupBy("round").agg((F.sum("_s") / F.sum("_n")).alias("mse"))


def best_round(errors: list[float], patience: int) -> int:
    """The round of least error met before `patience` rounds in a row failed to better it."""
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def truncated(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The same ensemble with its first rounds only."""
    spark = SparkSession.getActiveSession()
    jvm, java = spark._jvm, model._java_obj
    trees = spark.sparkContext._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = spark.sparkContext._gateway.new_array(jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = java.trees()[k], float(java.treeWeights()[k])
    short = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights))
    short._resetUid(model.uid)
    return short.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def inputs(model: PipelineModel) -> list[str]:
    return model.stages[-2].getInputCols()


class Ring:
    """Recent values of many series at once, and the features of their last rows."""

    def __init__(self, target: str, names: list[str], tail: np.ndarray, smoothed: dict[int, np.ndarray]):
        self.target, self.names, self.tail, self.smoothed = target, names, tail, smoothed

    def push(self, value: np.ndarray) -> None:
        self.tail = np.concatenate([self.tail[:, 1:], value[:, None]], axis=1)
        for span, y in self.smoothed.items():
            a = 2 / (span + 1)
            self.smoothed[span] = (1 - a) * y + a * value

    def features(self, calendar: dict[str, np.ndarray]) -> np.ndarray:
        """The features of the last row, in the order of `names`; NaN where a value is missing or a ratio has no base."""
        now, columns = self.tail[:, -1], []
        for name in self.names:
            if name in calendar:
                columns.append(calendar[name])
                continue
            if not name.startswith(f"{self.target}_"):
                raise ValueError(f"{name} cannot be carried forward")
            kind, _, n = name.removeprefix(f"{self.target}_").rpartition("_")
            n = int(n)
            if kind == "lag":
                columns.append(self.tail[:, -1 - n])
            elif kind == "ewm":
                columns.append(self.smoothed[n])
            elif kind == "diff":
                columns.append(now - self.tail[:, -1 - n])
            elif kind == "pct_change":
                old = self.tail[:, -1 - n]
                columns.append(np.divide(now - old, old, out=np.full(len(now), np.nan), where=old != 0))
            else:
                columns.append(self._rolling(kind, self.tail[:, -n:]))
        return np.stack(columns, axis=1)

    @staticmethod
    def _rolling(kind: str, part: np.ndarray) -> np.ndarray:
        n = np.isfinite(part).sum(axis=1)
        mean = np.divide(np.nansum(part, axis=1), n, out=np.full(len(part), np.nan), where=n > 0)
        if kind == "rolling_mean":
            return mean
        if kind == "rolling_std":
            square = np.nansum((part - mean[:, None]) ** 2, axis=1)
            return np.sqrt(np.divide(square, n - 1, out=np.zeros(len(part)), where=n > 1))
        fill = -np.inf if kind == "rolling_max" else np.inf
        best = getattr(np, "max" if kind == "rolling_max" else "min")(np.where(np.isfinite(part), part, fill), axis=1)
        return np.where(n > 0, best, np.nan)


def calendar_values(seconds: np.ndarray) -> dict[str, np.ndarray]:
    """The calendar features of wall-clock seconds, as numbers."""
    at = pd.DatetimeIndex(pd.to_datetime(seconds, unit="s"))
    hour, dow = at.hour.to_numpy(), at.dayofweek.to_numpy()
    out = {
        "hour": hour, "day_of_week": dow, "day_of_month": at.day.to_numpy(), "week_of_year": at.isocalendar().week.to_numpy(), "month": at.month.to_numpy(),
        "is_weekend": dow >= 5, "is_business_hour": (hour >= 9) & (hour <= 17) & (dow < 5), "hour_sin": np.sin(2 * np.pi * hour / 24), "hour_cos": np.cos(2 * np.pi * hour / 24),
        "dow_sin": np.sin(2 * np.pi * dow / 7), "dow_cos": np.cos(2 * np.pi * dow / 7)}
    return {k: v.astype(np.float64) for k, v in out.items()}


def forecast_recursive(model: PipelineModel, feats: DataFrame, target: str, steps: int, width="15min", keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """`(keys, step, ts, prediction)` of the `steps` bins after each series' last feature row, each from the ones before.

    A series is one row with its last values and smoothed means; all its steps run inside the task that holds the row,
    and series of a batch step together. Values before a series' first are missing, and so are the features that need
    them. Predictions are never below 0.
    """
    keys, names, w = list(keys), inputs(model), width_seconds(width)
    if any(not (n.startswith(f"{target}_") or n in calendar_values(np.zeros(1))) for n in names):
        raise ValueError("every feature must follow from the target's own past and the calendar")
    spark = feats.sparkSession
    nodes = NodeArrays.of(model.stages[-1], spark)
    reach = max([int(n.rpartition("_")[2]) for n in names if n.startswith(f"{target}_") and "_ewm_" not in n], default=0) + 1
    spans = sorted({int(n.rpartition("_")[2]) for n in names if n.startswith(f"{target}_ewm_")})
    row = F.struct(F.col(ts).alias("t"), F.col(target).cast("double").alias("v"), F.array(*[F.col(f"{target}_ewm_{s}") for s in spans]).cast("array<double>").alias("e"))
    # Rows are gathered by pieces of bounded span, of which only the last ones of a series are kept.
    piece = F.floor(seconds_of(ts) / F.lit(w * reach)).alias("_piece")
    pieces = feats.groupBy(*keys, piece).agg(F.sort_array(F.collect_list(row)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    tails = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_piece", "_n", F.element_at("_r", -1)["t"].alias("t")))).alias("_p"))
    enough = F.aggregate(F.reverse("_p"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("at")),
                         lambda a, p: F.when(a["n"] < reach, F.struct((a["n"] + p["_n"]).alias("n"), p["_piece"].alias("at"))).otherwise(a))
    joined = regress.attach(pieces, tails.select(*keys, enough["at"].alias("_from")), keys).where(F.col("_piece") >= F.col("_from"))
    last = joined.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list("_r"))).alias("_r")).select(*keys, F.slice("_r", F.greatest(F.lit(1), F.size("_r") - reach + 1), reach).alias("_r"))
    series = last.select(*keys, F.transform("_r", lambda r: r["v"]).alias("_tail"), F.element_at("_r", -1)["e"].alias("_e"), seconds_of(F.element_at("_r", -1)["t"]).alias("_at"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            tail = np.full((len(pdf), reach), np.nan)
            for k, values in enumerate(pdf["_tail"]):
                tail[k, reach - len(values) :] = np.array(values, np.float64)
            e = np.array([np.array(x, np.float64) for x in pdf["_e"]]).reshape(len(pdf), len(spans))
            ring, at, path = Ring(target, names, tail, {s: e[:, k] for k, s in enumerate(spans)}), pdf["_at"].to_numpy(), []
            for step in range(steps):
                path.append(np.clip(nodes.predict(ring.features(calendar_values(at + step * w))), 0, None))
                ring.push(path[-1])
            yield pdf[[*keys, "_at"]].assign(_f=np.stack(path, axis=1).tolist())

    done = series.mapInPandas(run, ", ".join([*regress._key_fields(feats, keys), "_at bigint, _f array<double>"]))
    return done.select(*keys, "_at", F.posexplode("_f").alias("_s", "prediction")).select(
        *keys, (F.col("_s") + 1).alias("step"), from_seconds(F.col("_at") + (F.col("_s") + 1) * w).alias("ts"), "prediction")
