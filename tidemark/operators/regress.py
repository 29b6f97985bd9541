"""Least squares for many series at once, from cross products summed on the cluster.

Each task turns its rows into per-series cross-product sums (a few hundred numbers per
series, however many rows); Spark adds them up per series, and only the small system of
each series is solved in a grouped task. Sub-models on the same rows are sub-blocks of
the same sums, so a whole model search needs one pass over the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach

INTERCEPT = "_one"
#: Numbers of cross products that a task sums up before it hands them on.
HELD_NUMBERS = 1 << 22


def _key_fields(df: DataFrame, keys: list[str]) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema] if keys else []


def python_partitions(df: DataFrame) -> int:
    """Partitions for grouped Python work: every core gets some, however few the bytes."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cross_products(df: DataFrame, features: list[str] | str, label: str, keys: list[str] = ()) -> DataFrame:
    """`(keys, i, j, value)` for i <= j over `1, features.., label`.

    `features` names columns or one array column. Rows with a missing value are left out.
    """
    keys = list(keys)
    x = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(*keys, F.concat(F.array(F.lit(1.0)), x, F.array(F.col(label).cast("double"))).alias("_z"))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, np.ndarray] = {}

        def emptied() -> pd.DataFrame:
            size = next(iter(held.values())).shape[0]
            i, j = np.triu_indices(size)
            out = pd.DataFrame({"i": np.tile(i.astype("int32"), len(held)), "j": np.tile(j.astype("int32"), len(held)), "value": np.concatenate([g[i, j] for g in held.values()])})
            for n, c in enumerate(keys):
                out[c] = pd.Series([key[n] for key in held], dtype=object).repeat(len(i)).to_numpy()
            held.clear()
            return out[[*keys, "i", "j", "value"]]

        for pdf in batches:
            for key, part in pdf.groupby(keys, sort=False, dropna=False) if keys else [((), pdf)]:
                z = np.array(part["_z"].tolist(), dtype="float64")
                z = z[np.isfinite(z).all(axis=1)] if len(z) else z
                if not len(z):
                    continue
                key = tuple(None if pd.isna(v) else v for v in (key if isinstance(key, tuple) else (key,)))
                if key in held:
                    held[key] += z.T @ z
                else:
                    held[key] = z.T @ z
                if len(held) * z.shape[1] ** 2 > HELD_NUMBERS:
                    yield emptied()
        if held:
            yield emptied()

    schema = ", ".join([*_key_fields(df, keys), "i int", "j int", "value double"])
    return rows.mapInPandas(sums, schema).groupBy(*keys, "i", "j").agg(F.sum("value").alias("value"))


def matrix_of(pdf: pd.DataFrame) -> np.ndarray:
    """The symmetric matrix of one series' cross products."""
    size = int(pdf["j"].max()) + 1
    g = np.zeros((size, size))
    g[pdf["i"], pdf["j"]] = pdf["value"]
    g[pdf["j"], pdf["i"]] = pdf["value"]
    return g


def least_squares(g: np.ndarray, use: list[int], penalty: np.ndarray | None = None):
    """Coefficients, residual sum of squares and standard errors of the label on columns `use`."""
    a, b, yy, n = g[np.ix_(use, use)], g[use, -1], g[-1, -1], g[0, 0]
    lhs = a if penalty is None else a + np.diag(penalty[: len(use)])
    beta = np.linalg.lstsq(lhs, b, rcond=None)[0]
    sse = max(float(yy - 2 * beta @ b + beta @ a @ beta), 0.0)
    dof = max(n - len(use), 1.0)
    se = np.sqrt(np.clip(np.diag(np.linalg.pinv(lhs)), 0, None) * sse / dof)
    return beta, sse, se


def per_series(products: DataFrame, keys: list[str], solve: Callable[[np.ndarray], list[dict]], schema: str) -> DataFrame:
    """Apply a small solver to each series' matrix; `schema` describes the dicts it returns."""
    keys = list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(solve(matrix_of(pdf)))
        for n, c in enumerate(keys):
            out.insert(n, c, [pdf[c].iloc[0]] * len(out))
        return out

    return products.groupBy(*keys).applyInPandas(run, ", ".join([*_key_fields(products, keys), schema]))


FIT_SCHEMA = "n_obs double, parameters int, sse double, sigma double, coef array<double>, stderr array<double>, aic double, bic double"


def fit(df: DataFrame, features: list[str] | str, label: str, keys: list[str] = (), penalty: list[float] | None = None) -> DataFrame:
    """One row per series: coefficients (intercept first), standard errors, SSE, sigma, AIC, BIC."""
    pen = None if penalty is None else np.array([0.0, *penalty])

    def solve(g: np.ndarray) -> list[dict]:
        k = g.shape[0] - 1
        beta, sse, se = least_squares(g, list(range(k)), pen)
        n = g[0, 0]
        fit_term = n * np.log(max(sse, 1e-300) / n)
        return [{"n_obs": n, "parameters": k, "sse": sse, "sigma": float(np.sqrt(sse / max(n - k, 1.0))), "coef": beta.tolist(),
                 "stderr": se.tolist(), "aic": fit_term + 2 * k, "bic": fit_term + k * np.log(n)}]

    return with_every_key(per_series(cross_products(df, features, label, keys), keys, solve, FIT_SCHEMA), df, keys)


def sparse_least_squares(g: np.ndarray, laplace: np.ndarray, normal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coefficients with soft thresholds, and the thresholds and ridge weights that applied.

    Minimises half the squared error plus l1 |b| plus half of l2 b^2. `laplace` and `normal` are the prior scales of each
    coefficient in units of the label's root mean square, infinite where there is no prior; the error variance is that of
    plain least squares. Coordinate descent on the cross products finds support and signs; once they settle, the linear
    system of the support gives the coefficients exactly.
    """
    k = g.shape[0] - 1
    a, b, n = g[:k, :k], g[:k, -1], g[0, 0]
    beta, sse, _ = least_squares(g, list(range(k)))
    scale = math.sqrt(g[-1, -1] / n) or 1.0
    variance = sse / max(n - k, 1.0)
    l1, l2 = variance / (laplace * scale), variance / (normal * scale) ** 2
    soft, steep = l1 > 0, np.diag(a) + l2
    beta = np.where(soft | (steep <= 0), 0.0, beta)
    slack = 1e-9 * (np.abs(b) + l1 + 1e-12)
    for sweep in range(20_000):
        for j in np.flatnonzero(steep > 0):
            pull = b[j] - a[j] @ beta + a[j, j] * beta[j]
            beta[j] = np.sign(pull) * max(abs(pull) - l1[j], 0.0) / steep[j]
        if sweep % 10 == 9:
            on = np.flatnonzero((steep > 0) & (~soft | (beta != 0)))
            sign = np.where(soft[on], np.sign(beta[on]), 0.0)
            exact = np.linalg.lstsq(a[np.ix_(on, on)] + np.diag(l2[on]), b[on] - l1[on] * sign, rcond=None)[0]
            rest = b - a[:, on] @ exact
            rest[on] = 0
            if (np.sign(exact[soft[on]]) == sign[soft[on]]).all() and (np.abs(rest) <= l1 + slack).all():
                beta = np.zeros(k)
                beta[on] = exact
                break
    return beta, l1, l2


SPARSE_SCHEMA = "n_obs double, parameters int, sse double, sigma double, coef array<double>, l1 array<double>, l2 array<double>, aic double, bic double"


def fit_sparse(df: DataFrame, features: list[str] | str, label: str, laplace: list[float], normal: list[float], keys: list[str] = ()) -> DataFrame:
    """One row per series as `fit`, with coefficients of `sparse_least_squares` (intercept first) and their weights; `parameters` counts those that are not 0."""
    lap, nor = np.array([np.inf, *laplace]), np.array([np.inf, *normal])

    def solve(g: np.ndarray) -> list[dict]:
        beta, l1, l2 = sparse_least_squares(g, lap, nor)
        k, n = int((beta != 0).sum()), g[0, 0]
        sse = max(float(g[-1, -1] - 2 * beta @ g[:-1, -1] + beta @ g[:-1, :-1] @ beta), 0.0)
        fit_term = n * np.log(max(sse, 1e-300) / n)
        return [{"n_obs": n, "parameters": k, "sse": sse, "sigma": float(np.sqrt(sse / max(n - k, 1.0))), "coef": beta.tolist(),
                 "l1": l1.tolist(), "l2": l2.tolist(), "aic": fit_term + 2 * k, "bic": fit_term + k * np.log(n)}]

    return with_every_key(per_series(cross_products(df, features, label, keys), keys, solve, SPARSE_SCHEMA), df, keys)


def with_every_key(result: DataFrame, series: DataFrame, keys: list[str]) -> DataFrame:
    """The results with a row of NULLs for each series that had no complete row to solve from."""
    return attach(series.select(*keys).distinct(), result, list(keys)) if keys else result


def linear_value(features: list[str], coef: str = "coef") -> Column:
    """Intercept plus the sum of coefficient times feature."""
    out = F.col(coef)[0]
    for i, f in enumerate(features):
        out = out + F.col(coef)[i + 1] * F.col(f)
    return out
