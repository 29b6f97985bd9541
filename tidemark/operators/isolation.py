"""Isolation forest over keyed series: samples by hash, one tree per group, blockwise scoring."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import attach, exact_quantiles
from tidemark.functions.timebins import seconds_of
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, own_rows, positioned
from tidemark.session import settled
from tidemark.operators.regress import _key_fields, python_partitions

# Trees, expected share of outliers, rows per tree, seed.
TREES, CONTAMINATION, SAMPLE_ROWS, SEED = 100, 0.05, 256, 42

_TREE = "feature array<int>, threshold array<double>, left array<int>, right array<int>, depth array<double>, rows int"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


def traffic_features(series, value, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """Keys, `ts` and `_x` = value, lag 1, difference and full 4-row mean; NULL `_x` at a series' start."""
    keys = list(keys)
    df = overlapping(positioned(series, keys, ts), 4, block_rows=block_rows)
    w = block_window(keys)
    x, prev, frame = F.col(value).cast("double"), F.lag(F.col(value).cast("double")).over(w), w.rowsBetween(-3, 0)
    mean = F.when(F.count(value).over(frame) == 4, F.avg(value).over(frame))
    df = df.withColumns({"_lag": prev, "_mean4": mean})
    parts = F.array(x, F.col("_lag"), x - F.col("_lag"), F.col("_mean4"))
    return own_rows(df.withColumn("_x", F.when(F.col("_mean4").isNotNull(), parts)).drop("_lag", "_mean4"))


def fit_forest(rows: DataFrame, keys: list[str] = (), ts: str = "ts", trees: int = TREES, seed: int = SEED) -> DataFrame:
    """`(keys, tree, node arrays)`: each tree is grown on the 256 rows with the smallest hashes.

    A row is offered only to the trees where its hash falls below a threshold set from the
    row count, so the rows are not multiplied by the number of trees.
    """
    keys = list(keys)
    known = rows.where(F.col("_x").isNotNull()).select(*keys, F.col(ts).alias("_ts"), "_x")
    counts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    draw = lambda t: F.pmod(F.xxhash64(F.lit(seed), t, *keys, F.col("_ts").cast("string")), F.lit(2 ** 40)) / float(2 ** 40)
    # Twice the sample plus a margin: fewer than 256 rows below it are practically excluded.
    below = (2.0 * SAMPLE_ROWS + 64) / F.col("_n")
    hits = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < below)
    offered = attach(known, counts, keys).select(*keys, "_ts", "_x", F.explode(hits).alias("tree")) \
        .withColumn("_draw", draw(F.col("tree")))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pick = pdf.sort_values(["_draw", "_ts"]).head(SAMPLE_ROWS)
        x = np.array(pick["_x"].tolist())
        rng = np.random.default_rng([seed, int(pdf["tree"].iloc[0])])
        limit = math.ceil(math.log2(max(len(x), 2)))
        feature, threshold, left, right, depth = [], [], [], [], []

        def node(idx: np.ndarray, level: int) -> int:
            me = len(feature)
            for a, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (depth, level + average_path(len(idx)))):
                a.append(v)
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            usable = np.flatnonzero(hi > lo)
            if level < limit and len(idx) > 1 and len(usable):
                f = int(rng.choice(usable))
                cut = float(rng.uniform(lo[f], hi[f]))
                goes = x[idx, f] <= cut
                feature[me], threshold[me] = f, cut
                left[me], right[me] = node(idx[goes], level + 1), node(idx[~goes], level + 1)
            return me

        node(np.arange(len(x)), 0)
        out = pd.DataFrame({"tree": [int(pdf["tree"].iloc[0])], "feature": [feature], "threshold": [threshold],
                            "left": [left], "right": [right], "depth": [depth], "rows": [len(x)]})
        for c in keys:
            out[c] = pdf[c].iloc[0]
        return out

    schema = ", ".join([*_key_fields(rows, keys), "tree int", _TREE])
    # Growing a tree is much work on few bytes: a fixed partition count keeps the optimizer
    # from merging the groups into one task.
    return offered.repartition(python_partitions(rows), *keys, "tree").groupBy(*keys, "tree").applyInPandas(grow, schema)


def score_forest(rows: DataFrame, forest: DataFrame, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Add `anomaly_score` in (0, 1], larger for rows that isolate sooner.

    Rows are cut into 30-day parts, and each part meets its series' trees in one grouped
    task; a long series therefore spreads over many.
    """
    keys = list(keys)
    placed = rows.where(F.col("_x").isNotNull()).withColumn("_part", F.floor(seconds_of(ts) / F.lit(30 * 86400)).cast("bigint"))
    # Renamed columns keep the two sides of the cogroup apart.
    other = [f"_g_{k}" for k in keys]
    parts = placed.select(*[F.col(k).alias(g) for k, g in zip(keys, other)], F.col("_part").alias("_g_part")).distinct()
    nodes = ["tree", "feature", "threshold", "left", "right", "depth", "rows"]
    if keys:
        trees = forest.select(*[F.col(k).alias(f"_f_{k}") for k in keys], *nodes)
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"_g_{k}").eqNullSafe(F.col(f"_f_{k}"))
        spread = parts.join(trees, cond).select(*other, "_g_part", *nodes)
    else:
        packed = forest.agg(F.collect_list(F.struct(*nodes)).alias("_all")).scalar()
        spread = parts.withColumn("_all", packed).select("_g_part", F.explode("_all").alias("_t")).select("_g_part", "_t.*")

    def score(left_pdf: pd.DataFrame, tree_pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(left_pdf["_x"].tolist())
        total, norm = np.zeros(len(x)), 0.0
        for t in tree_pdf.sort_values("tree").itertuples(index=False):
            f, cut = np.array(t.feature), np.array(t.threshold)
            lo, hi, depth = np.array(t.left), np.array(t.right), np.array(t.depth)
            at = np.zeros(len(x), dtype=int)
            inner = f[at] >= 0
            while inner.any():
                i = np.flatnonzero(inner)
                n = at[i]
                at[i] = np.where(x[i, f[n]] <= cut[n], lo[n], hi[n])
                inner = f[at] >= 0
            total += depth[at]
            norm += average_path(t.rows)
        return left_pdf[[*keys, ts]].assign(anomaly_score=np.exp2(-total / max(norm, 1e-12)))

    schema = ", ".join([*_key_fields(rows, [*keys, ts]), "anomaly_score double"])
    n = python_partitions(rows)
    scores = placed.repartition(n, *keys, "_part").groupBy(*keys, "_part").cogroup(
        spread.repartition(n, *other, "_g_part").groupBy(*other, "_g_part")).applyInPandas(score, schema)
    return attach(rows.drop("_x"), scores, [*keys, ts])


def detect_isolation_forest(
    series, value, contamination=CONTAMINATION, trees=TREES, keys=(), ts="ts", width=None, removed=(), seed=SEED, block_rows=BLOCK_ROWS,
) -> DataFrame:
    """Add `anomaly_score` and `is_isolation_forest`: the `contamination` share scoring worst per key.

    The first rows of a series lack features and are never flagged. Rows, trees and scores are used twice and therefore
    written once to the shared folder; nothing stays cached.
    """
    keys = list(keys)
    rows = traffic_features(series, value, keys, ts, width, removed, block_rows)
    rows = settled(rows, "forest-rows")
    scored = settled(score_forest(rows, settled(fit_forest(rows, keys, ts, trees, seed), "forest"), keys, ts), "forest-scores")
    # Scores are nearly all distinct, so one buffer per key would hold a whole series.
    cut = exact_quantiles(scored, "anomaly_score", {"_cut": 1 - contamination}, keys)
    return attach(scored, cut, keys).withColumn(
        "is_isolation_forest", F.coalesce(F.col("anomaly_score") > F.col("_cut"), F.lit(False))).drop("_cut")


def isolation_report(flagged: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Anomaly count, and its rate over the rows that have features."""
    hit, n = F.count_if("is_isolation_forest"), F.count("anomaly_score")
    return flagged.groupBy(*keys).agg(n.alias("records"), hit.alias("anomaly_count"), (hit * 100.0 / n).alias("anomaly_rate"))
