"""Statistics Spark lacks or needs help with at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add one row of statistics per key to every row of `df`.

    With keys this is an equi-join that also matches NULL keys; Spark broadcasts the
    statistics only when their measured size allows it. Without keys the statistics
    are one row and come in as a scalar subquery.
    """
    extra = [c for c in stats.columns if c not in keys]
    if not keys:
        one = stats.select(F.struct(*extra).alias("_s")).scalar()
        return df.withColumn("_s", one).select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in extra])
    right = stats.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *extra)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: list[str] = (), pieces: int = 256, weight: str | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles, with no group gathered in one task.

    `percentile` keeps every distinct value of a group in one buffer, which raw logs can
    outgrow. Here equal values are counted first, the distinct values are cut into `pieces`
    ranges by an approximate sketch (the cut points only balance the work), ranks are
    prefix sums per range plus a prefix sum over the ranges, and the values at the two
    neighbouring ranks of each probability are picked out. One output row per key. A row
    counts as often as its `weight` says, once without.
    """
    keys = list(keys)
    counts = (
        df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    )
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("_v", [i / pieces for i in range(1, pieces)], 4 * pieces).alias("_cuts"))
    placed = attach(counts, cuts, keys).withColumn(
        "_piece", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    totals = placed.groupBy(*keys, "_piece").agg(F.sum("_n").alias("_pn"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_pn").over(before), F.lit(0))) \
        .withColumn("_total", F.sum("_pn").over(Window.partitionBy(*keys)))
    ranked = attach(placed, totals.drop("_pn"), keys + ["_piece"])
    run = Window.partitionBy(*keys, "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_hi", F.col("_before") + F.sum("_n").over(run)) \
        .withColumn("_lo", F.col("_hi") - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_v")))

    picks = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        picks += [
            at(F.floor(pos)).alias(f"_f_{name}"), at(F.ceil(pos)).alias(f"_c_{name}"),
            F.max(pos - F.floor(pos)).alias(f"_w_{name}"),
        ]
    out = ranked.groupBy(*keys).agg(*picks)
    return out.select(*keys, *[
        (F.col(f"_f_{n}") + (F.col(f"_c_{n}") - F.col(f"_f_{n}")) * F.col(f"_w_{n}")).alias(n) for n in probs
    ])


def sample_skewness(x: Column | str) -> Column:
    """Bias-corrected skewness, NULL below three values."""
    n, g = F.count(x), F.skewness(x)
    return F.when(n >= 3, g * F.try_divide(F.sqrt(n * (n - 1)), (n - 2).cast("double")))


def sample_kurtosis(x: Column | str) -> Column:
    """Bias-corrected excess kurtosis, NULL below four values."""
    n, g = F.count(x).cast("double"), F.kurtosis(x)
    return F.when(n >= 4, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g + 6))
