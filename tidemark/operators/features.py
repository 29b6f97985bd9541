"""Model features of keyed series: calendar, lag, rolling, difference, smoothed values, labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import calendar_columns, safe_ratio
from tidemark.functions.stats import attach
from tidemark.functions.timebins import from_seconds, seconds_of, width_seconds
from tidemark.operators.blocks import BLOCK_ROWS, block_window, overlapping, own_rows, positioned
from tidemark.schemas import (
    FEATURE_CONFIGS, FEATURE_DEFAULTS, LABEL_COLUMNS, OUTAGE_COLUMN, TARGET_COLUMNS, require_columns, require_timestamp,
)


#: Windows of more rows are put together from runs instead of being read anew for every row.
WIDE_ROWS = 24


def add_calendar(series: DataFrame, ts: str = "ts") -> DataFrame:
    return series.withColumns(calendar_columns(ts))


def lag_columns(target: str, lags: list[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{target}_lag_{k}": F.lag(target, k).over(w) for k in lags}


def rolling_columns(target: str, windows: list[int], w: WindowSpec) -> dict[str, Column]:
    """Statistics of the trailing rows, the current one included; the spread of one row is 0."""
    out = {}
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        out[f"{target}_rolling_mean_{n}"] = F.avg(target).over(frame)
        out[f"{target}_rolling_std_{n}"] = F.coalesce(F.stddev_samp(target).over(frame), F.lit(0.0))
        out[f"{target}_rolling_max_{n}"] = F.max(target).over(frame)
        out[f"{target}_rolling_min_{n}"] = F.min(target).over(frame)
    return out


def _add_wide(df: DataFrame, target: str, n: int, keys: list[str]) -> DataFrame:
    """The statistics of `rolling_columns` for one wide window, on rows already cut into blocks, at a cost free of its width.

    Rows fall into runs of n. A window is the end of one run and the beginning of the next, so sums, extremes and central
    moments from both ends of every run, each growing row by row, are put together; nothing is subtracted.
    """
    run = F.floor(F.col("_pos") / F.lit(n))
    up = Window.partitionBy(*keys, "_blk", run).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys, "_blk", run).orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0)
    x = F.col(target)
    parts = {"n": F.count(x), "s": F.sum(x), "m": F.var_pop(x), "hi": F.max(x), "lo": F.min(x)}
    df = df.withColumns({f"_u{k}": c.over(up) for k, c in parts.items()}).withColumns({f"_d{k}": c.over(down) for k, c in parts.items()})
    # The end of the run before counts unless the window is a whole run or begins with the series.
    reaches = (F.col("_pos") >= n) & (F.pmod(F.col("_pos"), F.lit(n)) != n - 1)
    before = block_window(keys)
    df = df.withColumns({f"_d{k}": F.when(reaches, F.lag(f"_d{k}", n - 1).over(before)) for k in parts})
    a, b = F.col("_un"), F.coalesce("_dn", F.lit(0))
    total, both = F.coalesce("_us", F.lit(0)) + F.coalesce("_ds", F.lit(0)), a + b
    gap = F.try_divide("_us", a) - F.try_divide("_ds", b)
    moment = F.coalesce(F.col("_um") * a, F.lit(0.0)) + F.coalesce(F.col("_dm") * b, F.lit(0.0)) + F.coalesce(F.try_divide(gap * gap * a * b, both), F.lit(0.0))
    hi, lo = F.greatest("_uhi", "_dhi"), F.least("_ulo", "_dlo")
    return df.withColumns({
        f"{target}_rolling_mean_{n}": F.try_divide(total, both), f"{target}_rolling_std_{n}": F.when((both < 2) | (hi == lo), 0.0).otherwise(F.sqrt(F.try_divide(moment, both - 1))),
        f"{target}_rolling_max_{n}": hi, f"{target}_rolling_min_{n}": lo,
    }).drop(*[f"_{side}{k}" for side in "ud" for k in parts])


def _add_rolling(df: DataFrame, target: str, windows: list[int], keys: list[str]) -> DataFrame:
    df = df.withColumns(rolling_columns(target, [n for n in windows if n <= WIDE_ROWS], block_window(keys)))
    for n in windows:
        if n > WIDE_ROWS:
            df = _add_wide(df, target, n, keys)
    return df


def diff_columns(target: str, periods: list[int], w: WindowSpec) -> dict[str, Column]:
    """Differences, and relative changes that are NULL where the earlier value is 0."""
    out = {}
    for p in periods:
        prev = F.lag(target, p).over(w)
        out[f"{target}_diff_{p}"] = F.col(target) - prev
        out[f"{target}_pct_change_{p}"] = safe_ratio(F.col(target) - prev, prev)
    return out


def _decay_rows(alpha: float) -> int:
    """Rows after which a smoothing weight has fallen below 1e-20."""
    return max(1, math.ceil(-46.0 / math.log1p(-alpha))) if alpha < 1 else 1


def _smooth_reach(spans: list[int]) -> int:
    return max((2 * _decay_rows(2 / (s + 1)) for s in spans), default=0)


def _add_smoothed(df: DataFrame, target: str, spans: list[int], keys: list[str]) -> DataFrame:
    """y_t = (1-a) y_{t-1} + a x_t with y_0 = x_0, on rows already cut into blocks.

    Runs of L rows are smoothed by one running sum with growing weights; the value at the
    end of the run before, faded by the rows since, is the rest. L is chosen so that what
    lies further back weighs less than 1e-20, below double precision.
    """
    block = block_window(keys)
    for s in spans:
        a = 2 / (s + 1)
        rows = _decay_rows(a)
        keep = F.lit(1 - a)
        at = F.pmod(F.col("_pos"), F.lit(rows))
        run = Window.partitionBy(*keys, "_blk", "_run").orderBy("_pos")
        first = F.lag("_pos").over(block).isNull()
        x = F.col(target).cast("double")
        df = df.withColumn("_run", F.floor(F.col("_pos") / F.lit(rows))) \
            .withColumn("_u", F.when(first, x).otherwise(F.lit(a) * x)) \
            .withColumn("_loc", F.pow(keep, at) * F.sum(F.col("_u") / F.pow(keep, at)).over(run)) \
            .withColumn("_exit", F.last(F.when(at == rows - 1, F.col("_loc")), ignorenulls=True).over(
                block.rowsBetween(Window.unboundedPreceding, -1))) \
            .withColumn(f"{target}_ewm_{s}", F.col("_loc") + F.coalesce(F.pow(keep, at + 1) * F.col("_exit"), F.lit(0.0))) \
            .drop("_run", "_u", "_loc", "_exit")
    return df


def feature_config(granularity=None, lags=None, windows=None, diff_periods=None, ewm_spans=None) -> dict:
    """The lists given (an empty one means none of the kind), else those of the granularity."""
    given = {"lags": lags, "windows": windows, "diff_periods": diff_periods, "ewm_spans": ewm_spans}
    base = {**FEATURE_DEFAULTS, **FEATURE_CONFIGS.get(granularity, {})}
    return {k: base[k] if given[k] is None else list(given[k]) for k in given}


def _blocked(series, keys, ts, width, removed, back, block_rows):
    require_timestamp(series, ts)
    return overlapping(positioned(series, keys, ts), back, block_rows=block_rows)


def _apply(series, keys, ts, width, removed, block_rows, back, build, spans=(), target=None):
    keys = list(keys)
    df = _blocked(series, keys, ts, width, removed, back, block_rows)
    df = df.withColumns(build(block_window(keys)))
    if spans:
        df = _add_smoothed(df, target, list(spans), keys)
    return own_rows(df)


def add_lags(series, target, lags, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS, time_based=False) -> DataFrame:
    """Earlier values: by row, or with `time_based` those that lie `lag` times `width` back in time (NULL where there is no such row)."""
    if time_based:
        return _time_lags(series, target, lags, list(keys), ts, width)
    return _apply(series, keys, ts, width, removed, block_rows, max(lags), lambda w: lag_columns(target, lags, w))


def _time_lags(series, target, lags, keys, ts, width) -> DataFrame:
    """Each row hands its value to the times it is a lag of; one join brings all lags back. Times must be unique in a series."""
    if width is None:
        raise ValueError("time-based lags need the width of one step")
    step = width_seconds(width)
    given = series.select(*keys, F.col(ts).alias("_from"), F.col(target).alias("_v"), F.explode(F.array(*[F.lit(k) for k in lags])).alias("_k"))
    later = given.withColumn("_to", from_seconds(seconds_of("_from") + F.col("_k") * step))
    lagged = later.groupBy(*keys, "_to").agg(*[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(f"{target}_lag_{k}") for k in lags])
    return attach(series, lagged.withColumnRenamed("_to", ts), [*keys, ts])


def add_rolling(series, target, windows, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    df = _blocked(series, list(keys), ts, width, removed, max(windows), block_rows)
    return own_rows(_add_rolling(df, target, list(windows), list(keys)))


def add_diffs(series, target, periods, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    return _apply(series, keys, ts, width, removed, block_rows, max(periods), lambda w: diff_columns(target, periods, w))


def add_ewm(series, target, spans, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """Exponentially weighted means without bias adjustment."""
    return _apply(series, keys, ts, width, removed, block_rows, _smooth_reach(spans), lambda w: {}, spans, target)


def all_features(
    series: DataFrame, target: str = "request_count", granularity: str | None = None, keys: list[str] = (),
    ts: str = "ts", width=None, removed=(), block_rows: int = BLOCK_ROWS, more_targets: list[str] = (), **config,
) -> DataFrame:
    """The whole feature set from one exchange.

    `more_targets` get lag and rolling features only. Row-based: where outage rows were
    dropped, the row before the hole is the predecessor of the row after it.
    """
    require_columns(series, target, *more_targets)
    keys = list(keys)
    cfg = feature_config(granularity, **config)
    back = max([0, *cfg["lags"], *cfg["windows"], *cfg["diff_periods"], _smooth_reach(cfg["ewm_spans"])])
    df = _blocked(series, keys, ts, width, removed, back, block_rows)
    w = block_window(keys)
    for name in (target, *more_targets):
        df = _add_rolling(df.withColumns(lag_columns(name, cfg["lags"], w)), name, cfg["windows"], keys)
    df = _add_smoothed(df.withColumns(diff_columns(target, cfg["diff_periods"], w)), target, cfg["ewm_spans"], keys)
    return add_calendar(own_rows(df), ts)


def features_for_targets(series, targets=("request_count", "bytes_total"), granularity="15min", keys=(), **options) -> DataFrame:
    """Full features of the first target, lag and rolling features of the others."""
    return all_features(series, targets[0], granularity, keys, more_targets=list(targets[1:]), **options)


def feature_columns(df: DataFrame, exclude_targets: bool = True, exclude_outage: bool = True, keys=(), ts="ts") -> list[str]:
    """Feature names: every column that is no target, outage flag, label, key or timestamp."""
    drop = {*LABEL_COLUMNS, *keys, ts, "label"}
    if exclude_targets:
        drop |= set(TARGET_COLUMNS)
    if exclude_outage:
        drop.add(OUTAGE_COLUMN)
    return [c for c in df.columns if c not in drop]


def supervised(
    df: DataFrame, target: str, features: list[str], horizon: int = 1, dropna: bool = True, keys: list[str] = (),
    ts: str = "ts", width=None, removed=(), block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Keys, timestamp, features and `label` = the target `horizon` rows ahead."""
    keys = list(keys)
    placed = overlapping(positioned(df, keys, ts), 0, horizon, block_rows)
    out = own_rows(placed.withColumn("label", F.lead(target, horizon).over(block_window(keys)).cast("double")))
    out = out.select(*keys, ts, *features, "label")
    return out.na.drop(subset=[*features, "label"]) if dropna else out


def rolling_full(series, target, window, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """Trailing mean and spread, NULL until the window is full."""
    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        full = F.count(target).over(frame) == window
        return {f"{target}_mean_{window}": F.when(full, F.avg(target).over(frame)),
                f"{target}_std_{window}": F.when(full, F.stddev_samp(target).over(frame))}
    return _apply(series, keys, ts, width, removed, block_rows, window, build)


def centered_mean(series, target, window=7, keys=(), ts="ts", width=None, block_rows=BLOCK_ROWS) -> DataFrame:
    """Centred moving mean over an odd number of rows, NULL at both ends."""
    keys, half = list(keys), window // 2
    df = overlapping(positioned(series, keys, ts), half, half, block_rows)
    frame = block_window(keys).rowsBetween(-half, half)
    full = F.count(target).over(frame) == window
    return own_rows(df.withColumn(f"{target}_centered_{window}", F.when(full, F.avg(target).over(frame))))


def naive_forecast(series, target="request_count", window=4, keys=(), ts="ts", width=None, removed=(), block_rows=BLOCK_ROWS, lags=()) -> DataFrame:
    """`prediction` = mean of the `window` rows before; the first rows take the first such mean. Earlier values at `lags` come along in the same blocks."""
    keys = list(keys)
    df = overlapping(positioned(series, keys, ts), max([window, *lags]), window, block_rows)
    w = block_window(keys)
    df = df.withColumns(lag_columns(target, list(lags), w))
    frame = w.rowsBetween(-window, -1)
    df = df.withColumn("prediction", F.when(F.count(target).over(frame) == window, F.avg(target).over(frame)))
    nxt = F.first("prediction", ignorenulls=True).over(w.rowsBetween(0, window))
    # Only a series' first rows lack a mean, so the fill never reaches past `window` rows.
    return own_rows(df.withColumn("prediction", F.coalesce("prediction", nxt)))


def align_ffill(left: DataFrame, right: DataFrame, value: str, keys=(), ts="ts") -> DataFrame:
    """Bring `right.value` onto `left`'s timestamps and carry the last seen value forward.

    The carried value may lie arbitrarily far back: rows are filled inside 30-day chunks,
    and the last value of each chunk is carried on through the few chunk rows.
    """
    keys = list(keys)
    joined = left.join(right.select(*keys, ts, value), [*keys, ts], "left") \
        .withColumn("_chunk", F.floor(seconds_of(ts) / F.lit(30 * 86400)))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = joined.groupBy(*keys, "_chunk").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ts))).alias("_last")) \
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    return attach(joined, carried, [*keys, "_chunk"]) \
        .withColumn(value, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carry"))) \
        .drop("_chunk", "_carry")


def look_ahead(series, target, horizon, keys=(), ts="ts", name=None, width=None, removed=(), block_rows=BLOCK_ROWS) -> DataFrame:
    """The value `horizon` rows on, clamped to the series' last row."""
    keys, name = list(keys), name or f"{target}_ahead"
    ends = series.groupBy(*keys).agg(F.max_by(target, ts).alias("_end"))
    df = overlapping(positioned(series, keys, ts), 0, horizon, block_rows)
    df = own_rows(df.withColumn(name, F.lead(target, horizon).over(block_window(keys)))
                  .withColumn("_has", F.lead("_pos", horizon).over(block_window(keys)).isNotNull()))
    return attach(df, ends, keys).withColumn(name, F.when(F.col("_has"), F.col(name)).otherwise(F.col("_end"))) \
        .drop("_has", "_end")
