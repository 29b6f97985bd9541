"""Profiles and distributions of traffic series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import safe_ratio
from tidemark.functions.stats import attach


def hourly_profile(series: DataFrame, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Requests by hour of day: mean, spread, median, maximum; mean bytes and error rate."""
    return series.groupBy(*keys, F.hour(ts).alias("hour")).agg(
        F.avg("request_count").alias("requests_mean"), F.stddev_samp("request_count").alias("requests_std"),
        F.percentile("request_count", 0.5).alias("requests_median"), F.max("request_count").alias("requests_max"),
        F.avg("bytes_total").alias("bytes_mean"), F.avg("error_rate").alias("error_rate_mean"),
    )


def weekday_profile(series: DataFrame, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Requests by day of week, Monday first."""
    return series.groupBy(*keys, F.weekday(ts).alias("day_of_week"), F.date_format(ts, "EEEE").alias("day_name")).agg(
        F.avg("request_count").alias("requests_mean"), F.stddev_samp("request_count").alias("requests_std"),
        F.sum("request_count").alias("requests_total"), F.sum("bytes_total").alias("bytes_total"),
    ).orderBy(*keys, "day_of_week")


def heatmap(series: DataFrame, value: str = "request_count", keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Mean value as a day-of-week by hour table, one column `h0` .. `h23` per hour."""
    wide = series.withColumn("_h", F.hour(ts)) \
        .groupBy(*keys, F.weekday(ts).alias("day_of_week")).pivot("_h", list(range(24)))
    out = wide.agg(F.avg(value))
    return out.select(*keys, "day_of_week", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def daily_rollup(series: DataFrame, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Daily totals with error rate (NULL without requests) and outage-day flag."""
    daily = series.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        F.sum("request_count").alias("request_count"), F.sum("bytes_total").alias("bytes_total"),
        F.sum("error_count").alias("error_count"), F.sum("is_storm_period").alias("storm_bins"),
    )
    return daily.withColumns({
        "error_rate": safe_ratio(F.col("error_count"), F.col("request_count")),
        "is_storm_day": F.col("storm_bins") > 0,
    })


def describe(series: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """Count, mean, spread, minimum, exact quartiles and maximum; one row per column.

    Quartile buffers hold the distinct values of a *binned* series; for raw logs use
    `exact_quantiles`.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    return series.select(*keys, pairs.alias("_p")).select(*keys, "_p.*").groupBy(*keys, "column").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"),
        F.percentile("x", 0.25).alias("q25"), F.percentile("x", 0.5).alias("q50"), F.percentile("x", 0.75).alias("q75"),
        F.max("x").alias("max"),
    )


def zero_share(series: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Empty bins, their share, and error-rate statistics over the others."""
    zero = F.col("request_count") == 0
    rate = F.when(~zero, F.col("error_rate"))
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("bins"), F.count_if(zero).alias("zero_bins"),
        (F.count_if(zero) * 100.0 / F.count(F.lit(1))).alias("zero_pct"),
        F.avg(rate).alias("error_rate_mean"), F.percentile(rate, 0.5).alias("error_rate_median"),
    )


def histogram(series: DataFrame, value: str, bins: int = 50, keys: list[str] = ()) -> DataFrame:
    """Equal-width histogram between minimum and maximum; the maximum falls in the last bin."""
    keys = list(keys)
    data = series.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))
    ranges = data.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    placed = attach(data, ranges, keys)
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    # A constant series has no width; like the usual plotting tools, centre a unit range on it.
    lo = F.when(step > 0, F.col("_lo")).otherwise(F.col("_lo") - 0.5)
    width = F.when(step > 0, step).otherwise(F.lit(1.0 / bins))
    k = F.least(F.floor((F.col("_x") - lo) / width), F.lit(bins - 1)).cast("int")
    return placed.select(*keys, k.alias("bin"), lo.alias("_l"), width.alias("_w")) \
        .groupBy(*keys, "bin", (F.col("_l") + F.col("bin") * F.col("_w")).alias("bin_start"),
                 (F.col("_l") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end")) \
        .agg(F.count(F.lit(1)).alias("n"))


def box_stats(series: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Quartiles, whiskers (extreme points within 1.5 IQR of the box) and outlier counts per group."""
    data = series.select(*by, F.col(value).cast("double").alias("_x"))
    q = data.groupBy(*by).agg(F.percentile("_x", F.array(F.lit(.25), F.lit(.5), F.lit(.75))).alias("_q")) \
        .select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_x").between(F.col("q1") - reach, F.col("q3") + reach)
    return attach(data, q, list(by)).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"), F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values per column, and the number of rows missing any."""
    columns = columns or df.columns
    anyone = F.lit(False)
    for c in columns:
        anyone = anyone | F.col(c).isNull()
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns], F.count_if(anyone).alias("any_column"))
    return one.unpivot([], [*columns, "any_column"], "column", "missing")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def split_summary(series: DataFrame, keys: list[str] = (), ts: str = "ts", value: str = "request_count") -> DataFrame:
    """Row count, range, mean and spread per split."""
    return series.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("start"), F.max(ts).alias("end"),
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def profile_correlation(first: DataFrame, second: DataFrame, keys: list[str] = (), ts: str = "ts", value: str = "request_count") -> DataFrame:
    """Correlation of two sets' mean hour-of-day profiles."""
    by_hour = lambda df, name: df.groupBy(*keys, F.hour(ts).alias("hour")).agg(F.avg(value).alias(name))
    return by_hour(first, "a").join(by_hour(second, "b"), [*keys, "hour"]).groupBy(*keys).agg(
        F.corr("a", "b").alias("correlation"), F.count(F.lit(1)).alias("hours"))


def top_rows(df: DataFrame, by: str, k: int = 10, ascending: bool = False, ties: list[str] = ("ts",)) -> DataFrame:
    """The k rows with the largest (or smallest) value, ties broken by the given columns."""
    return df.orderBy(F.asc(by) if ascending else F.desc(by), *ties).limit(k)


def last_rows(df: DataFrame, n: int, ts: str = "ts", ties: list[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(ts), *ties).limit(n)
