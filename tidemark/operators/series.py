"""Log records to regular traffic series, and operators on such series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.stats import attach, exact_quantiles
from tidemark.functions.timebins import from_seconds, interval_seconds, ntz, seconds_of, width_seconds, with_bin
from tidemark.operators.blocks import with_successor
from tidemark.schemas import (
    GRANULARITIES, OUTAGE, OUTAGE_COLUMN, SAVED_GRANULARITIES, TEST_START, require_columns, require_timestamp,
)
from tidemark.session import settled

_ZERO_FILLED = ("request_count", "bytes_total", "bytes_std", "success_count", "error_count",
                "server_error_count", "unique_hosts", "error_rate", "avg_request_size")
_GRID_CHUNK = 1024


def add_derived_columns(logs: DataFrame) -> DataFrame:
    """Add status class, success and error flags, URL path and extension."""
    require_columns(logs, "status_code", "url")
    return logs.withColumns({
        "status_category": C.status_category("status_code"),
        "is_success": C.is_success("status_code"),
        "is_error": C.is_error("status_code"),
        "is_server_error": C.is_server_error("status_code"),
        "url_path": C.url_path("url"),
        "url_extension": C.url_extension(C.url_path("url")),
    })


def _traffic_aggregates() -> list[Column]:
    return [
        F.count("host").alias("request_count"),
        F.sum("bytes").alias("bytes_total"),
        F.avg("bytes").alias("bytes_mean"),
        F.coalesce(F.stddev_samp("bytes"), F.lit(0.0)).alias("bytes_std"),
        F.count_if(C.is_success("status_code")).alias("success_count"),
        F.count_if(C.is_error("status_code")).alias("error_count"),
        F.count_if(C.is_server_error("status_code")).alias("server_error_count"),
        F.countDistinct("host").alias("unique_hosts"),
    ]


def _with_rates(series: DataFrame) -> DataFrame:
    return series.withColumns({
        "error_rate": C.ratio_or_zero(F.col("error_count"), F.col("request_count")),
        "avg_request_size": C.ratio_or_zero(F.col("bytes_total"), F.col("request_count")),
    })


def traffic_series(
    logs: DataFrame, freq: str | int = "1min", keys: list[str] = (), ts: str = "timestamp",
    fill_gaps: bool = True, outages=(OUTAGE,),
) -> DataFrame:
    """Tumbling aggregation of log records into one row per key and bin.

    The distinct-host count makes Spark group by (key, bin, host) first, so a bin holding
    much of the log is spread over its hosts before the final merge.
    """
    require_timestamp(logs, ts)
    keys = list(keys)
    binned = with_bin(logs, ts, freq, "_bin")
    series = _with_rates(binned.groupBy(*keys, F.col("_bin").alias("ts")).agg(*_traffic_aggregates()))
    if fill_gaps:
        series = fill_grid(series, freq, keys)
    return mark_outages(series, outages) if outages is not None else series


def fill_grid(
    series: DataFrame, freq: str | int | Column, keys: list[str] = (), zero: tuple[str, ...] = _ZERO_FILLED,
) -> DataFrame:
    """Insert the missing bins between a series' first and last bin.

    Each row emits itself and the empty bins up to its successor, so the log behind the
    series is scanned once and no join is needed. Counts, sums, spreads and rates of an
    empty bin are 0, other values NULL. `freq` may be a column of bin widths in seconds.
    """
    keys = list(keys)
    others = [c for c in series.columns if c not in keys and c != "ts"]
    width = freq if isinstance(freq, Column) else F.lit(width_seconds(freq)).cast("bigint")
    runs = with_successor(series, keys, "ts").withColumns({"_sec": seconds_of("ts"), "_w": width}) \
        .withColumn("_end", F.coalesce(seconds_of("_next") - F.col("_w"), F.col("_sec"))).drop("_next")
    # Two levels keep the generated arrays short across long gaps.
    outer = runs.withColumn("_from", F.explode(F.sequence("_sec", "_end", F.col("_w") * _GRID_CHUNK)))
    upto = F.least(F.col("_from") + F.col("_w") * (_GRID_CHUNK - 1), F.col("_end"))
    dense = outer.withColumn("_at", F.explode(F.sequence(F.col("_from"), upto, F.col("_w"))))
    inserted = F.col("_at") > F.col("_sec")

    def value(c: str) -> Column:
        t = series.schema[c].dataType
        empty = F.lit(0).cast(t) if c in zero else F.lit(None).cast(t)
        return F.when(inserted, empty).otherwise(F.col(c)).alias(c)

    return dense.select(*keys, from_seconds(F.col("_at")).alias("ts"), *[value(c) for c in others])


def mark_outages(series: DataFrame, outages=(OUTAGE,), ts: str = "ts", name: str = OUTAGE_COLUMN) -> DataFrame:
    """Add 1/0: does the bin start inside a closed outage interval of the given short list?"""
    return series.withColumn(name, C.in_any_interval(ts, outages).cast("int"))


def mark_outages_from_table(
    series: DataFrame, outages: DataFrame, ts: str = "ts", name: str = OUTAGE_COLUMN, bucket: str | int = 86400,
) -> DataFrame:
    """As `mark_outages` for an outage *table* `(outage_start, outage_end)` of any size.

    Intervals are spread over the day buckets they touch and joined by bucket, so neither
    side has to be small. Overlapping intervals do not repeat rows.
    """
    w = width_seconds(bucket)
    s, e = seconds_of("outage_start"), seconds_of("outage_end")
    spans = outages.select(
        F.col("outage_start"), F.col("outage_end"),
        F.explode(F.sequence(F.floor(s / w).cast("bigint"), F.floor(e / w).cast("bigint"))).alias("_bucket"),
    )
    points = series.select(ts).distinct().withColumn("_bucket", F.floor(seconds_of(ts) / w).cast("bigint"))
    hit = points.join(
        spans, (points["_bucket"] == spans["_bucket"])
        & points[ts].between(spans["outage_start"], spans["outage_end"]), "left_semi",
    ).select(F.col(ts).alias("_hit"))
    return series.join(hit, F.col(ts) == F.col("_hit"), "left") \
        .withColumn(name, F.col("_hit").isNotNull().cast("int")).drop("_hit")


def drop_outages(series: DataFrame, name: str = OUTAGE_COLUMN) -> DataFrame:
    return series.where(F.col(name) == 0)


def all_granularities(
    logs: DataFrame, granularities=SAVED_GRANULARITIES, keys: list[str] = (), ts: str = "timestamp",
    fill_gaps: bool = True, outages=(OUTAGE,),
) -> DataFrame:
    """The traffic series at several bin widths from one scan, told apart by `granularity`.

    Distinct hosts and spreads do not add up across bins, so each record is grouped once
    per width; the partial aggregation before the exchange absorbs the repetition.
    """
    keys = list(keys)
    spread = logs
    for g in granularities:
        spread = with_bin(spread, ts, g, f"_bin_{g}")
    pairs = F.array(*[F.struct(F.lit(g).alias("granularity"), F.col(f"_bin_{g}").alias("bin")) for g in granularities])
    spread = spread.withColumn("_g", F.explode(pairs)).withColumns({"granularity": F.col("_g.granularity"), "_bin": F.col("_g.bin")})
    series = _with_rates(
        spread.groupBy("granularity", *keys, F.col("_bin").alias("ts")).agg(*_traffic_aggregates()))
    if fill_gaps:
        width_of = F.create_map(*[F.lit(v) for g in granularities for v in (g, GRANULARITIES[g])])
        width = F.element_at(width_of, F.col("granularity")).cast("bigint")
        series = fill_grid(series, width, ["granularity", *keys])
    return mark_outages(series, outages) if outages is not None else series


def rollup(series: DataFrame, freq: str | int = "1h", keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Re-aggregate a finer series by summing its additive columns."""
    binned = with_bin(series, ts, freq, "_bin")
    additive = [c for c in ("request_count", "bytes_total", "success_count", "error_count", "server_error_count")
                if c in series.columns]
    return binned.groupBy(*keys, F.col("_bin").alias("ts")).agg(*[F.sum(c).alias(c) for c in additive])


#: Precision of host sketches: 2 ** 14 slots, a standard error of 0.8 %.
HOST_SKETCH = 14


def host_sketches(logs: DataFrame, freq: str | int = "1min", keys: list[str] = (), ts: str = "timestamp") -> DataFrame:
    """`(keys, ts, hosts_sketch)`: a mergeable sketch of each bin's hosts, small while the bin has few."""
    return with_bin(logs, ts, freq, "_bin").groupBy(*keys, F.col("_bin").alias("ts")).agg(F.hll_sketch_agg("host", HOST_SKETCH).alias("hosts_sketch"))


def rollup_hosts(sketches: DataFrame, freq: str | int = "1h", keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """`(keys, ts, hosts_sketch, unique_hosts)` of wider bins, merged from the sketches of finer ones; the count is an estimate."""
    merged = with_bin(sketches, ts, freq, "_bin").groupBy(*keys, F.col("_bin").alias("ts")).agg(F.hll_union_agg("hosts_sketch").alias("hosts_sketch"))
    return merged.withColumn("unique_hosts", F.hll_sketch_estimate("hosts_sketch"))


def data_summary(logs: DataFrame, ts: str = "timestamp", outage=OUTAGE) -> DataFrame:
    """One row: record counts per status class, byte statistics, span, hosts, outage hours.

    The log is scanned once, into counts of each host's byte values; those are saved, as the median reads them as well.
    """
    classes = {"success_2xx": 2, "redirect_3xx": 3, "client_error_4xx": 4, "server_error_5xx": 5}
    counted = settled(logs.groupBy("host", "bytes").agg(
        F.count(F.lit(1)).alias("total_records"), F.min(ts).alias("start"), F.max(ts).alias("end"),
        *[F.count_if(F.col("status_code").between(100 * c, 100 * c + 99)).alias(n) for n, c in classes.items()]), "summary")
    base = counted.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("total_records", *classes)],
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.sum(F.col("bytes") * F.col("total_records")).alias("bytes_total"),
        F.sum(F.when(F.col("bytes").isNotNull(), F.col("total_records"))).alias("_sized"), F.max("bytes").alias("bytes_max"),
        F.countDistinct("host").alias("unique_hosts"),
    ).withColumn("bytes_mean", F.try_divide(F.col("bytes_total").cast("double"), F.col("_sized").cast("double"))).drop("_sized")
    base = base.withColumn(
        "duration_days", F.floor((seconds_of("end") - seconds_of("start")) / F.lit(86400)).cast("bigint"))
    median = exact_quantiles(counted, "bytes", {"bytes_median": 0.5}, weight="total_records")
    hours = (seconds_of(ntz(outage[1])) - seconds_of(ntz(outage[0]))) / F.lit(3600.0)
    return attach(base, median, []).withColumn("outage_hours", hours)


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per distinct value, most frequent first (ties by value)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *cols)


def detect_gaps(
    series: DataFrame, threshold_minutes: float = 5, keys: list[str] = (), ts: str = "ts",
    outage=OUTAGE, margin_hours: int = 1,
) -> DataFrame:
    """Steps between consecutive non-empty bins longer than the threshold."""
    keys = list(keys)
    steps = with_successor(series.where(F.col("request_count") > 0).select(*keys, ts), keys, ts) \
        .select(*keys, F.col(ts).alias("gap_start"), F.col("_next").alias("gap_end"))
    minutes = (seconds_of("gap_end") - seconds_of("gap_start")) / F.lit(60.0)
    margin = interval_seconds(margin_hours * 3600)
    return steps.withColumn("duration_minutes", minutes).where(F.col("duration_minutes") > threshold_minutes) \
        .withColumn("is_storm_gap", (F.col("gap_start") >= ntz(outage[0]) - margin)
                    & (F.col("gap_end") <= ntz(outage[1]) + margin))


def split_train_test(series: DataFrame, test_start=TEST_START, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows before the instant, and rows from it on."""
    return series.where(F.col(ts) < ntz(test_start)), series.where(F.col(ts) >= ntz(test_start))


def with_split(series: DataFrame, test_start=TEST_START, ts: str = "ts") -> DataFrame:
    """The same split as a `split` column, for partitioned tables and grouped summaries."""
    return series.withColumn("split", F.when(F.col(ts) < ntz(test_start), "train").otherwise("test"))


def time_range(series: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """Rows inside a closed time range; either end may be open."""
    if start is not None:
        series = series.where(F.col(ts) >= ntz(start))
    if end is not None:
        series = series.where(F.col(ts) <= ntz(end))
    return series


def range_metrics(series: DataFrame, start=None, end=None, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Totals, mean, peak and minimum of a time range."""
    return time_range(series, start, end, ts).groupBy(*keys).agg(
        F.sum("request_count").alias("total_requests"),
        F.avg("request_count").alias("average_requests"),
        F.max("request_count").alias("peak_requests"),
        F.min("request_count").alias("min_requests"),
        F.sum("bytes_total").alias("total_bytes"),
        F.avg("bytes_total").alias("average_bytes"),
        (F.avg("error_rate") * 100).alias("error_rate_pct"),
        F.count(F.lit(1)).alias("unique_periods"),
    )


def outage_context(series: DataFrame, outage=OUTAGE, hours: int = 6, keys: list[str] = (), ts: str = "ts") -> DataFrame:
    """Traffic in the hours before, during and after an outage."""
    start, end, margin = ntz(outage[0]), ntz(outage[1]), interval_seconds(hours * 3600)
    t = F.col(ts)
    phase = F.when((t >= start - margin) & (t < start), "before") \
        .when((t >= start) & (t <= end), "inside").when((t > end) & (t <= end + margin), "after")
    return time_range(series, None, None, ts).where((t >= start - margin) & (t <= end + margin)) \
        .groupBy(*keys, phase.alias("phase")).agg(
            F.count(F.lit(1)).alias("bins"),
            F.avg("request_count").alias("average_requests"),
            F.sum("request_count").alias("total_requests"),
            F.count_if(F.col("request_count") == 0).alias("zero_bins"),
        )


def outage_zoom(series: DataFrame, outage=OUTAGE, hours: int = 24, ts: str = "ts") -> DataFrame:
    """The rows from `hours` before to `hours` after an outage."""
    margin = interval_seconds(hours * 3600)
    return series.where((F.col(ts) >= ntz(outage[0]) - margin) & (F.col(ts) <= ntz(outage[1]) + margin))
