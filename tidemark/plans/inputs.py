"""How the given tables stand in for an access log, in Spark and in the oracle's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timebins import bin_start
from tidemark.operators.series import traffic_series
from tidemark.plans.registry import table

OUTAGE = ("2024-01-10 14:52:01", "2024-01-12 04:36:13")
TEST_START = "2024-01-23"


def logs(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Log records derived from `events` (or a stream of them), plus `event_id` and `event_type`."""
    e = table(spark, sf_dir, "events") if events is None else events
    kind, n = F.col("event_type"), F.col("event_id")
    return e.select(
        n, kind,
        F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("host"),
        bin_start("ts", 1).alias("timestamp"),
        F.lit("-0400").alias("timezone"),
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(
            F.lit("/"), kind, F.lit("/"), (n % 50).cast("string"),
            F.when(n % 4 == 0, ".gif").when(n % 4 == 1, ".html?k=1").when(n % 4 == 2, "/").otherwise(""),
        ).alias("url"),
        F.lit("HTTP/1.0").alias("protocol"),
        F.when(kind == "click", 304).when(kind == "signup", 302)
        .when(kind == "error", F.when(n % 3 == 0, 404).when(n % 3 == 1, 500).otherwise(503))
        .otherwise(200).cast("int").alias("status_code"),
        F.when(n % 11 == 0, F.lit(0)).otherwise(F.round(F.col("value") * 100)).cast("bigint").alias("bytes"),
    )


LOGS_SQL = """
  SELECT event_id, event_type, concat('h', CAST(user_id AS VARCHAR)) AS host,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, '-0400' AS timezone,
    CASE WHEN event_type IN ('purchase','signup') THEN 'POST' ELSE 'GET' END AS method,
    concat('/', event_type, '/', CAST(event_id % 50 AS VARCHAR),
      CASE event_id % 4 WHEN 0 THEN '.gif' WHEN 1 THEN '.html?k=1' WHEN 2 THEN '/' ELSE '' END) AS url,
    'HTTP/1.0' AS protocol,
    CAST(CASE event_type WHEN 'click' THEN 304 WHEN 'signup' THEN 302
      WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 503 END ELSE 200 END AS INTEGER) AS status_code,
    CASE WHEN event_id % 11 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(value * 100) AS BIGINT) END AS bytes
  FROM events"""


def clf_lines(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """`(event_id, line)`: the logs as CLF text with some malformed lines and bad dates."""
    n = F.col("event_id")
    stamp = F.when(n % 101 == 0, "31/Feb/2024:00:00:00") \
        .otherwise(F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss"))
    line = F.concat(
        F.col("host"), F.lit(" - - ["), stamp, F.lit(' -0400] "'), F.col("method"), F.lit(" "), F.col("url"),
        F.lit(" "), F.col("protocol"), F.lit('" '), F.col("status_code").cast("string"), F.lit(" "),
        F.when(n % 11 == 0, "-").otherwise(F.col("bytes").cast("string")),
    )
    return logs(spark, sf_dir, events).select(
        n, F.when(n % 97 == 0, F.concat(F.lit("bad line "), n.cast("string"))).otherwise(line).alias("line"))


CLF_LINES_SQL = f"""
  SELECT event_id, CASE
    WHEN event_id % 97 = 0 THEN concat('bad line ', CAST(event_id AS VARCHAR))
    ELSE concat(host, ' - - [', stamp, ' -0400] "', method, ' ', url, ' ', protocol, '" ',
      CAST(status_code AS VARCHAR), ' ', CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(bytes AS VARCHAR) END) END AS line
  FROM (SELECT *, CASE WHEN event_id % 101 = 0 THEN '31/Feb/2024:00:00:00'
        ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END AS stamp FROM ({LOGS_SQL}) AS l) AS s"""

FREQ_SQL = {"1min": "1 minute", "5min": "5 minutes", "15min": "15 minutes", "1h": "1 hour"}


def series(spark: SparkSession, sf_dir: str, freq: str = "15min", keys=("event_type",), fill: bool = True) -> DataFrame:
    return traffic_series(logs(spark, sf_dir), freq, list(keys), fill_gaps=fill, outages=(OUTAGE,))


def series_ctes(freq: str = "15min", keys=("event_type",), fill: bool = True, name: str = "series") -> str:
    """CTE list (without WITH) ending in the traffic series `name`."""
    step = FREQ_SQL[freq]
    k = "".join(f"{c}, " for c in keys)
    join = " AND ".join([f"a.{c} = g.{c}" for c in keys] + ["a.ts = g.ts"])
    flag = f"CAST(CASE WHEN g.ts BETWEEN TIMESTAMP '{OUTAGE[0]}' AND TIMESTAMP '{OUTAGE[1]}' THEN 1 ELSE 0 END AS INTEGER)"
    gk = "".join(f"g.{c}, " for c in keys)
    agg = f"""logs AS ({LOGS_SQL}),
agg AS (
  SELECT {k}time_bucket(INTERVAL '{step}', ts) AS ts, count(host) AS request_count,
    CAST(sum(bytes) AS BIGINT) AS bytes_total, avg(bytes) AS bytes_mean,
    coalesce(stddev_samp(bytes), 0.0) AS bytes_std,
    count(*) FILTER (WHERE status_code >= 200 AND status_code < 400) AS success_count,
    count(*) FILTER (WHERE status_code >= 400) AS error_count,
    count(*) FILTER (WHERE status_code >= 500) AS server_error_count,
    count(DISTINCT host) AS unique_hosts
  FROM logs GROUP BY ALL)"""
    if fill:
        grid = f"""grid AS (
  SELECT {k}unnest(generate_series(lo, hi, INTERVAL '{step}')) AS ts
  FROM (SELECT {k}min(ts) AS lo, max(ts) AS hi FROM agg {'GROUP BY ALL' if keys else ''}) AS s)"""
    else:
        grid = f"grid AS (SELECT {k}ts FROM agg)"
    return f"""{agg},
{grid},
{name} AS (
  SELECT {gk}g.ts, coalesce(request_count, 0) AS request_count, coalesce(bytes_total, 0) AS bytes_total,
    bytes_mean, coalesce(bytes_std, 0.0) AS bytes_std, coalesce(success_count, 0) AS success_count,
    coalesce(error_count, 0) AS error_count, coalesce(server_error_count, 0) AS server_error_count,
    coalesce(unique_hosts, 0) AS unique_hosts,
    CASE WHEN request_count > 0 THEN error_count / request_count ELSE 0.0 END AS error_rate,
    CASE WHEN request_count > 0 THEN bytes_total / request_count ELSE 0.0 END AS avg_request_size,
    {flag} AS is_storm_period
  FROM grid g LEFT JOIN agg a ON {join})"""


# Floating columns of a traffic series.
SERIES_DOUBLES = "bytes_mean bytes_std error_rate avg_request_size"
