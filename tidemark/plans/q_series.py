"""Registered queries: log parsing and the traffic series core."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import in_any_interval, url_extension, url_path
from tidemark.functions.timebins import bin_start, interval_seconds
from tidemark.operators import series as S
from tidemark.plans.inputs import (
    CLF_LINES_SQL, LOGS_SQL, OUTAGE, SERIES_DOUBLES, TEST_START, clf_lines, logs, series, series_ctes,
)
from tidemark.plans.registry import query, table
from tidemark.session import scratch_dir
from tidemark.sources import clf, daily

# The oracle parses the text on its own, with DuckDB's regular expressions.
_GAP = r"[ \t]+"
_RX = _GAP.join([
    r"^([^ \t]+)", "-", "-",  # host, and two fields that are never filled
    r"\[([0-9]{2}/[A-Za-z]{3}/[0-9]{4}(?::[0-9]{2}){3})", r"([-+][0-9]{4})\]",  # time and zone
    r'"([A-Za-z0-9_]+)', r'([^ \t]+)[ \t]*([^"]*)"',  # method, address, protocol
    r"([0-9]{3})", r"([^ \t]+)$"])  # status, bytes
_FIELD = lambda i: f"regexp_extract(line, '{_RX}', {i})"
_PARSE_SQL = f"""
  SELECT event_id, line, {_FIELD(1)} AS host,
    try_strptime({_FIELD(2)}, '%d/%b/%Y:%H:%M:%S') AS "timestamp",
    {_FIELD(3)} AS timezone, {_FIELD(4)} AS "method", {_FIELD(5)} AS url,
    CASE WHEN {_FIELD(6)} = '' THEN 'HTTP/1.0' ELSE {_FIELD(6)} END AS protocol,
    TRY_CAST({_FIELD(7)} AS INTEGER) AS status_code,
    coalesce(TRY_CAST({_FIELD(8)} AS BIGINT), 0) AS bytes,
    regexp_matches(line, '{_RX}') AS matched
  FROM ({CLF_LINES_SQL}) AS l"""
_RECORD = 'host, "timestamp", timezone, "method", url, protocol, status_code, bytes'


@query("clf_parse", f'SELECT event_id, {_RECORD} FROM ({_PARSE_SQL}) AS p WHERE "timestamp" IS NOT NULL')
def clf_parse(spark, sf_dir):
    return clf.records(clf.parse(clf_lines(spark, sf_dir)), "event_id")


@query("quick_parse", f"""SELECT {_RECORD} FROM ({_PARSE_SQL}) AS p JOIN (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n FROM events) AS e USING (event_id)
WHERE n <= 1000 AND "timestamp" IS NOT NULL""")
def quick_parse(spark, sf_dir):
    """The records among the first thousand lines of a log file: a look at its format."""
    path = scratch_dir(spark, "quick")
    clf_lines(spark, sf_dir).orderBy("event_id").coalesce(1).select("line").write.text(path)
    return clf.quick_parse(spark, path)


@query("clf_scan", f'SELECT {_RECORD} FROM ({_PARSE_SQL}) AS p WHERE "timestamp" IS NOT NULL')
def clf_scan(spark, sf_dir):
    """Write the lines as text files and read them back through the text source."""
    out = scratch_dir(spark, "clf")
    clf_lines(spark, sf_dir).select("line").write.text(out)
    return clf.read_log(spark, out)


@query("clf_rejects", f"""
SELECT event_id, line, CASE WHEN matched THEN 'bad_timestamp' ELSE 'no_match' END AS reason
FROM ({_PARSE_SQL}) AS p WHERE "timestamp" IS NULL""")
def clf_rejects(spark, sf_dir):
    return clf.rejects(clf.parse(clf_lines(spark, sf_dir)), "event_id")


@query("clf_stats", f"""
SELECT count(*) AS total, count("timestamp") AS success, count(*) - count("timestamp") AS failed,
  count("timestamp") * 100.0 / count(*) AS success_rate FROM ({_PARSE_SQL}) AS p""", doubles="success_rate")
def clf_stats(spark, sf_dir):
    return clf.parse_stats(clf.parse(clf_lines(spark, sf_dir)))


@query("log_union", f"""
WITH logs AS ({LOGS_SQL})
SELECT event_id, host, ts AS "timestamp", "method", url, status_code, bytes FROM logs WHERE ts < TIMESTAMP '{TEST_START}'
UNION ALL
SELECT event_id, host, ts AS "timestamp", "method", url, status_code, bytes FROM logs WHERE ts >= TIMESTAMP '{TEST_START}'""")
def log_union(spark, sf_dir):
    train, test = S.split_train_test(
        logs(spark, sf_dir).select("event_id", "host", "timestamp", "method", "url", "status_code", "bytes"),
        TEST_START, "timestamp")
    return clf.union_logs(train, test)


@query("derived_columns", f"""
SELECT event_id, status_code,
  CASE WHEN status_code < 0 THEN NULL WHEN status_code <= 199 THEN '1xx' WHEN status_code <= 299 THEN '2xx'
    WHEN status_code <= 399 THEN '3xx' WHEN status_code <= 499 THEN '4xx' WHEN status_code <= 599 THEN '5xx' END AS status_category,
  status_code >= 200 AND status_code < 400 AS is_success, status_code >= 400 AS is_error,
  status_code >= 500 AS is_server_error, split_part(url, '?', 1) AS url_path,
  coalesce(nullif(regexp_extract(split_part(url, '?', 1), '\\.(\\w+)$', 1), ''), 'none') AS url_extension
FROM ({LOGS_SQL}) AS l""")
def derived_columns(spark, sf_dir):
    return S.add_derived_columns(logs(spark, sf_dir)).select(
        "event_id", "status_code", "status_category", "is_success", "is_error", "is_server_error",
        "url_path", "url_extension")


@query("url_parts", """
SELECT page_id, split_part(url, '?', 1) AS url_path,
  coalesce(nullif(regexp_extract(split_part(url, '?', 1), '\\.(\\w+)$', 1), ''), 'none') AS url_extension
FROM pages""")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", url_path("url").alias("url_path"), url_extension(url_path("url")).alias("url_extension"))


@query("ts_agg_15min", f"WITH {series_ctes('15min', (), fill=False)} SELECT * FROM series", doubles=SERIES_DOUBLES)
def ts_agg_15min(spark, sf_dir):
    return series(spark, sf_dir, "15min", (), fill=False)


@query("ts_agg_1h_by_type", f"WITH {series_ctes('1h', fill=False)} SELECT * FROM series", doubles=SERIES_DOUBLES)
def ts_agg_1h_by_type(spark, sf_dir):
    return series(spark, sf_dir, "1h", fill=False)


@query("ts_filled_15min", f"WITH {series_ctes('15min')} SELECT * FROM series", doubles=SERIES_DOUBLES)
def ts_filled_15min(spark, sf_dir):
    return series(spark, sf_dir, "15min")


@query("ts_filled_15min_total", f"WITH {series_ctes('15min', ())} SELECT * FROM series", doubles=SERIES_DOUBLES)
def ts_filled_15min_total(spark, sf_dir):
    return series(spark, sf_dir, "15min", ())


_MULTI = " UNION ALL ".join(
    f"SELECT '{g}' AS granularity, * FROM (WITH {series_ctes(g, ())} SELECT * FROM series) AS s{i}"
    for i, g in enumerate(("1min", "5min", "15min")))


@query("multi_granularity", _MULTI, doubles=SERIES_DOUBLES)
def multi_granularity(spark, sf_dir):
    return S.all_granularities(logs(spark, sf_dir), outages=(OUTAGE,))


@query("data_summary", f"""
WITH logs AS ({LOGS_SQL})
SELECT count(*) AS total_records, min(ts) AS start, max(ts) AS "end",
  count(*) FILTER (WHERE status_code BETWEEN 200 AND 299) AS success_2xx,
  count(*) FILTER (WHERE status_code BETWEEN 300 AND 399) AS redirect_3xx,
  count(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS client_error_4xx,
  count(*) FILTER (WHERE status_code BETWEEN 500 AND 599) AS server_error_5xx,
  CAST(sum(bytes) AS BIGINT) AS bytes_total, avg(bytes) AS bytes_mean,
  quantile_cont(CAST(bytes AS DOUBLE), 0.5) AS bytes_median, max(bytes) AS bytes_max,
  count(DISTINCT host) AS unique_hosts,
  CAST(date_diff('second', min(ts), max(ts)) // 86400 AS BIGINT) AS duration_days,
  date_diff('second', TIMESTAMP '{OUTAGE[0]}', TIMESTAMP '{OUTAGE[1]}') / 3600.0 AS outage_hours
FROM logs""", doubles="bytes_mean bytes_median outage_hours")
def data_summary(spark, sf_dir):
    return S.data_summary(logs(spark, sf_dir), outage=OUTAGE)


@query("value_counts", f"SELECT \"method\", status_code, count(*) AS n FROM ({LOGS_SQL}) AS l GROUP BY ALL")
def value_counts(spark, sf_dir):
    return S.value_counts(logs(spark, sf_dir), "method", "status_code")


@query("rollup_1h", f"""
WITH {series_ctes('15min')}
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS ts, CAST(sum(request_count) AS BIGINT) AS request_count,
  CAST(sum(bytes_total) AS BIGINT) AS bytes_total, CAST(sum(success_count) AS BIGINT) AS success_count,
  CAST(sum(error_count) AS BIGINT) AS error_count, CAST(sum(server_error_count) AS BIGINT) AS server_error_count
FROM series GROUP BY ALL""")
def rollup_1h(spark, sf_dir):
    return S.rollup(series(spark, sf_dir), "1h", ["event_type"])


@query("incremental_ingest", f"""
WITH {series_ctes('15min')} SELECT event_type, ts, request_count, bytes_total, bytes_std, success_count, error_count, unique_hosts, error_rate, is_storm_period FROM series""",
       doubles="bytes_std error_rate")
def incremental_ingest(spark, sf_dir):
    """The log ingested in two parts that share a day, the second part twice, and the series read from its days."""
    base, key = logs(spark, sf_dir), ["event_type"]
    store, path = scratch_dir(spark, "log-store"), scratch_dir(spark, "daily-series")
    early = F.col("timestamp") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    for batch, part in (("a", base.where(early)), ("b", base.where(~early)), ("b", base.where(~early))):
        daily.ingest_batch(part, batch, store, path, ("15min", "1h"), key)
    return daily.load_days(spark, path, "15min", key, outages=[OUTAGE]).select(
        *key, "ts", "request_count", "bytes_total", "bytes_std", "success_count", "error_count", "unique_hosts", "error_rate", "is_storm_period")


@query("hosts_by_sketch", f"""WITH logs AS ({LOGS_SQL})
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS ts, count(DISTINCT host) AS exact_hosts, true AS within_3_percent FROM logs GROUP BY ALL""")
def hosts_by_sketch(spark, sf_dir):
    """Hourly hosts merged from one-minute sketches, held against the exact counts."""
    base, key = logs(spark, sf_dir), ["event_type"]
    merged = S.rollup_hosts(S.host_sketches(base, "1min", key), "1h", key)
    exact = S.traffic_series(base, "1h", key, fill_gaps=False, outages=None).select(*key, "ts", F.col("unique_hosts").alias("exact_hosts"))
    return exact.join(merged, [*key, "ts"]).select(*key, "ts", "exact_hosts", (F.abs(F.col("unique_hosts") - F.col("exact_hosts")) <= 0.03 * F.col("exact_hosts")).alias("within_3_percent"))


_OUTAGES = """
  SELECT time_bucket(INTERVAL '1 day', ts) + INTERVAL '3 hours' AS outage_start,
    time_bucket(INTERVAL '1 day', ts) + INTERVAL '3 hours' + INTERVAL '45 minutes' AS outage_end
  FROM logs WHERE event_type = 'error' GROUP BY ALL HAVING count(*) >= 5"""


@query("outage_flag", f"""
WITH {series_ctes('15min')}, outages AS ({_OUTAGES})
SELECT event_type, ts, request_count,
  CAST(EXISTS (SELECT 1 FROM outages o WHERE s.ts BETWEEN o.outage_start AND o.outage_end) AS INTEGER) AS in_outage
FROM series s""")
def outage_flag(spark, sf_dir):
    """Bins inside any interval of an outage table (here one per day with errors)."""
    days = logs(spark, sf_dir).where("event_type = 'error'").groupBy(bin_start("timestamp", 86400).alias("d")) \
        .agg(F.count(F.lit(1)).alias("n")).where("n >= 5")
    outages = days.select(
        (F.col("d") + interval_seconds(3 * 3600)).alias("outage_start"),
        (F.col("d") + interval_seconds(3 * 3600 + 2700)).alias("outage_end"))
    flagged = S.mark_outages_from_table(series(spark, sf_dir), outages, name="in_outage")
    return flagged.select("event_type", "ts", "request_count", "in_outage")


@query("outage_filter", f"WITH {series_ctes('15min')} SELECT event_type, ts, request_count FROM series WHERE is_storm_period = 0")
def outage_filter(spark, sf_dir):
    return S.drop_outages(series(spark, sf_dir)).select("event_type", "ts", "request_count")


@query("train_test_split", f"""
WITH {series_ctes('15min')}
SELECT event_type, ts, request_count, CASE WHEN ts < TIMESTAMP '{TEST_START}' THEN 'train' ELSE 'test' END AS split FROM series""")
def train_test_split(spark, sf_dir):
    return S.with_split(series(spark, sf_dir), TEST_START).select("event_type", "ts", "request_count", "split")


@query("range_metrics", f"""
WITH {series_ctes('15min')}
SELECT event_type, CAST(sum(request_count) AS BIGINT) AS total_requests, avg(request_count) AS average_requests,
  max(request_count) AS peak_requests, min(request_count) AS min_requests, CAST(sum(bytes_total) AS BIGINT) AS total_bytes,
  avg(bytes_total) AS average_bytes, avg(error_rate) * 100 AS error_rate_pct, count(*) AS unique_periods
FROM series WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY ALL""",
       doubles="average_requests average_bytes error_rate_pct")
def range_metrics(spark, sf_dir):
    return S.range_metrics(series(spark, sf_dir), "2024-01-05", "2024-01-20 12:00:00", ["event_type"])


@query("outage_context", f"""
WITH {series_ctes('15min')}, b AS (SELECT TIMESTAMP '{OUTAGE[0]}' AS s, TIMESTAMP '{OUTAGE[1]}' AS e)
SELECT event_type, CASE WHEN ts < s THEN 'before' WHEN ts <= e THEN 'inside' ELSE 'after' END AS phase,
  count(*) AS bins, avg(request_count) AS average_requests, CAST(sum(request_count) AS BIGINT) AS total_requests,
  count(*) FILTER (WHERE request_count = 0) AS zero_bins
FROM series, b WHERE ts BETWEEN s - INTERVAL '6 hours' AND e + INTERVAL '6 hours' GROUP BY ALL""",
       doubles="average_requests")
def outage_context(spark, sf_dir):
    return S.outage_context(series(spark, sf_dir), OUTAGE, 6, ["event_type"])


@query("outage_zoom", f"""
WITH {series_ctes('15min')}
SELECT event_type, ts, request_count, is_storm_period FROM series
WHERE ts BETWEEN TIMESTAMP '{OUTAGE[0]}' - INTERVAL '24 hours' AND TIMESTAMP '{OUTAGE[1]}' + INTERVAL '24 hours'""")
def outage_zoom(spark, sf_dir):
    return S.outage_zoom(series(spark, sf_dir), OUTAGE).select("event_type", "ts", "request_count", "is_storm_period")


@query("gap_detect", f"""
WITH logs AS ({LOGS_SQL}),
bins AS (SELECT DISTINCT event_type, time_bucket(INTERVAL '1 minute', ts) AS ts FROM logs
  WHERE NOT (ts BETWEEN TIMESTAMP '{OUTAGE[0]}' AND TIMESTAMP '{OUTAGE[1]}')),
steps AS (SELECT event_type, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS gap_start, ts AS gap_end FROM bins)
SELECT event_type, gap_start, gap_end, date_diff('second', gap_start, gap_end) / 60.0 AS duration_minutes,
  gap_start >= TIMESTAMP '{OUTAGE[0]}' - INTERVAL '1 hour' AND gap_end <= TIMESTAMP '{OUTAGE[1]}' + INTERVAL '1 hour' AS is_storm_gap
FROM steps WHERE date_diff('second', gap_start, gap_end) > 5 * 60""", doubles="duration_minutes")
def gap_detect(spark, sf_dir):
    live = logs(spark, sf_dir).where(~in_any_interval("timestamp", [OUTAGE]))
    bins = S.traffic_series(live, "1min", ["event_type"], fill_gaps=False, outages=None)
    return S.detect_gaps(bins, 5, ["event_type"], outage=OUTAGE)
