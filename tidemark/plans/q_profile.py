"""Registered queries: profiles, distributions and correlations."""

from __future__ import annotations

from tidemark.operators import correlation as R
from tidemark.operators import features as X
from tidemark.operators import profile as P
from tidemark.operators import series as S
from tidemark.plans.inputs import TEST_START, series, series_ctes
from tidemark.plans.registry import query

_S15 = series_ctes("15min")
_DOW = "CAST(isodow(ts) - 1 AS INTEGER)"
_HOUR = "CAST(hour(ts) AS INTEGER)"


@query("hourly_profile", f"""
WITH {_S15}
SELECT event_type, {_HOUR} AS hour, avg(request_count) AS requests_mean, stddev_samp(request_count) AS requests_std,
  quantile_cont(CAST(request_count AS DOUBLE), 0.5) AS requests_median, max(request_count) AS requests_max,
  avg(bytes_total) AS bytes_mean, avg(error_rate) AS error_rate_mean
FROM series WHERE is_storm_period = 0 GROUP BY ALL""",
       doubles="requests_mean requests_std requests_median bytes_mean error_rate_mean")
def hourly_profile(spark, sf_dir):
    return P.hourly_profile(S.drop_outages(series(spark, sf_dir)), ["event_type"])


@query("dow_profile", f"""
WITH {_S15}
SELECT event_type, {_DOW} AS day_of_week, dayname(ts) AS day_name, avg(request_count) AS requests_mean,
  stddev_samp(request_count) AS requests_std, CAST(sum(request_count) AS BIGINT) AS requests_total,
  CAST(sum(bytes_total) AS BIGINT) AS bytes_total
FROM series WHERE is_storm_period = 0 GROUP BY ALL""", doubles="requests_mean requests_std")
def dow_profile(spark, sf_dir):
    return P.weekday_profile(S.drop_outages(series(spark, sf_dir)), ["event_type"])


_HEAT = ", ".join(f"avg(request_count) FILTER (WHERE hour(ts) = {h}) AS h{h}" for h in range(24))


@query("heatmap_pivot", f"WITH {_S15} SELECT event_type, {_DOW} AS day_of_week, {_HEAT} FROM series GROUP BY ALL",
       doubles=" ".join(f"h{h}" for h in range(24)))
def heatmap_pivot(spark, sf_dir):
    return P.heatmap(series(spark, sf_dir), keys=["event_type"])


@query("daily_rollup", f"""
WITH {_S15}
SELECT event_type, CAST(ts AS DATE) AS date, CAST(sum(request_count) AS BIGINT) AS request_count,
  CAST(sum(bytes_total) AS BIGINT) AS bytes_total, CAST(sum(error_count) AS BIGINT) AS error_count,
  CAST(sum(is_storm_period) AS BIGINT) AS storm_bins,
  sum(error_count) / nullif(sum(request_count), 0) AS error_rate, sum(is_storm_period) > 0 AS is_storm_day
FROM series GROUP BY ALL""", doubles="error_rate")
def daily_rollup(spark, sf_dir):
    return P.daily_rollup(series(spark, sf_dir), ["event_type"])


_DESCRIBED = ["request_count", "bytes_total", "bytes_mean", "bytes_std", "success_count", "error_count", "server_error_count", "unique_hosts",
              "error_rate", "avg_request_size"]


@query("describe_series", f"WITH {_S15} " + " UNION ALL ".join(f"""
SELECT event_type, '{c}' AS "column", count({c}) AS "count", avg({c}) AS "mean", stddev_samp({c}) AS "std",
  CAST(min({c}) AS DOUBLE) AS "min", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
  quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75,
  CAST(max({c}) AS DOUBLE) AS "max" FROM series GROUP BY event_type""" for c in _DESCRIBED),
       doubles='mean std min q25 q50 q75 max')
def describe_series(spark, sf_dir):
    return P.describe(series(spark, sf_dir), _DESCRIBED, ["event_type"])


@query("zero_share", f"""
WITH {_S15}
SELECT event_type, count(*) AS bins, count(*) FILTER (WHERE request_count = 0) AS zero_bins,
  count(*) FILTER (WHERE request_count = 0) * 100.0 / count(*) AS zero_pct,
  avg(error_rate) FILTER (WHERE request_count > 0) AS error_rate_mean,
  quantile_cont(error_rate, 0.5) FILTER (WHERE request_count > 0) AS error_rate_median
FROM series GROUP BY ALL""", doubles="zero_pct error_rate_mean error_rate_median")
def zero_share(spark, sf_dir):
    return P.zero_share(series(spark, sf_dir), ["event_type"])


def _histogram_sql(source: str, value: str, bins: int) -> str:
    return f"""
SELECT event_type, bin, lo + bin * w AS bin_start, lo + (bin + 1) * w AS bin_end, count(*) AS n FROM (
  SELECT s.event_type, lo, w, CAST(least(floor((CAST({value} AS DOUBLE) - lo) / w), {bins - 1}) AS INTEGER) AS bin
  FROM ({source}) s JOIN (SELECT event_type, CAST(min({value}) AS DOUBLE) AS lo,
    (CAST(max({value}) AS DOUBLE) - CAST(min({value}) AS DOUBLE)) / {bins}.0 AS w FROM ({source}) GROUP BY ALL) r
  ON s.event_type = r.event_type WHERE {value} IS NOT NULL) GROUP BY ALL"""


@query("histogram", f"WITH {_S15} " + _histogram_sql("SELECT * FROM series", "bytes_total", 50), doubles="bin_start bin_end")
def histogram(spark, sf_dir):
    return P.histogram(series(spark, sf_dir), "bytes_total", 50, ["event_type"])


_PCT = """SELECT event_type, pct FROM (SELECT event_type,
  (request_count - lag(request_count) OVER w) / nullif(CAST(lag(request_count) OVER w AS DOUBLE), 0) AS pct
  FROM series WINDOW w AS (PARTITION BY event_type ORDER BY ts)) WHERE pct > -2 AND pct < 2"""


@query("pct_change_histogram", f"WITH {series_ctes('1h')} " + _histogram_sql(_PCT, "pct", 50), doubles="bin_start bin_end")
def pct_change_histogram(spark, sf_dir):
    """Distribution of relative changes inside (-2, 2)."""
    d = X.add_diffs(series(spark, sf_dir, "1h"), "request_count", [1], ["event_type"], width="1h")
    d = d.withColumnRenamed("request_count_pct_change_1", "pct").where("pct > -2 AND pct < 2")
    return P.histogram(d, "pct", 50, ["event_type"])


@query("box_stats", f"""
WITH {_S15}, s AS (SELECT event_type, {_HOUR} AS hour, CAST(bytes_total AS DOUBLE) AS x FROM series),
q AS (SELECT event_type, hour, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM s GROUP BY ALL)
SELECT s.event_type, s.hour, q1, median, q3,
  min(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM s JOIN q ON s.event_type = q.event_type AND s.hour = q.hour GROUP BY ALL""",
       doubles="q1 median q3 whisker_low whisker_high")
def box_stats(spark, sf_dir):
    from pyspark.sql import functions as F
    return P.box_stats(series(spark, sf_dir).withColumn("hour", F.hour("ts")), "bytes_total", ["event_type", "hour"])


@query("split_summary", f"""
WITH {_S15}
SELECT event_type, CASE WHEN ts < TIMESTAMP '{TEST_START}' THEN 'train' ELSE 'test' END AS split, count(*) AS n,
  min(ts) AS "start", max(ts) AS "end", avg(request_count) AS "mean", stddev_samp(request_count) AS "std"
FROM series WHERE is_storm_period = 0 GROUP BY ALL""", doubles="mean std")
def split_summary(spark, sf_dir):
    return P.split_summary(S.with_split(S.drop_outages(series(spark, sf_dir)), TEST_START), ["event_type"])


@query("profile_corr", f"""
WITH {_S15},
a AS (SELECT event_type, hour(ts) AS h, avg(request_count) AS v FROM series WHERE is_storm_period = 0 AND ts < TIMESTAMP '{TEST_START}' GROUP BY ALL),
b AS (SELECT event_type, hour(ts) AS h, avg(request_count) AS v FROM series WHERE ts >= TIMESTAMP '{TEST_START}' GROUP BY ALL)
SELECT a.event_type, corr(a.v, b.v) AS correlation, count(*) AS hours FROM a JOIN b ON a.event_type = b.event_type AND a.h = b.h GROUP BY ALL""",
       doubles="correlation")
def profile_corr(spark, sf_dir):
    train, test = S.split_train_test(series(spark, sf_dir), TEST_START)
    return P.profile_correlation(S.drop_outages(train), test, ["event_type"])


@query("top_hours", f"""
WITH {series_ctes('1h', ())}
SELECT ts, request_count FROM series ORDER BY request_count DESC, ts LIMIT 10""")
def top_hours(spark, sf_dir):
    return P.top_rows(series(spark, sf_dir, "1h", ()).select("ts", "request_count"), "request_count", 10)


@query("bottom_hours", f"""
WITH {series_ctes('1h', ())}
SELECT ts, request_count FROM series ORDER BY request_count, ts LIMIT 10""")
def bottom_hours(spark, sf_dir):
    return P.top_rows(series(spark, sf_dir, "1h", ()).select("ts", "request_count"), "request_count", 10, ascending=True)


@query("last_n", f"WITH {_S15} SELECT event_type, ts, request_count FROM series ORDER BY ts DESC, event_type LIMIT 96")
def last_n(spark, sf_dir):
    return P.last_rows(series(spark, sf_dir).select("event_type", "ts", "request_count"), 96, ties=["event_type"])


def _acf_ctes(lags: int) -> str:
    return f"""{_S15},
x AS (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS rn,
  request_count - avg(request_count) OVER (PARTITION BY event_type) AS d FROM series WHERE is_storm_period = 0),
k AS (SELECT CAST(unnest(range(0, {lags + 1})) AS INTEGER) AS lag),
cov AS (SELECT a.event_type, k.lag, sum(a.d * b.d) AS s FROM x a JOIN k ON true
  JOIN x b ON a.event_type = b.event_type AND a.rn = b.rn + k.lag GROUP BY ALL)"""


@query("acf", f"""
WITH {_acf_ctes(100)}
SELECT c.event_type, c.lag, c.s / z.s AS acf FROM cov c JOIN cov z ON c.event_type = z.event_type AND z.lag = 0""", doubles="acf")
def acf(spark, sf_dir):
    from tidemark.plans.inputs import OUTAGE
    return R.acf(S.drop_outages(series(spark, sf_dir)), "request_count", 100, ["event_type"], width="15min", removed=[OUTAGE])


@query("acf_1min", f"""
WITH {series_ctes('1min', keys=())},
d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY ts) AS n, request_count - avg(request_count) OVER () AS x FROM series),
cov AS (SELECT CAST(g.lag AS INTEGER) AS lag, sum(a.x * b.x) AS s FROM d a CROSS JOIN range(1441) g(lag) JOIN d b ON b.n = a.n - g.lag GROUP BY ALL)
SELECT c.lag, c.s / z.s AS acf FROM cov c JOIN cov z ON z.lag = 0""", doubles="acf")
def acf_1min(spark, sf_dir):
    """Autocorrelation of the whole traffic at every minute of a day."""
    return R.acf(series(spark, sf_dir, "1min", ()), "request_count", 1440, width="1min")


# Levinson-Durbin as a recursion over lags: `phi` holds the coefficients of one order.
@query("pacf", f"""
WITH RECURSIVE {_acf_ctes(60)},
r AS (SELECT event_type, list(s / z ORDER BY lag) AS r FROM (
    SELECT event_type, lag, s, first_value(s) OVER (PARTITION BY event_type ORDER BY lag) AS z FROM cov) GROUP BY event_type),
steps AS (
  SELECT event_type, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1 AS DOUBLE) AS v, CAST(1 AS DOUBLE) AS pacf FROM r
  UNION ALL
  SELECT event_type, r, k + 1, list_append(list_transform(phi, lambda p, i: p - a * phi[k - i + 1]), a), v * (1 - a * a), a
  FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(phi, lambda p, i: p * r[k + 2 - i])), 0)) / v AS a
        FROM steps WHERE k < 60))
SELECT event_type, CAST(k AS INTEGER) AS lag, pacf FROM steps""", doubles="pacf")
def pacf(spark, sf_dir):
    from tidemark.plans.inputs import OUTAGE
    return R.pacf(S.drop_outages(series(spark, sf_dir)), "request_count", 60, ["event_type"], width="15min", removed=[OUTAGE])
