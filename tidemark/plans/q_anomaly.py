"""Registered queries: anomaly detectors over the 15-minute series."""

from __future__ import annotations

from tidemark.operators import anomaly as A
from tidemark.operators import profile as P
from tidemark.plans.inputs import series, series_ctes
from tidemark.plans.registry import query

KEY = ["event_type"]
T = "request_count"

# Each detector spelled out on its own; `flags` carries all of them.
FLAGS_SQL = f"""{series_ctes('15min')},
g AS (SELECT event_type, avg({T}) AS gm, stddev_samp({T}) AS gs, quantile_cont(CAST({T} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({T} AS DOUBLE), 0.75) AS q3 FROM series GROUP BY ALL),
f AS (SELECT s.event_type, ts, {T}, unique_hosts, gm, gs, q1, q3,
  avg({T}) OVER r AS rm, stddev_samp({T}) OVER r AS rs,
  coalesce(avg({T}) OVER p, gm) AS pm, coalesce(stddev_samp({T}) OVER p, gs) AS ps, lag({T}) OVER o AS prev
  FROM series s JOIN g ON s.event_type = g.event_type
  WINDOW r AS (PARTITION BY s.event_type ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW),
    p AS (PARTITION BY s.event_type ORDER BY ts ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
    o AS (PARTITION BY s.event_type ORDER BY ts)),
flags AS (SELECT event_type, ts, {T}, unique_hosts, gm,
  ({T} - gm) / nullif(gs, 0) AS zscore,
  coalesce(abs(({T} - gm) / nullif(gs, 0)) > 3.0, false) AS is_zscore,
  {T} < q1 - 1.5 * (q3 - q1) OR {T} > q3 + 1.5 * (q3 - q1) AS is_iqr,
  ({T} - rm) / nullif(CASE WHEN rs = 0 THEN gs ELSE rs END, 0) AS rolling_zscore,
  coalesce(abs(({T} - rm) / nullif(CASE WHEN rs = 0 THEN gs ELSE rs END, 0)) > 2.5, false) AS is_rolling,
  coalesce({T} > pm + 2.0 * ps AND CASE WHEN prev = 0 THEN {T} <> 0 ELSE abs(({T} - prev) / CAST(prev AS DOUBLE)) > 1.0 END, false) AS is_spike,
  {T} < 0.5 * pm AS is_drop,
  coalesce(({T} - gm) / nullif(gs, 0) > 2.0 AND coalesce(unique_hosts / nullif(CAST({T} AS DOUBLE), 0), 1.0) < 0.5, false) AS is_ddos
  FROM f),
scored AS (SELECT *, CAST(is_zscore AS DOUBLE) + CAST(is_iqr AS DOUBLE) + CAST(is_rolling AS DOUBLE) + CAST(is_spike AS DOUBLE) AS score FROM flags)"""


def _series(spark, sf_dir):
    return series(spark, sf_dir).select("event_type", "ts", T)


def _scored(spark, sf_dir):
    return A.combined_score(_series(spark, sf_dir), T, keys=KEY, width="15min")


@query("anomaly_zscore", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, zscore, is_zscore FROM flags", doubles="zscore")
def anomaly_zscore(spark, sf_dir):
    return A.detect_zscore(_series(spark, sf_dir), T, keys=KEY)


@query("anomaly_iqr", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, is_iqr FROM flags")
def anomaly_iqr(spark, sf_dir):
    return A.detect_iqr(_series(spark, sf_dir), T, keys=KEY)


@query("anomaly_rolling", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, rolling_zscore, is_rolling FROM flags", doubles="rolling_zscore")
def anomaly_rolling(spark, sf_dir):
    return A.detect_rolling(_series(spark, sf_dir), T, keys=KEY, width="15min")


@query("anomaly_spike", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, is_spike FROM flags")
def anomaly_spike(spark, sf_dir):
    return A.detect_spikes(_series(spark, sf_dir), T, keys=KEY, width="15min")


@query("anomaly_drop", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, is_drop FROM flags")
def anomaly_drop(spark, sf_dir):
    return A.detect_drops(_series(spark, sf_dir), T, keys=KEY, width="15min")


@query("anomaly_ddos", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, unique_hosts, is_ddos FROM flags")
def anomaly_ddos(spark, sf_dir):
    return A.detect_ddos(series(spark, sf_dir).select("event_type", "ts", T, "unique_hosts"), keys=KEY)


@query("anomaly_combined", f"""WITH {FLAGS_SQL}
SELECT event_type, ts, {T}, zscore, is_zscore, is_iqr, rolling_zscore, is_rolling, is_spike, score FROM scored""",
       doubles="zscore rolling_zscore score")
def anomaly_combined(spark, sf_dir):
    return _scored(spark, sf_dir)


@query("anomaly_report", f"WITH {FLAGS_SQL} " + " UNION ALL ".join(f"""
SELECT event_type, '{m}' AS "method", '{A.METHOD_LABELS[m]}' AS label, count(*) AS records, count(*) FILTER (WHERE is_{m}) AS anomaly_count,
  count(*) FILTER (WHERE is_{m}) * 100.0 / count(*) AS anomaly_rate FROM flags GROUP BY event_type""" for m in A.COMBINED_METHODS),
       doubles="anomaly_rate")
def anomaly_report(spark, sf_dir):
    return A.report(_scored(spark, sf_dir), keys=KEY)


_EVERY = (*A.DEFAULTS, "ddos")


@query("anomaly_report_all", f"WITH {FLAGS_SQL} " + " UNION ALL ".join(f"""
SELECT event_type, '{m}' AS "method", '{A.METHOD_LABELS[m]}' AS label, count(*) AS records, count(*) FILTER (WHERE is_{m}) AS anomaly_count,
  count(*) FILTER (WHERE is_{m}) * 100.0 / count(*) AS anomaly_rate FROM flags GROUP BY event_type""" for m in _EVERY),
       doubles="anomaly_rate")
def anomaly_report_all(spark, sf_dir):
    """The report over all statistical detectors."""
    s = series(spark, sf_dir).select("event_type", "ts", T, "unique_hosts")
    return A.report(A.detect_ddos(A.detect(s, T, [*A.DEFAULTS], keys=KEY, width="15min"), keys=KEY), _EVERY, KEY)


@query("anomaly_severe", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T}, score FROM scored WHERE score >= 3", doubles="score")
def anomaly_severe(spark, sf_dir):
    return A.severe(_scored(spark, sf_dir), T, KEY)


@query("anomaly_timestamps", f"WITH {FLAGS_SQL} SELECT event_type, ts FROM scored WHERE score >= 2")
def anomaly_timestamps(spark, sf_dir):
    return A.anomaly_timestamps(_series(spark, sf_dir), T, keys=KEY, width="15min")


@query("anomaly_points", f"""WITH {FLAGS_SQL}
SELECT event_type, ts, CAST({T} AS DOUBLE) AS "value", CAST(3.0 AS DOUBLE) AS score, CASE WHEN {T} > gm THEN 'high' ELSE 'low' END AS "type"
FROM flags WHERE is_zscore""", doubles="value score")
def anomaly_points(spark, sf_dir):
    return A.anomaly_points(_series(spark, sf_dir), T, "zscore", 3.0, keys=KEY)


@query("top_spikes", f"WITH {FLAGS_SQL} SELECT event_type, ts, {T} FROM flags WHERE is_spike ORDER BY {T} DESC, ts, event_type LIMIT 10")
def top_spikes(spark, sf_dir):
    hits = A.detect_spikes(_series(spark, sf_dir), T, keys=KEY, width="15min").where("is_spike").drop("is_spike")
    return P.top_rows(hits, T, 10, ties=["ts", "event_type"])
