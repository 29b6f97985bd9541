"""Registered queries: capacity, cost and recommendations."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import capacity as K
from tidemark.plans.inputs import series, series_ctes
from tidemark.plans.q_features import NAIVE_SQL, naive
from tidemark.plans.registry import query
from tidemark.schemas import ServerConfig

KEY = ["event_type"]
T = "request_count"

# Two requests and 20 kB per server and quarter of an hour.
CONFIG = ServerConfig(max_requests_per_min=2 / 15, max_bytes_per_min=20000 / 15, min_servers=1, max_servers=12)
_R, _B = "CAST(2 AS DOUBLE)", "CAST(20000 AS DOUBLE)"
_LO, _HI = CONFIG.min_servers, CONFIG.max_servers
_PRICE = "CAST(0.10 AS DOUBLE)"


def _need(r, b, buffer):
    up = f"CAST({1 + buffer!r} AS DOUBLE)"
    return (f"CAST(least(greatest(ceil({r} * {up} / {_R}), ceil({b} * {up} / {_B}), 1, {_LO}), {_HI}) AS INTEGER)")


PLAN_SQL = f"""{series_ctes('15min')}, {NAIVE_SQL},
plan AS (SELECT event_type, ts, {T}, bytes_total, {_need('prediction', '0', 0.2)} AS servers FROM naive)"""


def plan(spark, sf_dir):
    """Demand with a server column sized for the naive prediction."""
    s = naive(spark, sf_dir).withColumn("_zero", F.lit(0.0))
    return K.add_required_servers(s, CONFIG, 0.2, 15, "prediction", "_zero", "servers").drop("_zero", "prediction")


@query("utilization", f"""WITH {PLAN_SQL}
SELECT *, {T} / (servers * {_R}) AS request_util, bytes_total / (servers * {_B}) AS bytes_util,
  greatest({T} / (servers * {_R}), bytes_total / (servers * {_B})) AS max_util FROM plan""", doubles="request_util bytes_util max_util")
def utilization(spark, sf_dir):
    return K.add_utilization(plan(spark, sf_dir), "servers", CONFIG, 15)


@query("required_servers", f"WITH {series_ctes('15min')} SELECT event_type, ts, {T}, bytes_total, {_need(T, 'bytes_total', 0.2)} AS required_servers FROM series")
def required_servers(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T, "bytes_total")
    return K.add_required_servers(s, CONFIG, 0.2, 15)


_COSTS = "total_server_hours total_cost average_servers overprovisioning_cost sla_violation_rate"


def _fixed_sql(source: str, size: str, group: str, label: str = "") -> str:
    """Cost of a constant size per group, written straight from the definition."""
    cost = f"(count(*) * max(sz) * 0.25 * {_PRICE})"
    return f"""SELECT {group}{label}, count(*) * max(sz) * 0.25 AS total_server_hours, {cost} AS total_cost,
  CAST(max(sz) AS DOUBLE) AS average_servers, max(sz) AS peak_servers, max(sz) AS min_servers,
  {cost} * coalesce(greatest(0, sum(cap) - sum({T})) / nullif(sum(cap), 0), 0) AS overprovisioning_cost,
  count(*) FILTER (WHERE {T} > cap) AS underprovisioning_events,
  CAST(floor(sum(greatest(0, {T} - cap))) AS BIGINT) AS dropped_requests,
  count(*) FILTER (WHERE {T} > cap) * 100.0 / count(*) AS sla_violation_rate
FROM (SELECT *, CAST({size} AS INTEGER) AS sz, {size} * {_R} AS cap FROM {source}) GROUP BY {group}"""


@query("fixed_cost", f"WITH {series_ctes('15min')} {_fixed_sql('series', '2', 'event_type')}", doubles=_COSTS)
def fixed_cost(spark, sf_dir):
    return K.fixed_cost(series(spark, sf_dir), 2, CONFIG, 15, keys=KEY)


_DYNAMIC = f"""SELECT event_type, sum(servers) * 0.25 AS total_server_hours, sum(servers) * 0.25 * {_PRICE} AS total_cost,
  avg(servers) AS average_servers, max(servers) AS peak_servers, min(servers) AS min_servers,
  sum(servers) * 0.25 * {_PRICE} * sum(greatest(servers * {_R} - {T}, 0)) / sum(servers * {_R}) AS overprovisioning_cost,
  count(*) FILTER (WHERE {T} > servers * {_R}) AS underprovisioning_events,
  CAST(floor(sum(greatest(0, {T} - servers * {_R}))) AS BIGINT) AS dropped_requests,
  count(*) FILTER (WHERE {T} > servers * {_R}) * 100.0 / count(*) AS sla_violation_rate FROM plan GROUP BY ALL"""


@query("dynamic_cost", f"WITH {PLAN_SQL} {_DYNAMIC}", doubles=_COSTS)
def dynamic_cost(spark, sf_dir):
    return K.dynamic_cost(plan(spark, sf_dir), "servers", CONFIG, 15, keys=KEY)


_SIZES = f"(SELECT s.*, z.servers FROM series s, (SELECT CAST(unnest(range({_LO}, {_HI + 1})) AS INTEGER) AS servers) z)"


@query("fixed_cost_curve", f"WITH {series_ctes('15min')} {_fixed_sql(_SIZES, 'servers', 'event_type, servers')}", doubles=_COSTS)
def fixed_cost_curve(spark, sf_dir):
    return K.fixed_cost_curve(series(spark, sf_dir), CONFIG, 15, keys=KEY)


@query("optimal_fixed", f"""WITH {series_ctes('15min')}, curve AS ({_fixed_sql(_SIZES, 'servers', 'event_type, servers')})
SELECT c.* FROM curve c JOIN (SELECT event_type, coalesce(min(servers) FILTER (WHERE 100 - sla_violation_rate >= 99.0), max(servers)) AS best
  FROM curve GROUP BY ALL) b ON c.event_type = b.event_type AND c.servers = b.best""", doubles=_COSTS)
def optimal_fixed(spark, sf_dir):
    return K.optimal_fixed(series(spark, sf_dir), CONFIG, 99.0, 15, keys=KEY)


_SIZE = lambda x: f"CAST(ceil({x} / {_R}) AS INTEGER)"
STRATEGY_SQL = f"""{PLAN_SQL},
z AS (SELECT event_type, {_SIZE(f'max({T})')} AS p, {_SIZE(f'quantile_cont(CAST({T} AS DOUBLE), 0.9)')} AS q, {_SIZE(f'avg({T})')} AS a FROM plan GROUP BY ALL),
sized AS (SELECT plan.*, p, q, a FROM plan JOIN z ON plan.event_type = z.event_type),
strategies AS (
  {_fixed_sql('sized', 'p', 'event_type', ", 'Fixed (Peak)' AS strategy")}
  UNION ALL {_fixed_sql('sized', 'q', 'event_type', ", 'Fixed (P90)' AS strategy")}
  UNION ALL {_fixed_sql('sized', 'a', 'event_type', ", 'Fixed (Average)' AS strategy")}
  UNION ALL {_DYNAMIC.replace('SELECT event_type,', "SELECT event_type, 'Autoscaled' AS strategy,")}),
compared AS (SELECT s.*, b.total_cost - s.total_cost AS savings, round((b.total_cost - s.total_cost) / b.total_cost * 100, 2) AS savings_pct
  FROM strategies s JOIN strategies b ON s.event_type = b.event_type AND b.strategy = 'Fixed (Peak)')"""


@query("strategy_compare", f"WITH {STRATEGY_SQL} SELECT * FROM compared", doubles=_COSTS + " savings savings_pct")
def strategy_compare(spark, sf_dir):
    return K.compare_strategies(plan(spark, sf_dir), CONFIG, 15, autoscaled="servers", keys=KEY)


@query("roi", f"""WITH {STRATEGY_SQL}
SELECT event_type, strategy, total_cost, savings, savings - 50.0 AS total_savings, savings / 12.0 AS monthly_savings,
  CASE WHEN savings / 12.0 > 0 THEN 50.0 / (savings / 12.0) END AS payback_months, (savings - 50.0) / 50.0 * 100 AS roi_percent
FROM compared""", doubles="total_cost savings total_savings monthly_savings payback_months roi_percent")
def roi(spark, sf_dir):
    c = K.compare_strategies(plan(spark, sf_dir), CONFIG, 15, autoscaled="servers", keys=KEY)
    return K.add_roi(c, F.col("savings") + F.col("total_cost"), F.col("total_cost"), 50.0, 12).select(
        "event_type", "strategy", "total_cost", "savings", "total_savings", "monthly_savings", "payback_months", "roi_percent")


@query("recommend", f"""WITH {series_ctes('15min')}, {NAIVE_SQL},
i AS (SELECT event_type, ts, {T} AS current_requests, prediction AS predicted_requests, CAST(2 AS INTEGER) AS current_servers FROM naive),
u AS (SELECT *, current_requests / (current_servers * {_R}) AS cu, predicted_requests / (current_servers * {_R}) AS pu FROM i),
e AS (SELECT *, CASE WHEN pu IS NOT NULL AND pu <> 0 THEN pu ELSE cu END AS eu,
  CASE WHEN predicted_requests IS NOT NULL AND predicted_requests <> 0 THEN predicted_requests ELSE current_requests END AS need FROM u)
SELECT event_type, ts, current_requests, predicted_requests, current_servers, cu AS current_utilization, pu AS predicted_utilization,
  CASE WHEN eu > CAST(0.8 AS DOUBLE) THEN 'scale_out' WHEN eu < CAST(0.3 AS DOUBLE) THEN 'scale_in' ELSE 'maintain' END AS "action",
  CAST(CASE WHEN eu > CAST(0.8 AS DOUBLE) THEN greatest(current_servers + 2, ceil(need * CAST(1.2 AS DOUBLE) / {_R}))
    WHEN eu < CAST(0.3 AS DOUBLE) THEN greatest(1, current_servers - 1) ELSE current_servers END AS INTEGER) AS recommended_servers,
  CASE WHEN eu > CAST(0.8 AS DOUBLE) THEN least(0.9, eu) WHEN eu < CAST(0.3 AS DOUBLE) THEN 1.0 - eu ELSE 0.8 END AS confidence
FROM e""", doubles="predicted_requests current_utilization predicted_utilization confidence")
def recommend(spark, sf_dir):
    s = naive(spark, sf_dir).select(
        "event_type", "ts", F.col(T).alias("current_requests"), F.col("prediction").alias("predicted_requests"),
        F.lit(2).alias("current_servers"))
    return K.recommend(s, capacity=2.0).drop("reason")
