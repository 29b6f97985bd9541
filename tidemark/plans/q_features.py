"""Registered queries: model features and ordered windows."""

from __future__ import annotations

from tidemark.operators import correlation as R
from tidemark.operators import features as X
from tidemark.operators import profile as P
from tidemark.operators import series as S
from tidemark.plans.inputs import OUTAGE, series, series_ctes
from tidemark.plans.registry import query

KEY = ["event_type"]
T = "request_count"
_W = "PARTITION BY event_type ORDER BY ts"

_CALENDAR = """CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(day(ts) AS INTEGER) AS day_of_month, CAST(weekofyear(ts) AS INTEGER) AS week_of_year, CAST(month(ts) AS INTEGER) AS month,
  CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(hour(ts) BETWEEN 9 AND 17 AND isodow(ts) <= 5 AS INTEGER) AS is_business_hour,
  sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
  sin(2 * pi() * (isodow(ts) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(ts) - 1) / 7) AS dow_cos"""
_CYCLES = "hour_sin hour_cos dow_sin dow_cos"


def _lags(t, lags):
    return [f"lag({t}, {k}) OVER ({_W}) AS {t}_lag_{k}" for k in lags]


def _rolling(t, windows):
    out = []
    for n in windows:
        f = f"OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        out += [f"avg({t}) {f} AS {t}_rolling_mean_{n}", f"coalesce(stddev_samp({t}) {f}, 0.0) AS {t}_rolling_std_{n}",
                f"max({t}) {f} AS {t}_rolling_max_{n}", f"min({t}) {f} AS {t}_rolling_min_{n}"]
    return out


def _diffs(t, periods):
    out = []
    for p in periods:
        prev = f"lag({t}, {p}) OVER ({_W})"
        out += [f"{t} - {prev} AS {t}_diff_{p}",
                f"({t} - {prev}) / nullif(CAST({prev} AS DOUBLE), 0) AS {t}_pct_change_{p}"]
    return out


def _float_features(t, cfg, full=True):
    names = [f"{t}_rolling_{s}_{n}" for n in cfg["windows"] for s in ("mean", "std")]
    if full:
        names += [f"{t}_pct_change_{p}" for p in cfg["diff_periods"]] + [f"{t}_ewm_{s}" for s in cfg["ewm_spans"]]
    return " ".join(names)


def _ewm_ctes(source: str, spans) -> str:
    """The smoothing recursion, unrolled row by row."""
    cols = ", ".join(f"{2 / (s + 1)!r} * n.x + {1 - 2 / (s + 1)!r} * p.e{s}" for s in spans)
    start = ", ".join(f"x AS e{s}" for s in spans)
    return f"""xs AS (SELECT event_type, ts, CAST({T} AS DOUBLE) AS x, row_number() OVER ({_W}) AS rn FROM {source}),
ewm AS (SELECT event_type, ts, rn, {start} FROM xs WHERE rn = 1
  UNION ALL SELECT n.event_type, n.ts, n.rn, {cols} FROM ewm p JOIN xs n ON n.event_type = p.event_type AND n.rn = p.rn + 1)"""


@query("calendar_features", f"WITH {series_ctes('1h')} SELECT event_type, ts, {_CALENDAR} FROM series", doubles=_CYCLES)
def calendar_features(spark, sf_dir):
    return X.add_calendar(series(spark, sf_dir, "1h").select("event_type", "ts"))


_CFG15 = X.feature_config("15min")
_CFG1H = X.feature_config("1h")


@query("lag_features", f"WITH {series_ctes('15min')} SELECT event_type, ts, {', '.join(_lags(T, _CFG15['lags']))} FROM series")
def lag_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    return X.add_lags(s, T, _CFG15["lags"], KEY, width="15min").drop(T)


@query("rolling_features", f"WITH {series_ctes('15min')} SELECT event_type, ts, {', '.join(_rolling(T, _CFG15['windows']))} FROM series",
       doubles=_float_features(T, _CFG15, full=False))
def rolling_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    return X.add_rolling(s, T, _CFG15["windows"], KEY, width="15min").drop(T)


@query("diff_features", f"WITH {series_ctes('15min')} SELECT event_type, ts, {', '.join(_diffs(T, _CFG15['diff_periods']))} FROM series",
       doubles=" ".join(f"{T}_pct_change_{p}" for p in _CFG15["diff_periods"]))
def diff_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    return X.add_diffs(s, T, _CFG15["diff_periods"], KEY, width="15min").drop(T)


@query("ewm_features", f"""WITH RECURSIVE {series_ctes('15min')}, {_ewm_ctes('series', (4, 96))}
SELECT event_type, ts, e4 AS {T}_ewm_4, e96 AS {T}_ewm_96 FROM ewm""", doubles=f"{T}_ewm_4 {T}_ewm_96")
def ewm_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    return X.add_ewm(s, T, [4, 96], KEY, width="15min").drop(T)


_CLEAN15 = f"{series_ctes('15min')}, clean AS (SELECT * FROM series WHERE is_storm_period = 0)"


def _with_hole(spark, sf_dir):
    """The series without its outage; nothing tells the operators about the hole, and blocks end inside it."""
    return S.drop_outages(series(spark, sf_dir)).select("event_type", "ts", T)


@query("lag_features_gaps", f"WITH {_CLEAN15} SELECT event_type, ts, {', '.join(_lags(T, _CFG15['lags']))} FROM clean")
def lag_features_gaps(spark, sf_dir):
    return X.add_lags(_with_hole(spark, sf_dir), T, _CFG15["lags"], KEY, width="15min", block_rows=100).drop(T)


@query("ewm_gaps", f"""WITH RECURSIVE {_CLEAN15}, {_ewm_ctes('clean', (4, 96))}
SELECT event_type, ts, e4 AS {T}_ewm_4, e96 AS {T}_ewm_96 FROM ewm""", doubles=f"{T}_ewm_4 {T}_ewm_96")
def ewm_gaps(spark, sf_dir):
    return X.add_ewm(_with_hole(spark, sf_dir), T, [4, 96], KEY, width="15min", block_rows=100).drop(T)


@query("lag_features_by_time", f"""WITH {_CLEAN15} SELECT c.event_type, c.ts, {', '.join(f'l{k}.{T} AS {T}_lag_{k}' for k in (1, 96))} FROM clean c
""" + " ".join(f"LEFT JOIN clean l{k} ON l{k}.event_type = c.event_type AND l{k}.ts = c.ts - INTERVAL {15 * k} MINUTE" for k in (1, 96)))
def lag_features_by_time(spark, sf_dir):
    return X.add_lags(_with_hole(spark, sf_dir), T, [1, 96], KEY, width="15min", time_based=True).drop(T)


def _all_sql(freq, cfg, where="", others=()):
    cols = [*_lags(T, cfg["lags"]), *_rolling(T, cfg["windows"]), *_diffs(T, cfg["diff_periods"])]
    for o in others:
        cols += _lags(o, cfg["lags"]) + _rolling(o, cfg["windows"])
    smooth = ", ".join(f"e{s} AS {T}_ewm_{s}" for s in cfg["ewm_spans"])
    return f"""WITH RECURSIVE {series_ctes(freq)}, clean AS (SELECT * FROM series {where}), {_ewm_ctes('clean', cfg['ewm_spans'])}
SELECT s.*, {smooth} FROM (SELECT event_type, ts, {T}, {', '.join([*others, *cols])}, {_CALENDAR} FROM clean) s
JOIN ewm ON s.event_type = ewm.event_type AND s.ts = ewm.ts"""


_CFG1M = X.feature_config("1min", ewm_spans=[])


@query("features_1min", f"""WITH {series_ctes('1min')}
SELECT event_type, ts, {T}, {', '.join([*_lags(T, _CFG1M['lags']), *_rolling(T, _CFG1M['windows']), *_diffs(T, _CFG1M['diff_periods'])])}, {_CALENDAR} FROM series""",
       doubles=f"{_float_features(T, _CFG1M)} {_CYCLES}")
def features_1min(spark, sf_dir):
    """The minute configuration with its day-wide windows; smoothed means apart."""
    s = series(spark, sf_dir, "1min").select("event_type", "ts", T)
    return X.all_features(s, T, "1min", KEY, width="1min", ewm_spans=[])


@query("all_features_1h", _all_sql("1h", _CFG1H), doubles=f"{_float_features(T, _CFG1H)} {_CYCLES}")
def all_features_1h(spark, sf_dir):
    s = series(spark, sf_dir, "1h").select("event_type", "ts", T)
    return X.all_features(s, T, None, KEY, width="1h")


@query("all_features_15min", _all_sql("15min", _CFG15, "WHERE is_storm_period = 0"), doubles=f"{_float_features(T, _CFG15)} {_CYCLES}")
def all_features_15min(spark, sf_dir):
    """Features over the series without its outage rows, lags running across the hole."""
    s = S.drop_outages(series(spark, sf_dir)).select("event_type", "ts", T)
    return X.all_features(s, T, "15min", KEY, removed=[OUTAGE])


@query("multi_target_features", _all_sql("15min", _CFG15, others=["bytes_total"]),
       doubles=f"{_float_features(T, _CFG15)} {_float_features('bytes_total', _CFG15, full=False)} {_CYCLES}")
def multi_target_features(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T, "bytes_total")
    return X.features_for_targets(s, (T, "bytes_total"), "15min", KEY)


_SUP = [f"{T}_lag_{k}" for k in _CFG15["lags"]] + [f"{T}_diff_{p}" for p in _CFG15["diff_periods"]]


@query("supervised_h1", f"""WITH {series_ctes('15min')}
SELECT * FROM (SELECT event_type, ts, {', '.join(_lags(T, _CFG15['lags']))},
  {', '.join(d for d in _diffs(T, _CFG15['diff_periods']) if '_diff_' in d)},
  CAST(lead({T}, 1) OVER ({_W}) AS DOUBLE) AS label FROM series)
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*_SUP, 'label'])}""", doubles="label")
def supervised_h1(spark, sf_dir):
    f = X.all_features(series(spark, sf_dir).select("event_type", "ts", T), T, "15min", KEY)
    return X.supervised(f, T, _SUP, 1, keys=KEY, width="15min")


# Every column of the feature table, and every feature in it.
_FEATURES = [c.rsplit(" AS ", 1)[1] for c in [*_lags(T, _CFG15["lags"]), *_rolling(T, _CFG15["windows"]), *_diffs(T, _CFG15["diff_periods"])]] + [
    *[f"{T}_ewm_{s}" for s in _CFG15["ewm_spans"]], "hour", "day_of_week", "day_of_month", "week_of_year", "month", "is_weekend", "is_business_hour", *_CYCLES.split()]
_TABLE = ["event_type", "ts", T, *_FEATURES]
_TABLE_CTE = f"WITH f AS MATERIALIZED (SELECT * FROM ({_all_sql('15min', _CFG15)}))"


def _feature_table(spark, sf_dir):
    return X.all_features(series(spark, sf_dir).select("event_type", "ts", T), T, "15min", KEY)


@query("null_counts", f"{_TABLE_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM f" for c in _TABLE)
       + f" UNION ALL SELECT 'any_column', count(*) FILTER (WHERE {' OR '.join(f'{c} IS NULL' for c in _TABLE)}) FROM f")
def null_counts(spark, sf_dir):
    return P.null_counts(_feature_table(spark, sf_dir))


@query("cyclic_lookup", f"""WITH {series_ctes('1h')}
SELECT DISTINCT hour, day_of_week, round(hour_sin, 6) + 0.0 AS hour_sin, round(hour_cos, 6) + 0.0 AS hour_cos
FROM (SELECT {_CALENDAR} FROM series)""", doubles="hour_sin hour_cos")
def cyclic_lookup(spark, sf_dir):
    return P.distinct_values(X.add_calendar(series(spark, sf_dir, "1h")), "hour", "day_of_week", "hour_sin", "hour_cos")


def _corr_sql(a, b):
    return f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END"


_CORR_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, {_corr_sql(c, T)} AS correlation FROM f" for c in _FEATURES)


@query("feature_corr", f"{_TABLE_CTE} {_CORR_SQL}", doubles="correlation")
def feature_corr(spark, sf_dir):
    f = _feature_table(spark, sf_dir)
    return R.feature_correlation(f, X.feature_columns(f, keys=KEY), T)


_MATRIX = [T, *[f"{T}_lag_{k}" for k in _CFG15["lags"]], *[f"{T}_rolling_{s}_{n}" for n in _CFG15["windows"] for s in ("mean", "std")],
           *[f"{T}_diff_{p}" for p in _CFG15["diff_periods"]]]


@query("feature_corr_matrix", f"{_TABLE_CTE} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {_corr_sql(a, b)} AS correlation FROM f" for a in _MATRIX for b in _MATRIX), doubles="correlation")
def feature_corr_matrix(spark, sf_dir):
    return R.correlation_matrix(_feature_table(spark, sf_dir), _MATRIX)


@query("feature_corr_top", f"""{_TABLE_CTE} SELECT * FROM ({_CORR_SQL})
ORDER BY abs(correlation) DESC NULLS LAST, feature LIMIT 15""", doubles="correlation")
def feature_corr_top(spark, sf_dir):
    f = _feature_table(spark, sf_dir)
    return R.top_correlated(f, X.feature_columns(f, keys=KEY), T, 15)


@query("rolling_full", f"""WITH {series_ctes('15min')}
SELECT event_type, ts, CASE WHEN n = 96 THEN m END AS {T}_mean_96, CASE WHEN n = 96 THEN s END AS {T}_std_96
FROM (SELECT event_type, ts, count({T}) OVER w AS n, avg({T}) OVER w AS m, stddev_samp({T}) OVER w AS s FROM series
  WINDOW w AS ({_W} ROWS BETWEEN 95 PRECEDING AND CURRENT ROW))""", doubles=f"{T}_mean_96 {T}_std_96")
def rolling_full(spark, sf_dir):
    return X.rolling_full(series(spark, sf_dir).select("event_type", "ts", T), T, 96, KEY, width="15min").drop(T)


@query("centered_ma", f"""WITH {series_ctes('15min')}, d AS (SELECT event_type, date_trunc('day', ts) AS ts, sum({T}) AS v FROM series GROUP BY ALL)
SELECT event_type, CAST(ts AS TIMESTAMP) AS ts, CAST(v AS BIGINT) AS {T}, CASE WHEN n = 7 THEN m END AS {T}_centered_7
FROM (SELECT *, count(v) OVER w AS n, avg(v) OVER w AS m FROM d WINDOW w AS ({_W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))""",
       doubles=f"{T}_centered_7")
def centered_ma(spark, sf_dir):
    daily = S.rollup(series(spark, sf_dir).select("event_type", "ts", T), 86400, KEY)
    return X.centered_mean(daily, T, 7, KEY)


NAIVE_SQL = f"""naive AS (SELECT event_type, ts, {T}, bytes_total, coalesce(p, first_value(p IGNORE NULLS) OVER
    ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS prediction
  FROM (SELECT *, CASE WHEN count({T}) OVER w = 4 THEN avg({T}) OVER w END AS p FROM series
    WINDOW w AS ({_W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)))"""


def naive(spark, sf_dir, freq="15min", **options):
    s = series(spark, sf_dir, freq).select("event_type", "ts", T, "bytes_total")
    return X.naive_forecast(s, T, 4, KEY, width=freq, **options)


@query("naive_forecast", f"WITH {series_ctes('15min')}, {NAIVE_SQL} SELECT event_type, ts, {T}, prediction FROM naive", doubles="prediction")
def naive_forecast(spark, sf_dir):
    return naive(spark, sf_dir).drop("bytes_total")


@query("ffill_align", f"""WITH {series_ctes('15min')},
known AS (SELECT event_type, ts, avg_request_size AS carried FROM series WHERE request_count > 0)
SELECT s.event_type, s.ts, last_value(carried IGNORE NULLS) OVER (PARTITION BY s.event_type ORDER BY s.ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
FROM series s LEFT JOIN known k ON s.event_type = k.event_type AND s.ts = k.ts""", doubles="carried")
def ffill_align(spark, sf_dir):
    s = series(spark, sf_dir)
    known = s.where("request_count > 0").select("event_type", "ts", s.avg_request_size.alias("carried"))
    return X.align_ffill(s.select("event_type", "ts"), known, "carried", KEY)


@query("lookahead", f"""WITH {series_ctes('15min')}
SELECT event_type, ts, {T}, coalesce(lead({T}, 15) OVER ({_W}), last_value({T}) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS ahead
FROM series""")
def lookahead(spark, sf_dir):
    return X.look_ahead(series(spark, sf_dir).select("event_type", "ts", T), T, 15, KEY, name="ahead", width="15min")
