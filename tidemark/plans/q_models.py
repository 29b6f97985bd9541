"""Registered queries: trees, isolation forest, composed jobs, storage and streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import boosting as B
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import isolation as I
from tidemark.operators import series as S
from tidemark.operators import trees as TR
from tidemark.plans import training
from tidemark.plans.inputs import (
    LOGS_SQL, OUTAGE, SERIES_DOUBLES, TEST_START, clf_lines, logs, series, series_ctes,
)
from tidemark.plans.q_capacity import CONFIG, _R
from tidemark.plans.q_features import KEY, NAIVE_SQL, T, _all_sql, _CFG15, _CYCLES, _float_features, naive
from tidemark.plans.q_series import _MULTI, _PARSE_SQL, _RECORD
from tidemark.plans.registry import query
from tidemark.session import scratch_dir, settled
from tidemark.sources import tables
from tidemark.streaming import traffic as ST

#: Boosting rounds of the queries that train for something else than the rounds; a round costs about half a second of
#: scheduling however few the rows. `forecast_gbt` and `gbt_checks` train all 200 and choose among them.
ROUNDS = 20


def _clean(spark, sf_dir, freq="15min"):
    return S.drop_outages(series(spark, sf_dir, freq)).select("event_type", "ts", T, "bytes_total")


def _features(spark, sf_dir):
    f = X.all_features(_clean(spark, sf_dir).drop("bytes_total"), T, "15min", KEY)
    return f, X.feature_columns(f, keys=KEY)


def _supervised(spark, sf_dir):
    """One-step supervised rows of the 15-minute series; relative changes are left out, as most have no base on sparse series and rows would go with them."""
    f, names = _features(spark, sf_dir)
    names = [c for c in names if "pct_change" not in c]
    return X.supervised(f, T, names, 1, keys=KEY), names


@query("anomaly_iforest")
def anomaly_iforest(spark, sf_dir):
    s = series(spark, sf_dir).select("event_type", "ts", T)
    return I.detect_isolation_forest(s, T, keys=KEY, width="15min")


def _early_stopped(sup, names):
    """The test split and a model whose rounds end where the last part of the training split is met best."""
    train, test = S.split_train_test(sup, TEST_START)
    fit, valid = B.holdout(train)
    return test, valid, B.fit_gbt(fit, [*names, "event_type"], validation=valid, categorical=["event_type"], patience=B.PATIENCE)


@query("anomaly_iforest_report", f"WITH {series_ctes('15min')} SELECT event_type, count(*) AS series_rows, true AS within_share FROM series GROUP BY ALL")
def anomaly_iforest_report(spark, sf_dir):
    """Rows of every series, and whether no more than the asked share of those with features is flagged."""
    s = series(spark, sf_dir).select("event_type", "ts", T)
    flagged = I.detect_isolation_forest(s, T, keys=KEY, width="15min")
    found = I.isolation_report(flagged, KEY).select("event_type", (F.col("anomaly_count") <= F.ceil(F.col("records") * I.CONTAMINATION) + 1).alias("within_share"))
    return flagged.groupBy(*KEY).agg(F.count("*").alias("series_rows")).join(found, KEY)


@query("forecast_gbt")
def forecast_gbt(spark, sf_dir):
    """One-step-ahead predictions on the test split, early stopping on the end of the training split."""
    sup, names = _supervised(spark, sf_dir)
    sup = settled(sup, "supervised")
    test, _, model = _early_stopped(sup, names)
    return B.predict_gbt(model, test).select("event_type", "ts", F.col("label").alias("actual"), "prediction")


@query("gbt_checks", "SELECT CAST(200 AS BIGINT) AS rounds, true AS kept_is_least, true AS curve_is_error, true AS walk_is_model FROM (SELECT count(*) AS n FROM events) AS e WHERE n > 0")
def gbt_checks(spark, sf_dir):
    """Of full rounds: the kept ones are the validation curve's least point, its value is the kept model's error, and a plain walk of the nodes predicts as the model does."""
    sup, names = _supervised(spark, sf_dir)
    train, _ = S.split_train_test(settled(sup, "supervised"), TEST_START)
    fit, valid = B.holdout(train)
    model = B.fit_gbt(fit, names)
    curve = B.validation_curve(model, valid)
    errors = [r.mse for r in curve.orderBy("round").collect()]
    kept = TR.best_round(errors, len(errors))
    short = PipelineModel([*model.stages[:-1], TR.truncated(model.stages[-1], kept)])
    both = TR.walk(TR.NodeArrays.of(short.stages[-1], spark), short.transform(valid).drop("_features"), names)
    return both.agg(
        F.lit(len(errors)).cast("bigint").alias("rounds"), F.lit(errors[kept - 1] == min(errors)).alias("kept_is_least"),
        (F.abs(F.avg((F.col("_raw") - F.col("label")) ** 2) - errors[kept - 1]) < 1e-9 * (1 + errors[kept - 1])).alias("curve_is_error"),
        (F.max(F.abs(F.col("walked") - F.col("_raw"))) < 1e-9).alias("walk_is_model"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    sup, names = _supervised(spark, sf_dir)
    train, _ = S.split_train_test(settled(sup, "supervised"), TEST_START)
    return B.feature_importance(B.fit_gbt(train, names, max_iter=ROUNDS), 20)


@query("cv_scores")
def cv_scores(spark, sf_dir):
    sup, names = _supervised(spark, sf_dir)
    return E.cv_summary(B.cross_validate(sup, names, keys=KEY, max_iter=ROUNDS))


@query("forecast_multi")
def forecast_multi(spark, sf_dir):
    f, names = _features(spark, sf_dir)
    usable = [c for c in names if "pct_change" not in c]
    return B.forecast_direct(settled(f, "features"), T, usable, [1, 4, 96], KEY, max_iter=ROUNDS)


@query("forecast_recursive")
def forecast_recursive(spark, sf_dir):
    """The week after each series' end, 672 steps, every one from the ones before."""
    f, names = _features(spark, sf_dir)
    usable, f = [c for c in names if "pct_change" not in c], settled(f, "features")
    model = B.fit_gbt(settled(X.supervised(f, T, usable, 1, keys=KEY), "supervised"), usable, max_iter=ROUNDS)
    return TR.forecast_recursive(model, f, T, 672, "15min", KEY)


@query("grid_search")
def grid_search(spark, sf_dir):
    sup, names = _supervised(spark, sf_dir)
    train, test = S.split_train_test(settled(sup, "supervised"), TEST_START)
    return B.grid_pivot(B.grid_search(train, test, names, max_iter=ROUNDS), "maxDepth", "stepSize", [0.01, 0.05, 0.1])


@query("forecast_table")
def forecast_table(spark, sf_dir):
    clean = settled(_clean(spark, sf_dir), "clean")
    out = None
    for m in ("seasonal", "fourier", "trees"):
        one = training.forecast_table(clean, T, m, 96, KEY, max_iter=ROUNDS).withColumn("model", F.lit(m))
        out = one if out is None else out.unionByName(one)
    return out


@query("forecast_summary", f"""WITH {series_ctes('15min')}, {NAIVE_SQL}
SELECT event_type, avg(prediction) AS "mean", max(prediction) AS "max", min(prediction) AS "min" FROM naive GROUP BY ALL""", doubles="mean max min")
def forecast_summary(spark, sf_dir):
    return training.forecast_summary(naive(spark, sf_dir).select("event_type", F.col("prediction").alias("value")), KEY)


_PARSED_SQL = f'SELECT host, "timestamp" AS ts, status_code, bytes FROM ({_PARSE_SQL}) AS p WHERE "timestamp" IS NOT NULL'


@query("ingest", _MULTI.replace(LOGS_SQL, _PARSED_SQL), doubles=SERIES_DOUBLES)
def ingest(spark, sf_dir):
    """Log text to the saved series of all granularities, read back."""
    base = scratch_dir(spark, "ingest")
    clf_lines(spark, sf_dir).select("line").write.text(f"{base}/log")
    return training.ingest(spark, [f"{base}/log"], f"{base}/series", (OUTAGE,))


@query("train_evaluate")
def train_evaluate(spark, sf_dir):
    """Errors of all model families for both targets, and all models saved; the trend models' count comes from the saved ones."""
    base = scratch_dir(spark, "models")
    scored = training.train_and_evaluate(_clean(spark, sf_dir), test_start=TEST_START, keys=KEY, models=base, max_iter=ROUNDS)
    saved = tables.load_coefficients(spark, f"{base}/{T}/seasonal").agg(F.count("coef").alias("saved_models"))
    return scored.withColumn("saved_models", saved.scalar())


@query("series_sink", f"SELECT * FROM ({_MULTI}) WHERE granularity = '15min'", doubles=SERIES_DOUBLES)
def series_sink(spark, sf_dir):
    """Save all granularities, read one back."""
    path = scratch_dir(spark, "series")
    tables.save_series(S.all_granularities(logs(spark, sf_dir), outages=(OUTAGE,)), path)
    return tables.load_series(spark, path, "15min")


@query("feature_sink", f"""SELECT * FROM ({_all_sql('15min', _CFG15, 'WHERE is_storm_period = 0')}) WHERE ts >= TIMESTAMP '{TEST_START}'""",
       doubles=f"{_float_features(T, _CFG15)} {_CYCLES}")
def feature_sink(spark, sf_dir):
    """Save the feature table by split, read the test part back."""
    path = scratch_dir(spark, "features")
    f = X.all_features(_clean(spark, sf_dir).drop("bytes_total"), T, "15min", KEY, removed=[OUTAGE])
    tables.save_split(S.with_split(f, TEST_START), path)
    return tables.load_split(spark, path, "test").drop("split")


@query("csv_report", f"""WITH {series_ctes('1h')}
SELECT event_type, CAST(sum({T}) AS BIGINT) AS requests, avg({T}) AS mean_requests FROM series GROUP BY ALL""", doubles="mean_requests")
def csv_report(spark, sf_dir):
    path = scratch_dir(spark, "report")
    tables.save_report(series(spark, sf_dir, "1h").groupBy("event_type").agg(F.sum(T).alias("requests"), F.avg(T).alias("mean_requests")), path)
    return tables.load_report(spark, path, "event_type string, requests bigint, mean_requests double")


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Save a fitted pipeline, load it and predict with the copy."""
    sup, names = _supervised(spark, sf_dir)
    train, test = S.split_train_test(sup, TEST_START)
    path = scratch_dir(spark, "model")
    tables.save_model(B.fit_gbt(settled(train, "train"), names, max_iter=ROUNDS), path)
    return B.predict_gbt(tables.load_model(path), test).select("event_type", "ts", "prediction")


def _event_stream(spark, sf_dir):
    """The events table as a file stream, shaped into log records like the batch view."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


_BIN_COLS = ("event_type, ts, request_count, bytes_total, bytes_mean, bytes_std, success_count, error_count, server_error_count, "
             "unique_hosts, error_rate, avg_request_size")


@query("stream_traffic", f"""WITH {series_ctes('15min', fill=False)}
SELECT {_BIN_COLS} FROM series WHERE ts + INTERVAL '15 minutes' <= (SELECT max(ts) - INTERVAL '1 hour' FROM logs)""", doubles=SERIES_DOUBLES)
def stream_traffic(spark, sf_dir):
    """The bins a stream has closed once it has read everything available."""
    base = scratch_dir(spark, "stream")
    source = logs(spark, sf_dir, _event_stream(spark, sf_dir))
    ST.run_to_parquet(ST.traffic_stream(source, "15min", KEY), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


@query("stream_parse", f"""SELECT event_id, {_RECORD}, CAST(NULL AS VARCHAR) AS reason FROM ({_PARSE_SQL}) AS p WHERE "timestamp" IS NOT NULL
UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN matched THEN 'bad_timestamp' ELSE 'no_match' END
FROM ({_PARSE_SQL}) AS q WHERE "timestamp" IS NULL""")
def stream_parse(spark, sf_dir):
    base = scratch_dir(spark, "parse")
    lines = clf_lines(spark, sf_dir, _event_stream(spark, sf_dir))
    ST.parse_stream(lines, f"{base}/good", f"{base}/rejected", f"{base}/checkpoint", keep=("event_id",)).awaitTermination()
    good, bad = spark.read.parquet(f"{base}/good").drop("batch"), spark.read.parquet(f"{base}/rejected")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.select("event_id", "reason"), allowMissingColumns=True)
