"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as X
from tidemark.operators import series as S
from tidemark.plans import catalog
from tidemark.plans.inputs import logs, series


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    p = plan(S.time_range(events, "2024-01-05", "2024-01-06").groupBy("event_type").count())
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", p)


def test_feature_set_needs_one_exchange_for_all_frames(spark, sf_dir, tmp_path):
    path = str(tmp_path / "s")
    series(spark, sf_dir).write.parquet(path)
    saved = spark.read.parquet(path)
    p = plan(X.all_features(saved, "request_count", "15min", ["event_type"]))
    # One for all frames; the others number the rows by 30-day chunks.
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_blk", p)) == 1


def test_log_is_scanned_once(spark, sf_dir):
    for df in (S.traffic_series(logs(spark, sf_dir), "15min", ["event_type"]), S.all_granularities(logs(spark, sf_dir))):
        assert plan(df).count("FileScan") == 1


def test_distinct_hosts_are_spread_before_the_bin(spark, sf_dir):
    p = plan(S.traffic_series(logs(spark, sf_dir), "15min", fill_gaps=False))
    assert re.search(r"Exchange hashpartitioning\(\S+#\d+, host#\d+", p)


def test_grid_and_gaps_never_order_a_whole_series(spark, sf_dir):
    bins = series(spark, sf_dir, "1min", fill=False)
    for df in (S.fill_grid(bins, "1min", ["event_type"]), S.detect_gaps(bins, 5, ["event_type"])):
        p = plan(df)
        specs = re.findall(r"windowspecdefinition\(([^)]*)", p)
        assert specs and all("_chunk" in s or "_part" in s for s in specs)
        assert p.count("FileScan") == 1


NO_PAIRS = sorted(n for n in catalog.QUERIES if not n.startswith(
    ("stream", "forecast_gbt", "forecast_multi", "forecast_table", "feature_importance", "cv_scores", "grid_search", "train_evaluate",
     "model_roundtrip", "anomaly_iforest", "clf_scan", "ingest", "series_sink", "feature_sink", "csv_report")))


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_pairwise_joins(spark, sf_dir, name):
    p = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
