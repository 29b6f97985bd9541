import pytest

from tidemark.operators import evaluate as E


def frame(spark, actual, predicted):
    return spark.createDataFrame([(float(a), float(p)) for a, p in zip(actual, predicted)], "actual double, predicted double")


@pytest.mark.parametrize("add,mse,rmse,mae", [(0, 0, 0, 0), (10, 100, 10, 10)])
def test_constant_error(spark, add, mse, rmse, mae):
    y = range(100, 600, 100)
    r = E.metrics(frame(spark, y, [v + add for v in y])).first()
    assert (r.MSE, r.RMSE, r.MAE) == (mse, rmse, mae) and (add or r.MAPE == 0)


def test_mape_skips_zeros(spark):
    y = [0, 100, 200, 0, 300]
    assert E.metrics(frame(spark, y, [v + 10 for v in y])).first().MAPE == pytest.approx((10 + 5 + 10 / 3) / 3)
    assert E.metrics(frame(spark, [0] * 5, range(10, 60, 10))).first().MAPE is None


def test_prefix(spark):
    assert E.metrics(frame(spark, [1], [1]), prefix="test_").columns == ["test_MSE", "test_RMSE", "test_MAE", "test_MAPE"]


def test_ranking(spark):
    df = spark.createDataFrame([("S", 50.0), ("L", 45.0), ("P", 55.0)], "model string, RMSE double")
    assert [(r.model, r["rank"]) for r in E.rank_models(df).collect()] == [("L", 1), ("S", 2), ("P", 3)]
    assert E.rank_models(df, ascending=False).first().model == "P"


@pytest.mark.parametrize("pred,share", [([105, 95, 110, 90, 100], 100), ([105, 120, 95, 80], 50)])
def test_accuracy(spark, pred, share):
    assert E.forecast_accuracy(frame(spark, [100] * len(pred), pred)).first().accuracy_within_threshold == share


def test_signed_errors(spark):
    assert E.forecast_accuracy(frame(spark, [100] * 3, [110, 120, 130])).first().mean_error > 0
    r = E.forecast_accuracy(frame(spark, [100] * 3, [150, 80, 100])).first()
    assert (r.max_overpredict, r.max_underpredict) == (50, 20)


def test_cv_summary_uses_population_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 2.0, 4.0)], "RMSE double, MAE double, MAPE double")
    r = E.cv_summary(df).first()
    assert (r.RMSE_mean, r.RMSE_std, r.MAE_std, r.MAPE_mean) == (2, 1, 0, 4)


def test_summary_percent_is_missing_for_zero(spark):
    rows = {r.actual: r for r in E.with_errors(frame(spark, [0, -10, 10], [5, -5, 5])).collect()}
    assert rows[0].pct_error is None and rows[-10].pct_error == -50 and rows[10].pct_error == 50
