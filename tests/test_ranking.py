import math

import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY, YEARLY
from loomcast.operators.ranking import (
    combine,
    forecast_summary,
    model_metrics,
    rank_models,
    side_by_side,
    yearly_summary,
)
from loomcast.operators.reshape import columns_to_variables, stack, variables_to_columns

ROW = "product string, country string, model string, actual double, predicted double"


def one(metrics):
    (row,) = metrics.collect()
    return row


def test_accuracy_by_hand(make):
    pairs = [(100.0, 110.0), (200.0, 180.0), (0.0, 5.0), (50.0, None), (None, 4.0)]
    row = one(model_metrics(make(ROW, [("p", "X", "m", a, b) for a, b in pairs]), MONTHLY))
    assert (row.n, row.n_zero_actual) == (3, 1)
    assert row.mae == pytest.approx(35 / 3) and row.mse == pytest.approx(525 / 3)
    assert row.rmse == pytest.approx(math.sqrt(175)) and row.mape_pct == pytest.approx(10)
    assert row.mape > 1e15
    assert row.r2 == pytest.approx(1 - 525 / 20000)


def test_nothing_to_compare_gives_nulls(make):
    row = one(model_metrics(make(ROW, [("p", "X", "m", None, 1.0)]), MONTHLY))
    assert row.n == 0 and row.mae is None and row.mape is None and row.r2 is None
    single = one(model_metrics(make(ROW, [("p", "X", "m", 5.0, 4.0)]), MONTHLY))
    assert single.r2 is None and single.mae == 1.0


def test_ranking_puts_nulls_last_and_breaks_ties_in_fixed_order(make):
    rows = [("rf", 0.1), ("lgb", 0.1), ("sarimax", 0.1), ("xgb", None), ("prophet", 0.2), ("ensemble", 0.0)]
    df = make("product string, country string, model string, mape double", [("a-b", "X Y", *r) for r in rows])
    assert [r.model for r in rank_models(df, MONTHLY).orderBy("rank").collect()] == ["sarimax", "rf", "lgb"]
    assert [r.model for r in rank_models(df, MONTHLY, 9).orderBy("rank").collect()][-1] == "xgb"


@pytest.fixture(scope="module")
def forecasts(make):
    schema = "product string, country string, year int, month int, model string, actual double, predicted double"
    rows = []
    for month in (1, 2):
        for model, value in (("rf", 10.0), ("lgb", 20.0), ("xgb", 60.0), ("sarimax", 999.0)):
            gone = model == "xgb" and month == 2
            rows.append(("p", "X", 2020, month, model, 5.0, None if gone else value * month))
    return make(schema, rows)


@pytest.fixture(scope="module")
def ranking(make):
    rows = [("rf", 1, 0.1), ("lgb", 2, 0.2), ("xgb", 3, 0.4)]
    return make("product string, country string, model string, rank int, mape double", [("p", "X", *r) for r in rows])


def test_ensembles(forecasts, ranking):
    equal = {r.month: r for r in combine(forecasts, ranking, MONTHLY).collect()}
    assert equal[1].predicted == 30.0 and equal[1].models_used == 3 and equal[1].model == "ensemble"
    assert equal[2].predicted == 30.0 and equal[2].models_used == 2
    weighted = {r.month: r.predicted for r in combine(forecasts, ranking, MONTHLY, "inverse_mape").collect()}
    assert weighted[1] == pytest.approx((10 * 10 + 20 * 5 + 60 * 2.5) / 17.5, rel=1e-4)
    assert 20 <= weighted[2] <= 40


def test_side_by_side(forecasts, ranking):
    rows = {r.month: r for r in side_by_side(forecasts, ranking, MONTHLY).collect()}
    assert (rows[1].pred_0, rows[1].pred_1, rows[1].pred_2, rows[1].ensemble_pred) == (10.0, 20.0, 60.0, 30.0)
    assert rows[2].pred_2 is None and rows[2].ensemble_pred == 30.0


def test_summaries(forecasts, ranking):
    got = {r.model: r for r in forecast_summary(forecasts, MONTHLY).collect()}
    assert (got["rf"].mean, got["rf"].min, got["rf"].max) == (15.0, 10.0, 20.0)
    assert got["rf"].std == pytest.approx(math.sqrt(50)) and got["xgb"].std is None
    january = forecasts.filter("month = 1").drop("month")
    (row,) = yearly_summary(january, ranking, YEARLY).collect()
    assert (row.year, row.forecast, row.models_used) == (2020, 30.0, 3)


def test_variables_to_columns_and_back(spark):
    df = spark.sql("select array('a', 'b') as v union all select null")
    wide = df.select(*variables_to_columns(F.col("v")))
    assert {tuple(r) for r in wide.collect()} == {("a", "b", "", "", ""), ("",) * 5}
    back = wide.select(columns_to_variables(wide, ["b", "c"]).alias("v")).collect()
    assert sorted(r.v for r in back) == [[], ["b"]]


def test_stack_fills_missing_columns(spark):
    got = stack([spark.sql("select 1 a"), spark.sql("select 2 a, 3 b")]).collect()
    assert {tuple(r) for r in got} == {(1, None), (2, 3)}
