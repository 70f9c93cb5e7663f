"""Back-test, future forecasts and scenarios from end to end on a small panel."""

import math

import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY, YEARLY
from loomcast.operators.features import add_calendar_features, add_history_features
from loomcast.operators.scenario import panel_statistics, scenario_list
from loomcast.plans.backtest import backtest
from loomcast.plans.future import forecast_months, forecast_years, future_frame, seed_forecasts, seeded, top_models
from loomcast.plans.outputs import save_backtest, save_future, save_panel, save_scenarios
from loomcast.plans.prepare import features_monthly, features_yearly
from loomcast.plans.whatif import analyse
from loomcast.session import checkpoint

QUICK = {m: {"rounds": 3, "depth": 3} for m in ("rf", "xgb", "lgb")}
SEASON = [0, 3, -2, 5, 1, -4, 2, 0, -1, 6, -5, -5]


@pytest.fixture(scope="module")
def panel(monthly):
    series = {
        (p, c): [100.0 * k + 0.4 * i + 3 * SEASON[i % 12] + 5 * math.sin(i * k) for i in range(96)]
        for k, (p, c) in enumerate((("a-b", "New Land"), ("a-b", "Y"), ("c", "New Land")), 1)
    }
    series["c", "Y"] = [50.0] * 5 + [None] * 91
    df = monthly(series)
    i = MONTHLY.index().cast("double")
    return df.withColumns({"u_norm": F.sin(i), "v_norm": F.cos(i / 5)})


@pytest.fixture(scope="module")
def features(panel):
    return checkpoint(features_monthly(panel))


@pytest.fixture(scope="module")
def result(features):
    made = backtest(features.filter("year < 2018"), MONTHLY, options=QUICK, importance_rounds=3)
    made.forecasts, made.metrics = checkpoint(made.forecasts), checkpoint(made.metrics)
    return made


def test_backtest_tables(result):
    models = {"sarimax", "exp_smoothing", "prophet", "rf", "xgb", "lgb", "ensemble"}
    metrics = result.metrics.collect()
    assert {r.model for r in metrics} == models and len(metrics) == 3 * 7
    assert all(r.n == 12 and r.mape < 0.5 for r in metrics)
    assert {r.model for r in metrics if r.baseline} == {"exp_smoothing"}
    assert {"exo_var_1", "exo_var_5", "r2"} <= set(result.metrics.columns)
    assert all(r.exo_var_1 == "" for r in metrics if r.model in ("ensemble", "exp_smoothing"))
    assert all(r.exo_var_1 != "" for r in metrics if r.model == "rf")
    assert result.forecasts.select("model", "product", "country", "date").distinct().count() == 3 * 7 * 12
    assert result.forecasts.count() == 3 * 7 * 12
    assert str(result.forecasts.agg(F.min("date")).first()[0]) == "2017-01-01"


def test_saved_results(spark, result, features, tmp_path):
    save_backtest(result, str(tmp_path), per_series=True)
    assert spark.read.parquet(str(tmp_path / "all_metrics")).count() == 21
    assert len(list((tmp_path / "metrics").rglob("*.json"))) == 21
    assert (tmp_path / "predictions" / "model=exp_smoothing" / "product=a-b" / "country=New Land").exists()
    save_panel(features, features, str(tmp_path), "monthly")
    assert (tmp_path / "feature_monthly" / "year=2017").exists()


def test_ensemble_lies_between_its_members(result):
    members = result.forecasts.join(
        result.ranking.select("product", "country", "model"), ["product", "country", "model"]
    )
    bounds = members.groupBy(*MONTHLY.cell).agg(F.min("predicted").alias("lo"), F.max("predicted").alias("hi"))
    joint = result.forecasts.filter("model = 'ensemble'").join(bounds, list(MONTHLY.cell))
    assert joint.count() == 36 and joint.filter("predicted < lo - 1e-9 or predicted > hi + 1e-9").count() == 0


def test_seeds_feed_the_history_features(panel):
    frame = future_frame(add_history_features(add_calendar_features(panel), MONTHLY), MONTHLY, 2018, 2018)
    assert not [c for c in frame.columns if "lag" in c or "rollmean" in c]
    seeds = seed_forecasts(frame, MONTHLY)
    assert seeds.select("product", "country").distinct().count() == 4
    rows = seeded(frame, seeds, MONTHLY, lags=(1, 12), windows=()).filter("product = 'c' and country = 'New Land'")
    got = {(r.year, r.month): r for r in rows.collect()}
    assert got[2018, 1].value_lag_1 == got[2017, 12].value
    assert got[2018, 5].value_lag_12 == got[2017, 5].value
    assert got[2018, 5].value_lag_1 == got[2018, 4].value
    actual = panel.filter("product = 'c' and country = 'New Land' and year = 2018 and month = 4").first().value
    assert got[2018, 4].value != actual


def test_monthly_future(features, result):
    made = forecast_months(features, result.metrics, MONTHLY, 2018, 2018, QUICK)
    table = checkpoint(made.forecasts)
    assert table.filter("split = 'test' and actual is not null").count() == 0
    assert table.filter("not in_ensemble or predicted is null").count() == 0
    ahead = table.filter("split = 'test'").groupBy("product", "country", "model").count().collect()
    assert len(ahead) == 3 * 4 and all(r["count"] == 12 for r in ahead)
    assert table.filter("split = 'train' and model = 'ensemble'").count() > 0
    ranked = top_models(result.metrics, MONTHLY, [])
    own = table.filter("split = 'test' and model <> 'ensemble'").join(
        ranked.select("product", "country", "model", "mape"), ["product", "country", "model"]
    )
    w = 1 / (F.col("mape") + 1e-6)
    mean = own.groupBy(*MONTHLY.cell).agg((F.sum(w * F.col("predicted")) / F.sum(w)).alias("expected"))
    both = table.filter("split = 'test' and model = 'ensemble'").join(mean, list(MONTHLY.cell))
    assert both.count() == 36 and both.filter("abs(predicted - expected) > 1e-6").count() == 0
    assert made.summary.count() == 12


@pytest.fixture(scope="module")
def yearly(make):
    rows = [
        (p, "New Land", 2010 + i, base + 5.0 * i + 2.0 * (i % 3), 1000.0 + 10 * i, (i - 5) / 3.0, math.sin(i))
        for p, base in (("a-b", 100.0), ("c", 300.0), ("d", 50.0))
        for i in range(14)
    ]
    schema = "product string, country string, year int, value double, people double, people_norm double, w_norm double"
    return checkpoint(features_yearly(make(schema, rows)))


@pytest.fixture(scope="module")
def yearly_metrics(yearly):
    return checkpoint(backtest(yearly.filter("year < 2020"), YEARLY, options=QUICK, importance_rounds=3).metrics)


def test_yearly_backtest_falls_back(yearly):
    short = yearly.filter("year < 2014")
    made = backtest(short, YEARLY, options=QUICK, importance_rounds=3)
    status = {(r.model, r.status) for r in made.forecasts.collect()}
    assert ("sarimax", "fallback") in status and ("exp_smoothing", "no_season") in status
    row = made.forecasts.filter("model = 'sarimax' and product = 'd'").first()
    assert row.predicted == short.filter("product = 'd' and year = 2012").first().value
    assert "fallback" in made.metrics.filter("model = 'sarimax' and product = 'd'").first().status
    ranks = {r["product"]: r["rank"] for r in made.ranking.filter("model = 'sarimax'").collect()}
    assert all(rank == 3 for rank in ranks.values())  # behind whatever was fitted
    longer = backtest(yearly.filter("year < 2016"), YEARLY, models=("sarimax", "naive"))
    assert {(r.model, r.status) for r in longer.metrics.collect()} == {("sarimax", "no_season"), ("naive", "ok"), ("ensemble", "ok")}


def test_yearly_future(spark, yearly, yearly_metrics, tmp_path):
    made = forecast_years(yearly, yearly_metrics, YEARLY, 2020, 2023, ("people",), QUICK)
    summary = made.summary.collect()
    assert len(summary) == 3 * 4 and {r.models_used for r in summary} == {3}
    joint = made.forecasts.filter("model = 'ensemble'").collect()
    assert {(r["product"], r.year): r.predicted for r in joint} == {
        (r["product"], r.year): r.forecast for r in summary
    }
    assert all(r.actual is None for r in joint)
    save_future(made, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "forecast_summary")).count() == 12


def test_scenarios_of_the_best_models(spark, yearly, yearly_metrics, tmp_path):
    made = analyse(
        yearly,
        yearly_metrics,
        YEARLY,
        2020,
        2023,
        scenario_list(["people"], [], ["w_norm"]),
        panel_statistics(yearly, ["people"]),
        QUICK,
    )
    rows = made.scenarios.collect()
    key = [(r["product"], r.model, r.testing_column, r.scenario, r.year) for r in rows]
    assert len(set(key)) == len(key) and rows
    assert all(abs(r.forecast - r.scenario_forecast) < 1e-9 for r in rows if r.shift == 0 and r.testing_column == "w_norm")
    assert made.summary.count() == len({k[:4] for k in key})
    assert made.impact.count() == len({k[:3] for k in key})
    assert all(not r.influence_var for r in rows if r.model not in ("rf", "xgb", "lgb"))
    save_scenarios(made, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "comprehensive_scenarios")).count() == len(rows)
