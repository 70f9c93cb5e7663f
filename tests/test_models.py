import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY, YEARLY
from loomcast.operators.models import MODELS, fit_model, predictions
from loomcast.operators.models.base import default_selection
from loomcast.operators.models.leastsq import fit_groups, solve_centred
from loomcast.operators.models.smoothing import smooth
from loomcast.operators.models.storage import load_fitted, save_fitted
from loomcast.operators.split import split_last

SEASON = [0, 3, -2, 5, 1, -4, 2, 0, -1, 6, -5, -5]


def pattern(n, slope=0.5, base=100.0):
    return [base + slope * i + SEASON[i % 12] for i in range(n)]


@pytest.fixture(scope="module")
def frame(monthly):
    x = [math.sin(i * i) for i in range(60)]
    series = {
        ("clean-1", "New Land"): pattern(60),
        ("flat", "X"): [7.0] * 60,
        ("driven", "X"): [v + 10 * e for v, e in zip(pattern(60, 0.2), x)],
        ("short", "X"): pattern(17),
        ("tiny", "X"): [3.0] * 13,
        ("none", "X"): [1.0] * 5,
    }
    df = split_last(monthly(series), MONTHLY).withColumn("t", MONTHLY.index())
    i = (F.col("t") - 2011 * 12).cast("double")
    return df.withColumn("x_norm", F.sin(i * i)).persist()


def errors(fitted, frame, product, split="test"):
    rows = predictions(fitted, frame).filter((F.col("product") == product) & (F.col("split") == split))
    return [abs(r.actual - r.predicted) if r.predicted is not None else None for r in rows.collect()]


@pytest.mark.parametrize("model", ["exp_smoothing", "sarimax", "prophet"])
def test_trend_and_season_are_recovered(frame, model):
    options = {"order": 6, "ridge": 1e-9} if model == "prophet" else {}
    fitted = fit_model(model, frame, MONTHLY, **options)
    assert max(errors(fitted, frame, "clean-1")) < 0.2
    assert max(errors(fitted, frame, "flat")) < 1e-6


@pytest.mark.parametrize("model", ["sarimax", "prophet"])
def test_a_driving_variable_is_found(frame, model):
    chosen = default_selection(frame, MONTHLY, ["x_norm"])
    options = {"order": 6, "ridge": 1e-9} if model == "prophet" else {}
    fitted = fit_model(model, frame, MONTHLY, ["x_norm"], chosen, **options)
    row = fitted.parameters.filter("product = 'driven'").first()
    assert row.coefficients["x_norm"] == pytest.approx(10, abs=0.2)
    assert max(errors(fitted, frame, "driven")) < 1.0


def test_short_series_have_a_status_and_never_fail(frame):
    status = {}
    for model in ("exp_smoothing", "sarimax", "prophet", "naive"):
        rows = fit_model(model, frame, MONTHLY).parameters.select("product", "status").collect()
        status[model] = {r["product"]: r["status"] for r in rows}
    assert status["exp_smoothing"]["clean-1"] == "ok"
    assert status["exp_smoothing"]["short"] == "no_season"
    assert status["exp_smoothing"]["tiny"] == "too_short"
    assert status["sarimax"]["short"] == "no_season" and status["sarimax"]["tiny"] == "too_short"
    assert status["naive"]["none"] == "too_short"
    assert status["prophet"]["none"] == "too_short"


def test_in_sample_rows_of_smoothing_are_fitted_values(frame):
    inside = errors(fit_model("exp_smoothing", frame, MONTHLY), frame, "clean-1", "train")
    known = [e for e in inside if e is not None]
    assert len(inside) == 48 and len(known) == 36 and max(known) < 0.2


def test_smoothing_step_by_hand():
    y = np.array([[1.0, 2.0, 3.0, 5.0]])
    out = smooth(y, 2, np.array([[0.5, 0.5, 0.5]]), 1)
    level, trend = 2.0, 1.0
    for v in (3.0, 5.0):
        new = 0.5 * v + 0.5 * (level + trend)
        trend = 0.5 * (new - level) + 0.5 * trend
        level = new
    assert out["path"][0, 4:] == pytest.approx([level + trend, level + 2 * trend])
    assert out["sse"][0] == pytest.approx(0.0 + 1.0)


def test_smoothing_passes_over_missing_periods(make):
    nan = float("nan")
    y = np.array([[1.0, nan, 5.0, nan, 8.0]])
    out = smooth(y, 1, np.array([[0.5, 0.5, 0.5]]), 1)
    level, trend = 5.0 + 2.0, 2.0  # moved on over the fourth period
    new = 0.5 * 8.0 + 0.5 * (level + trend)
    trend = 0.5 * (new - level) + 0.5 * trend
    assert out["path"][0, 5] == pytest.approx(new + trend) and out["sse"][0] == pytest.approx((8.0 - 9.0) ** 2)
    # gaps inside, over a year's end and before the horizon leave season and trend in place
    cells = [(i, v) for i, v in enumerate(pattern(72)) if i not in (30, 31, 59)]
    rows = [("p", "X", 2011 + i // 12, i % 12 + 1, float(v)) for i, v in cells]
    df = split_last(make("product string, country string, year int, month int, value double", rows), MONTHLY)
    df = df.withColumn("t", MONTHLY.index())
    assert max(errors(fit_model("exp_smoothing", df, MONTHLY), df, "p")) < 0.2


def test_least_squares_matches_numpy(make):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 3)) * [1, 100, 1e4] + [0, 1e3, 1e6]
    y = 4 + x @ [2.0, -0.5, 0.01] + rng.normal(size=50)
    rows = [("g", *map(float, r), float(v)) for r, v in zip(x, y)]
    df = make("g string, a double, b double, c double, y double", rows)
    beta = fit_groups(df, ["g"], [F.col(c) for c in "abc"], F.col("y"), 0.0).first().beta
    expected = np.linalg.lstsq(np.column_stack([np.ones(50), x]), y, rcond=None)[0]
    assert beta == pytest.approx(list(expected), rel=1e-6)


def test_copies_and_constants_stay_solvable():
    z = np.arange(10.0)
    cols = [z, z, np.full(10, 3.0), 2 * z + 1]
    sums = [10.0] + [c.sum() for c in cols]
    sums += [(cols[i] * cols[j]).sum() for i in range(4) for j in range(i, 4)]
    beta = solve_centred(np.array([sums]), 3, 1e-6)[0]
    assert beta[3] == 0 and beta[1] + beta[2] == pytest.approx(2, abs=1e-4)


def test_trees_learn_and_persist(spark, frame, tmp_path):
    rows = frame.withColumn("value_lag_1", F.lag("value").over(MONTHLY.ordered()))
    for model, options in (("rf", {"rounds": 8, "depth": 4}), ("lgb", {"rounds": 4, "depth": 3})):
        fitted = fit_model(model, rows, MONTHLY, ["value_lag_1", "x_norm"], **options)
        made = predictions(fitted, rows).filter("product = 'clean-1' and split = 'test'")
        assert made.select(F.avg(F.abs(F.col("actual") - F.col("predicted")))).first()[0] < 30
        save_fitted(fitted, str(tmp_path / model))
        again = predictions(load_fitted(spark, str(tmp_path / model), MONTHLY), rows)
        assert again.exceptAll(predictions(fitted, rows)).count() == 0 and again.count() == rows.count()


@pytest.mark.parametrize("model", ["exp_smoothing", "prophet"])
def test_saved_models_predict_the_same(spark, frame, tmp_path, model):
    fitted = fit_model(model, frame, MONTHLY, ["x_norm"], default_selection(frame, MONTHLY, ["x_norm"]))
    save_fitted(fitted, str(tmp_path / "m"))
    again = load_fitted(spark, str(tmp_path / "m"), MONTHLY)
    assert (again.name, again.baseline) == (fitted.name, fitted.baseline)
    assert predictions(again, frame).exceptAll(predictions(fitted, frame)).count() == 0


def test_incomplete_inputs_give_null_and_empty_training_gives_no_forest(frame):
    rows = frame.withColumn("gap", F.when(F.col("product") == "flat", F.lit(None).cast("double")).otherwise(1.0))
    fitted = fit_model("rf", rows, MONTHLY, ["gap"], rounds=2, depth=2)
    made = predictions(fitted, rows)
    assert made.filter("product = 'flat' and (predicted is not null or status <> 'incomplete')").count() == 0
    assert made.filter("product = 'none' and status <> 'too_short'").count() == 0
    nothing = fit_model("rf", rows.withColumn("gap", F.lit(None).cast("double")), MONTHLY, ["gap"], rounds=2)
    made = predictions(nothing, rows)
    assert made.count() == rows.count() and made.filter("predicted is not null or status = 'ok'").count() == 0


def test_unknown_model_gives_none(frame):
    assert fit_model("oracle", frame, MONTHLY) is None
    assert set(MODELS) == {"sarimax", "exp_smoothing", "prophet", "rf", "xgb", "lgb", "naive"}


def test_yearly_series(make):
    rows = [("p", "X", 2000 + i, 10.0 + 2 * i) for i in range(9)]
    df = make("product string, country string, year int, value double", rows)
    frame = split_last(df, YEARLY).withColumn("t", YEARLY.index())
    for model in ("exp_smoothing", "sarimax", "prophet"):
        (row,) = predictions(fit_model(model, frame, YEARLY), frame).filter("split = 'test'").collect()
        assert str(row.date) == "2008-01-01" and row.predicted == pytest.approx(26, abs=0.7)
