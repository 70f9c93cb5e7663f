"""The filter and its likelihood against dense covariances and planted weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY, YEARLY
from loomcast.operators.models import fit_model, predictions
from loomcast.operators.models.arima import fit_arima, plan_fit
from loomcast.operators.models.base import default_selection
from loomcast.operators.models.statespace import Shape, deviance, filtered, fitted, searched
from loomcast.operators.split import split_last


def effects(shape, w, n):
    """Effect of a shock on the differenced series, period after period."""
    ar, ma = (x[0] for x in shape.polynomials(np.array([w])))
    psi = np.zeros(n)
    for j in range(n):
        psi[j] = (ma[j] if j < len(ma) else 0.0) + sum(ar[i] * psi[j - 1 - i] for i in range(len(ar)) if j > i)
    return psi


def planted(shape, w, n, seed, jump=0.0):
    rng = np.random.default_rng(seed)
    psi = effects(shape, w, 400)
    u = np.convolve(rng.normal(size=n + 400), psi)[400 : 400 + n]
    y = np.zeros(n)
    for t in range(n):
        y[t] = u[t] + sum(c * y[t - lag] for lag, c in shape.differences() if t >= lag)
    return y + jump


def dense_covariance(shape, w, n):
    psi = effects(shape, w, 6000)
    own = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n)])
    return own[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]


CASES = [
    (Shape(), (0.5, 0.3, -0.4, -0.5)),
    (Shape(season=4), (-0.3, 0.6, 0.5, 0.2)),
    (Shape((1, 1, 0), (0, 1, 1), 4), (0.6, -0.7)),
    (Shape((0, 1, 1), (0, 0, 0), 0), (0.4,)),
    (Shape((1, 0, 1), (0, 0, 0), 0), (0.8, -0.3)),
]


@pytest.mark.parametrize("shape,w", CASES)
def test_likelihood_equals_the_dense_one(shape, w):
    y = planted(shape, w, 60, 1)
    u = y.copy()
    for t in range(len(y)):
        u[t] = y[t] - sum(c * y[t - lag] for lag, c in shape.differences() if t >= lag)
    u = u[shape.lost :]
    g = dense_covariance(shape, w, len(u))
    rest, logs = u @ np.linalg.solve(g, u), np.linalg.slogdet(g)[1]
    sums, found, n, _ = filtered(shape, np.array([w]), y[None, :, None], np.ones((1, 60), bool))
    assert n[0] == len(u)
    assert sums[0, 0, 0] == pytest.approx(rest, rel=1e-6) and found[0] == pytest.approx(logs, abs=1e-5)


@pytest.mark.parametrize("shape,w", CASES[:4])
def test_missing_periods_and_the_horizon_follow_from_the_dense_joint_distribution(shape, w):
    n = 40
    y = planted(shape, w, n, 2)
    seen = np.ones(n, bool)
    seen[[shape.lost + 3, shape.lost + 4, 25]] = False
    seen[33:] = False
    # levels are linear in unknown start levels and in the differenced series
    lost = shape.lost
    build = np.zeros((n, n))
    build[:lost, :lost] = np.eye(lost)
    for t in range(lost, n):
        build[t, t] = 1
        for lag, c in shape.differences():
            build[t] += c * build[t - lag]
    prior = np.zeros((n, n))
    prior[:lost, :lost] = 1e8 * np.eye(lost)
    prior[lost:, lost:] = dense_covariance(shape, w, n - lost)
    joint = build @ prior @ build.T
    want = joint[:, seen] @ np.linalg.solve(joint[np.ix_(seen, seen)], y[seen])
    _, _, _, made = filtered(shape, np.array([w]), y[None, :, None], seen[None], keep=True)
    assert made[0, 33:, 0] == pytest.approx(want[33:], abs=1e-3 * np.abs(y).max())
    hidden = y.copy()
    hidden[~seen] = 1e9  # what is not seen plays no part
    assert filtered(shape, np.array([w]), hidden[None, :, None], seen[None])[0] == pytest.approx(
        filtered(shape, np.array([w]), y[None, :, None], seen[None])[0]
    )


def test_planted_weights_are_found():
    shape, w = Shape((1, 1, 1), (0, 1, 1), 4), (0.7, 0.4, -0.6)
    y = np.stack([planted(shape, w, 400, s) for s in range(6)])
    found = searched(shape, y[:, :, None], np.ones(y.shape, bool))
    assert np.abs(np.median(found, axis=0) - w).max() < 0.12


def test_search_ends_where_the_likelihood_is_flat():
    shape = Shape(season=4)
    y = np.stack([planted(shape, (0.4, 0.2, -0.3, -0.4), 60, s) for s in range(4)])[:, :, None]
    seen = np.ones(y.shape[:2], bool)
    free = np.arctanh(searched(shape, y, seen) / 0.98)
    at = deviance(shape, free, y, seen)
    for i in range(4):
        for d in (-0.05, 0.05):
            moved = free.copy()
            moved[:, i] += d
            assert (deviance(shape, moved, y, seen) >= at - 5e-4).all()  # 0.015 of log likelihood


def test_regression_weights_and_variance():
    shape = Shape((1, 1, 0), (0, 0, 0), 0)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1, 200, 2)) * [1, 1000]
    y = planted(shape, (0.5,), 200, 5)[None] + x[:, :, 0] * 7 - x[:, :, 1] * 0.01
    got = fitted(shape, y, x, np.ones((1, 200), bool))
    assert got["beta"][0] == pytest.approx([7, -0.01], rel=0.1) and got["sigma2"][0] == pytest.approx(1, rel=0.3)


def test_shapes_that_a_length_supports():
    yearly = Shape(season=4)
    assert plan_fit(yearly, 10, 5) == ("ok", yearly, 0)
    assert plan_fit(yearly, 12, 5) == ("ok", yearly, 2)
    assert plan_fit(yearly, 9, 5) == ("no_season", yearly.without_season(), 5)
    assert plan_fit(yearly, 4, 5) == ("no_season", yearly.without_season(), 0)
    assert plan_fit(yearly, 3, 0)[0] == "too_short"
    assert plan_fit(Shape((0, 1, 0), (0, 0, 0), 0), 2, 0)[0] == "ok"


def test_yearly_series_have_a_season_of_four(make):
    rows = [("p", "X", 2000 + i, 100.0 + 3 * i + [0, 9, -4, 2][i % 4]) for i in range(14)]
    rows += [("gap", "X", y, v) for _, _, y, v in rows if y not in (2004, 2011)]
    df = make("product string, country string, year int, value double", rows)
    frame = split_last(df, YEARLY).withColumn("t", YEARLY.index())
    made = predictions(fit_model("sarimax", frame, YEARLY), frame).filter("split = 'test'").collect()
    assert {r.status for r in made} == {"ok"}
    for r in made:
        assert r.predicted == pytest.approx(100 + 3 * 13 + 9, abs=0.5)


def test_a_gap_in_the_calendar_is_not_a_step(make):
    """Two missing months in the middle and one before the horizon leave season and trend in place."""
    season = [0, 3, -2, 5, 1, -4, 2, 0, -1, 6, -5, -5]
    cells = [(i, 100 + 0.5 * i + season[i % 12]) for i in range(72) if i not in (30, 31, 59)]
    rows = [("p", "X", 2011 + i // 12, i % 12 + 1, float(v)) for i, v in cells]
    frame = split_last(make("product string, country string, year int, month int, value double", rows), MONTHLY)
    frame = frame.withColumn("t", MONTHLY.index())
    made = predictions(fit_arima(frame, MONTHLY), frame).filter("split = 'test'").collect()
    assert len(made) == 12 and max(abs(r.actual - r.predicted) for r in made) < 0.3


def test_missing_and_too_many_variables(monthly):
    df = split_last(monthly({("p", "X"): [float(i % 7) for i in range(60)]}), MONTHLY).withColumn("t", MONTHLY.index())
    df = df.withColumn("x_norm", F.when(F.col("month") != 3, F.col("month") * 0.5)).withColumn("z_norm", F.col("year") * 1.0)
    chosen = default_selection(df, MONTHLY, ["x_norm"])
    made = predictions(fit_arima(df, MONTHLY, ["x_norm", "z_norm"], chosen), df).filter("split = 'test'").collect()
    assert {r.month for r in made if r.predicted is None} == {3} == {r.month for r in made if r.status == "incomplete"}
    with pytest.raises(Exception, match="more than 1 variables"):
        fit_arima(df, MONTHLY, ["x_norm", "z_norm"], default_selection(df, MONTHLY, ["x_norm", "z_norm"]), slots=1).parameters.collect()
