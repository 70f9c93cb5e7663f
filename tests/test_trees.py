"""Trees against a plain recursive grower, and attributions against all coalitions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY
from loomcast.operators.models import fit_model, predictions
from loomcast.operators.models.base import default_selection
from loomcast.operators.models.growing import Growth, attributed, boosted, forest_of, grow, leaves, predicted
from loomcast.operators.split import split_last


def plain_tree(x, g, h, how, depth=0):
    """(value) or (variable, threshold, left, right), splitting rows with curvature one after the other."""
    total_g, total_h = g.sum(), h.sum()
    score = lambda a, b: a * a / (b + how.penalty)
    best = (1e-12 * max(1.0, score(total_g, total_h)), None)
    if how.depth is None or depth < how.depth:
        for f in range(x.shape[1]):
            for v in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= v
                sides = [(g[s].sum(), h[s].sum(), (h[s] > 0).sum()) for s in (left, ~left)]
                if min(n for *_, n in sides) < how.least_rows or min(b for _, b, _ in sides) < max(how.least_curvature, 1e-12):
                    continue
                gain = sum(score(a, b) for a, b, _ in sides) - score(total_g, total_h)
                if gain > best[0] + 1e-9:
                    best = (gain, (f, v))
    if best[1] is None:
        return -total_g / (total_h + how.penalty)
    f, v = best[1]
    left = x[:, f] <= v
    return f, v, plain_tree(x[left], g[left], h[left], how, depth + 1), plain_tree(x[~left], g[~left], h[~left], how, depth + 1)


def follow(tree, row):
    while isinstance(tree, tuple):
        f, v, left, right = tree
        tree = left if row[f] <= v else right
    return tree


def data(seed, n=60, variables=4, digits=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, variables)), digits)
    x[:, -1] = 1.0
    return x, x[:, 0] * 3 + (x[:, min(1, variables - 1)] > 0) * 5 + rng.normal(size=n)


GROWTHS = [Growth(), Growth(depth=2), Growth(penalty=1.0, least_curvature=1.0, depth=4), Growth(least_rows=8), Growth(depth=0)]


@pytest.mark.parametrize("how", GROWTHS)
def test_trees_equal_plain_ones(how):
    made = [data(s, n) for s, n in ((1, 60), (2, 41), (3, 12))]
    x, y, w = np.zeros((3, 60, 4)), np.zeros((3, 60)), np.zeros((3, 60))
    rng = np.random.default_rng(9)
    for i, (own_x, own_y) in enumerate(made):
        x[i, : len(own_y)], y[i, : len(own_y)] = own_x, own_y
        w[i, : len(own_y)] = rng.integers(0, 3, len(own_y))
    got = boosted(x, y, w, 1, 1.0, how)
    for i in range(3):
        used = w[i] > 0
        base = (y[i] * w[i]).sum() / w[i].sum()
        tree = plain_tree(x[i][used], ((base - y[i]) * w[i])[used], w[i][used], how)
        want = [base + follow(tree, row) for row in x[i][used]]
        assert predicted(got[i], x[i][used]) == pytest.approx(want)


def test_leaf_by_leaf_takes_the_largest_gain_first():
    x, y = data(4)
    one = np.ones((1, 60))
    whole = grow(x[None], np.zeros(1, int), -y[None], one, Growth())
    for most in (2, 3, 5, 9):
        tree = grow(x[None], np.zeros(1, int), -y[None], one, Growth(leaves=most))
        size = int(tree["size"][0])
        assert (size + 1) // 2 == most
        inner = tree["feature"][0, :size] >= 0
        gains = tree["gain"][0, :size][inner]
        assert gains.min() >= 0 and gains.max() == pytest.approx(whole["gain"].max())
    few = grow(x[None], np.zeros(1, int), -y[None], one, Growth(leaves=31, least_rows=20))
    assert few["cover"][0, : few["size"][0]].min() >= 20


def test_rounds_add_up():
    x, y = data(5)
    how = Growth(penalty=1.0, depth=3)
    many = boosted(x[None], y[None], np.ones((1, 60)), 3, 0.3, how)[0]
    now = np.full(60, y.mean())
    for _ in range(3):
        tree = plain_tree(x, now - y, np.ones(60), how)
        now = now + 0.3 * np.array([follow(tree, row) for row in x])
    assert predicted(many, x) == pytest.approx(now)


def expectation(forest, row, members):
    """Value of a forest where only the members are known: other splits go both ways by cover."""

    def walk(i):
        f = forest["feature"][i]
        if f < 0:
            return forest["value"][i]
        left, right = forest["left"][i], forest["right"][i]
        if f in members:
            return walk(left if row[f] <= forest["threshold"][i] else right)
        return (forest["cover"][left] * walk(left) + forest["cover"][right] * walk(right)) / forest["cover"][i]

    return forest["base"] + sum(walk(r) for r in forest["roots"])


@pytest.mark.parametrize("variables", [1, 3, 5])
def test_attributions_equal_all_coalitions(variables):
    x, y = data(6, 40, variables + 1)
    x = x[:, :variables]  # without the constant
    draws = np.random.default_rng(2).multinomial(40, np.full(40, 1 / 40), 4)[None]
    for forest in (forest_of(x[None], y[None], np.ones((1, 40)), draws, Growth(depth=5))[0], boosted(x[None], y[None], np.ones((1, 40)), 5, 0.3, Growth(penalty=1.0, depth=3))[0]):
        rows = x[:6]
        got, start = attributed(forest, rows, most=500)
        assert start == pytest.approx(expectation(forest, rows[0], ()))
        for row, parts in zip(rows, got, strict=True):
            for i in range(variables):
                others = [j for j in range(variables) if j != i]
                want = 0.0
                for size in range(variables):
                    weight = factorial(size) * factorial(variables - 1 - size) / factorial(variables)
                    for c in combinations(others, size):
                        want += weight * (expectation(forest, row, {*c, i}) - expectation(forest, row, c))
                assert parts[i] == pytest.approx(want, abs=1e-9)


def test_boxes_of_leaves_hold_each_row_once():
    x, y = data(7)
    forest = boosted(x[None], y[None], np.ones((1, 60)), 1, 1.0, Growth())[0]
    value, low, high, share = leaves(forest, 4)
    inside = ((x[:, None, :] > low) & (x[:, None, :] <= high)).all(axis=2)
    assert (inside.sum(axis=1) == 1).all() and share.prod(axis=1).sum() == pytest.approx(1)


@pytest.fixture(scope="module")
def panel(monthly):
    rng = np.random.default_rng(8)
    series = {(p, "X"): list(rng.normal(size=72).cumsum() + 50) for p in ("a", "b")} | {("e", "X"): list(rng.normal(size=100).cumsum())} | {("c", "X"): [5.0] * 30, ("d", "X"): [1.0] * 5}
    df = split_last(monthly(series), MONTHLY).withColumn("t", MONTHLY.index())
    lag = F.lag("value", 1).over(MONTHLY.ordered())
    return df.withColumns({"value_lag_1": lag, "m_norm": F.col("month") * 1.0, "y_norm": F.col("year") * 1.0}).persist()


@pytest.mark.parametrize("model", ["rf", "xgb", "lgb"])
def test_a_series_does_not_depend_on_others(panel, model):
    names = ["value_lag_1", "m_norm", "y_norm"]
    forecast = lambda df: {(r["product"], r.t): r.predicted for r in predictions(fit_model(model, df, MONTHLY, names, rounds=6), df).collect()}
    every, alone = forecast(panel), forecast(panel.filter("product = 'a'"))
    assert alone and all(every[k] == v for k, v in alone.items())


def test_methods_differ_and_status_says_why(panel):
    names = ["value_lag_1", "m_norm", "y_norm"]
    made = {m: predictions(fit_model(m, panel, MONTHLY, names, rounds=6), panel).filter("split = 'test'").collect() for m in ("rf", "xgb", "lgb")}
    value = {m: {(r["product"], r.t): r.predicted for r in rows if r["product"] in "ab"} for m, rows in made.items()}
    for a, b in combinations(value, 2):
        assert any(abs(value[a][k] - value[b][k]) > 1e-6 for k in value[a])
    status = {(r["product"], r.status) for r in made["xgb"]}
    assert status == {("a", "ok"), ("b", "ok"), ("c", "ok"), ("d", "too_short"), ("d", "incomplete"), ("e", "ok")}
    assert [r.predicted for r in made["rf"] if r["product"] == "c"] == pytest.approx([5.0] * 12)


def test_unchosen_variables_play_no_part(panel):
    names = ["value_lag_1", "m_norm", "y_norm"]
    chosen = default_selection(panel, MONTHLY, ["m_norm"])
    fitted = fit_model("rf", panel, MONTHLY, names, chosen, rounds=4)
    moved = panel.withColumn("y_norm", F.col("y_norm") + 100)
    both = [predictions(fitted, df).select("product", "t", "predicted") for df in (panel, moved)]
    assert both[0].exceptAll(both[1]).count() == 0
    missing = predictions(fitted, panel.withColumn("m_norm", F.lit(None).cast("double"))).filter("predicted is not null")
    assert missing.count() == 0
