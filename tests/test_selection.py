import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY
from loomcast.functions.fdist import f_upper_tail, regularised_beta
from loomcast.operators.selection import (
    causality_scores,
    causality_tests,
    choose,
    long_form,
    mutual_information,
    select_variables,
    tree_importance,
    varying,
    without_gaps,
)

KEYS = MONTHLY.keys


@pytest.fixture(scope="module")
def train(monthly):
    rng = np.random.default_rng(7)
    x = rng.normal(size=49)
    lead = [10.0] + [10 + 3 * v for v in x[:-1]] + []
    df = monthly({("p", "X"): lead[:48], ("q", "X"): [float(v) for v in range(48)]})
    table = F.create_map(*[F.lit(v) for i, e in enumerate(x[:48]) for v in (i, float(e))])
    i = (MONTHLY.index() - 2011 * 12).cast("int")
    noise = F.create_map(*[F.lit(v) for k, e in enumerate(rng.normal(size=48)) for v in (k, float(e))])
    return df.withColumns(
        {
            "lead_norm": table[i],
            "noise_norm": noise[i],
            "fixed_norm": F.lit(2.0),
            "copy_norm": F.col("value") * 2,
            "gone_norm": F.lit(None).cast("double"),
        }
    ).persist()


NAMES = ["lead_norm", "noise_norm", "fixed_norm", "copy_norm", "gone_norm"]


def test_constant_and_missing_candidates_drop_out(train):
    usable = varying(long_form(train, MONTHLY, NAMES), MONTHLY).collect()
    assert {r.variable for r in usable if r["product"] == "p"} == {"lead_norm", "noise_norm", "copy_norm"}


def test_f_tail_matches_known_values(make):
    # Upper 5 % and 1 % points of the F distribution from printed tables.
    cases = [(4.9646, 1, 10, 0.05), (3.0983, 3, 20, 0.05), (5.8489, 2, 20, 0.01), (0.0, 2, 5, 1.0)]
    df = make("f double, a double, b double, p double", [(f, float(a), float(b), p) for f, a, b, p in cases])
    for r in df.withColumn("tail", f_upper_tail("f", "a", "b")).collect():
        assert r.tail == pytest.approx(r.p, abs=2e-5)
    bad = make("f double, a double, b double", [(None, 1.0, 1.0), (1.0, 1.0, 0.0)])
    assert [r[0] for r in bad.select(f_upper_tail("f", "a", "b")).collect()] == [None, None]


def test_beta_against_numeric_integration():
    grid = (np.arange(200_000) + 0.5) / 200_000
    for a, b, x in ((2.5, 1.5, 0.3), (4.0, 6.0, 0.7), (1.0, 3.0, 0.1)):
        density = grid ** (a - 1) * (1 - grid) ** (b - 1)
        share = density[grid < x].sum() / density.sum()
        assert regularised_beta(np.array([x]), np.array([a]), np.array([b]))[0] == pytest.approx(share, abs=1e-4)


def test_causality_statistic_matches_a_direct_fit(train):
    got = {
        (r.variable, r.lags): r
        for r in causality_tests(long_form(train, MONTHLY, ["lead_norm", "noise_norm"]), MONTHLY)
        .filter("product = 'p'")
        .collect()
    }
    rows = train.filter("product = 'p'").orderBy("year", "month").collect()
    y = np.array([r.value for r in rows])
    for name in ("lead_norm", "noise_norm"):
        x = np.array([r[name] for r in rows])
        for lags in (1, 2, 3):
            own = [y[lags - k : len(y) - k] for k in range(1, lags + 1)]
            other = [x[lags - k : len(x) - k] for k in range(1, lags + 1)]
            ones = np.ones(len(y) - lags)

            def rss(columns):
                m = np.column_stack([ones, *columns])
                return ((y[lags:] - m @ np.linalg.lstsq(m, y[lags:], rcond=None)[0]) ** 2).sum()

            without, both = rss(own), rss(own + other)
            n = len(y) - lags
            r = got[name, lags]
            assert r.n == n
            if name == "noise_norm":
                f = ((without - both) / lags) / (both / (n - 2 * lags - 1))
                assert r.f == pytest.approx(f, rel=1e-6)
            else:
                assert r.p_value < 1e-6


def test_causality_needs_enough_rows(train):
    few = train.filter("year = 2011 and month <= 10")
    assert causality_scores(long_form(few, MONTHLY, ["lead_norm"]), MONTHLY).count() == 0


def test_information_of_a_copy_is_the_entropy_of_the_bins(train):
    scores = {
        (r["product"], r.variable): r.score
        for r in mutual_information(long_form(train, MONTHLY, NAMES), MONTHLY).collect()
    }
    assert scores["p", "copy_norm"] == pytest.approx(math.log(4))
    assert 0 <= scores["p", "noise_norm"] < scores["p", "copy_norm"]


def test_choice_order_fallback_and_limit(make):
    keys = [("p", "X"), ("q", "X")]
    usable = make(
        "product string, country string, variable string, ordinal int",
        [(*k, f"v{i}", i) for k in keys for i in range(1, 8)],
    )
    scores = make(
        "product string, country string, variable string, score double",
        [("p", "X", f"v{i}", float(i)) for i in range(1, 8)] + [("q", "X", "v3", 0.0)],
    )
    best = {r["product"]: r.exo_vars for r in choose(usable, scores, MONTHLY).collect()}
    assert best == {"p": ["v7", "v6", "v5", "v4", "v3"], "q": ["v1", "v2", "v3", "v4", "v5"]}
    low = {r["product"]: r.exo_vars for r in choose(usable, scores, MONTHLY, True, False).collect()}
    assert low == {"p": ["v1", "v2", "v3", "v4", "v5"], "q": ["v3"]}


def test_forest_importance_prefers_the_copy(train):
    rows = tree_importance(train, MONTHLY, ["lead_norm", "noise_norm", "copy_norm"], rounds=5, depth=4).collect()
    scores = {r.variable: r.score for r in rows if r["product"] == "p"}
    assert max(scores, key=scores.get) == "copy_norm" and sum(scores.values()) == pytest.approx(1)


def test_each_model_gets_its_variables(train):
    chosen = select_variables(train, MONTHLY, NAMES, NAMES[:2], importance_rounds=3)
    first = {m: {r["product"]: r.exo_vars for r in df.collect()} for m, df in chosen.items()}
    assert set(first) == {"sarimax", "prophet", "rf", "xgb", "lgb"}
    assert first["sarimax"]["p"][0] == "lead_norm"
    assert first["prophet"]["p"][0] == "copy_norm" == first["xgb"]["p"][0]
    assert first["lgb"]["p"] == ["lead_norm", "noise_norm", "copy_norm"]


def test_variables_with_gaps_leave_the_selection(make):
    rows = make("product string, country string, a double, b double, c double", [("p", "X", 1.0, None, None), ("p", "X", 1.0, 2.0, None)])
    chosen = make("product string, country string, exo_vars array<string>", [("p", "X", ["c", "b", "a"]), ("q", "X", ["a"])])
    for rule, expected in (("any", ["a"]), ("all", ["b", "a"])):
        got = {r["product"]: r.exo_vars for r in without_gaps(chosen, rows, MONTHLY, ["a", "b", "c"], rule).collect()}
        assert got == {"p": expected, "q": ["a"]}
