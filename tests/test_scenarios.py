import pytest
from pyspark.sql import functions as F

from loomcast import YEARLY
from loomcast.operators.attribution import (
    attribute,
    influential,
    linear_attribution,
    mean_absolute,
    tree_attribution,
)
from loomcast.operators.models import fit_model
from loomcast.operators.scenario import (
    Scenario,
    flag_influence,
    impact_analysis,
    propagate,
    scenario_list,
    scenario_summary,
    score_scenarios,
    series_statistics,
)
from loomcast.operators.split import split_at

WEIGHTS = {"a_norm": 2.0, "b_norm": -1.0}


@pytest.fixture(scope="module")
def frame(make):
    rows = [
        (p, "New Land", 2015 + i, 10.0 * k + i, 100.0 + i, 4.0, (100.0 + i - 103.0) / 2.0, float(i * k % 3))
        for k, p in enumerate(("a-b", "c"), 1)
        for i in range(7)
    ]
    df = make(
        "product string, country string, year int, value double, a double, c double, a_norm double, b_norm double", rows
    )
    return split_at(df, YEARLY, 2020).withColumn("t", YEARLY.index()).persist()


def scorer(rows):
    return rows.withColumn("predicted", F.col("a_norm") * 2.0 - F.col("b_norm"))


@pytest.fixture(scope="module")
def statistics(make):
    return make("a_mean double, a_std double, c_mean double, c_std double", [(103.0, 2.0, 4.0, 1.0)])


def test_labels():
    made = scenario_list(percent=["a"], point=["b"], scaled=["b_norm"])
    assert len(made) == 33
    labels = [s.label for s in made]
    assert labels[0] == "-25%" and labels[5] == "0%" and labels[10] == "25%"
    assert labels[12] == "-0.2 points" and labels[16] == "+0 points" and labels[17] == "+0.05 points"
    assert labels[-1] == "+0.5 points"


def test_shift_zero_is_the_base_and_shifts_reach_the_scaled_twin(frame, statistics):
    future = frame.filter("split = 'test'")
    table = score_scenarios(future, YEARLY, scenario_list(["a"], ["c"], ["b_norm"]), scorer, statistics).persist()
    assert table.count() == 4 * 33
    assert table.filter("shift = 0 and abs(forecast - scenario_forecast) > 1e-12").count() == 0
    up = table.filter("testing_column = 'a' and scenario = '10%' and year = 2020 and product = 'c'").first()
    assert up.scenario_forecast - up.forecast == pytest.approx(2.0 * 10.5 / 2.0) and up.propagated
    down = table.filter("testing_column = 'b_norm' and scenario = '-0.5 points'").first()
    assert down.scenario_forecast - down.forecast == pytest.approx(0.5) and not down.propagated
    unseen = table.filter("testing_column = 'c' and abs(forecast - scenario_forecast) > 1e-12")
    assert unseen.count() == 0
    summary = scenario_summary(table.withColumn("model", F.lit("m")), YEARLY)
    assert summary.count() == 2 * 33
    assert impact_analysis(table.withColumn("model", F.lit("m")), YEARLY).count() == 2 * 3
    key = ["product", "country", "testing_column", "scenario", "year"]
    assert table.select(key).distinct().count() == table.count()


def test_statistics_per_series(frame):
    stats = series_statistics(frame.filter("split = 'train'"), YEARLY, ["a"])
    row = stats.filter("product = 'c'").first()
    assert row.a_mean == 102.0 and row.a_std == pytest.approx(2.5**0.5)
    moved = frame.filter("year = 2020").withColumns(
        {"testing_column": F.lit("a"), "kind": F.lit("point"), "shift": F.lit(0.0)}
    )
    out = propagate(moved, ["a"], stats, YEARLY.keys).first()
    assert out.a_norm == pytest.approx(3 / 2.5**0.5) and "a_mean" not in out


def test_rows_that_cannot_be_scored_stay_with_null(frame, statistics):
    future = frame.filter("split = 'test'").withColumn(
        "b_norm", F.when(F.col("product") == "c", F.col("b_norm"))
    )
    table = score_scenarios(future, YEARLY, [Scenario("a", "percent", 5)], scorer, statistics)
    assert {(r["product"], r.scenario_forecast is None) for r in table.collect()} == {("a-b", True), ("c", False)}


def test_tree_attribution_sums_to_prediction_minus_expectation(frame):
    names = ["a_norm", "b_norm", "c"]
    fitted = fit_model("rf", frame, YEARLY, names, rounds=5, depth=3)
    made = tree_attribution(fitted, frame).groupBy(*YEARLY.cell).agg(F.sum("attribution").alias("total"))
    both = fitted.explained(frame).join(made, list(YEARLY.cell))
    assert both.count() == 14
    assert both.filter("abs(predicted - expected - total) > 1e-9").count() == 0
    assert attribute(fit_model("naive", frame, YEARLY), frame) is None
    constant = tree_attribution(fitted, frame).filter("variable = 'c' and abs(attribution) > 1e-12")
    assert constant.count() == 0


def test_linear_attribution_and_influence(frame, statistics):
    made = linear_attribution(frame, YEARLY, {n: F.lit(w) for n, w in WEIGHTS.items()})
    row = made.filter("product = 'c' and year = 2021 and variable = 'a_norm'").first()
    assert row.attribution == pytest.approx(2.0 * (1.5 - -0.5))
    top = influential(mean_absolute(made, YEARLY), YEARLY, 1)
    assert {r.variable for r in top.collect()} == {"a_norm"}
    future = frame.filter("split = 'test'")
    table = score_scenarios(future, YEARLY, scenario_list(["a"], [], ["b_norm"]), scorer, statistics)
    flags = {(r.testing_column, r.influence_var) for r in flag_influence(table, top, YEARLY).collect()}
    assert flags == {("a", True), ("b_norm", False)}
    assert flag_influence(table, None, YEARLY).filter("influence_var").count() == 0
