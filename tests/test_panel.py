import pytest
from pyspark.sql import functions as F

from loomcast import MONTHLY, YEARLY
from loomcast.operators.features import add_calendar_features, add_history_features, drop_incomplete
from loomcast.operators.grid import calendar_grid, densify, pair_keys
from loomcast.operators.integrate import (
    fill_gaps,
    fold_indicators,
    repeated_rows,
    roll_up_years,
    scale,
    share_of,
)
from loomcast.operators.reshape import columns_first, first_of_each_name, unpivot_years
from loomcast.operators.split import last_value_forecast, split_at, split_last
from loomcast.plans.prepare import features_monthly, features_yearly, master_monthly, master_yearly
from loomcast.spec import candidates, drop_history_features, future_candidates

from .conftest import as_dict, plan_of

CELL = ("product", "country", "year", "month")


def test_first_of_colliding_columns_stays(spark):
    df = spark.sql("select 1 as a, 2 as A, 3 as b, 4 as b")
    assert [tuple(r) for r in first_of_each_name(df, ["a", "A", "b", "b"]).collect()] == [(1, 3)]
    assert columns_first(spark.sql("select 1 x, 2 y, 3 z"), ["z", "nope", "x"]).columns == ["z", "x", "y"]


def test_unpivot_takes_only_years_in_range(spark):
    df = spark.sql("select 'a' as k, 1 as `2010`, 2 as `2011`, 3 as `20111`, 4 as `2012`")
    assert {(r.year, r.v) for r in unpivot_years(df, ["k"], "v", 2011, 2024).collect()} == {(2011, 2), (2012, 4)}


def test_grid_has_every_combination_once(make, monthly):
    left, right = make("p string", [(f"p{i}",) for i in range(7)]), make("c string", [(f"c{i}",) for i in range(9)])
    pairs = pair_keys(left, right, 5, 3)
    assert pairs.count() == pairs.distinct().count() == 63
    assert "CartesianProduct" not in plan_of(pairs) and "NestedLoop" not in plan_of(pairs)
    seen = monthly({("a-b", "X"): [1.0], ("c", "Y Z"): [2.0, 3.0], ("d", None): [4.0]})
    assert calendar_grid(seen, MONTHLY, 2011, 2013).count() == 3 * 2 * 36
    dense = densify(seen, MONTHLY, 2011, 2012)
    assert dense.count() == 2 * 2 * 24 and dense.filter("value is not null").count() == 3
    assert densify(seen, MONTHLY, 2011, 2012, pairs="observed").count() == 2 * 24


def test_fold_averages_repeated_rows_and_counts_them(make):
    a = make("country string, year int, a double", [("X", 1, 1.0), ("X", 1, 3.0), ("Y", 1, None)])
    b = make("country string, year int, b double", [("X", 2, 5.0)])
    got = {(r.country, r.year): (r.a, r.b) for r in fold_indicators({"a": a, "b": b}).collect()}
    assert got == {("X", 1): (2.0, None), ("Y", 1): (None, None), ("X", 2): (None, 5.0)}
    assert {r.variable: r.repeated for r in repeated_rows({"a": a, "b": b}).collect()} == {"a": 1, "b": 0}


def test_fill_stays_inside_the_group_and_is_idempotent(make):
    rows = [("X", y, None, 1.0) for y in range(4)]
    rows += [("Y", 0, None, 1.0), ("Y", 1, 5.0, 1.0), ("Y", 2, None, 1.0), ("Y", 3, 7.0, 1.0)]
    df = make("country string, year int, v double, w double", rows)
    once = fill_gaps(df, ["country"], ["year"], ["v", "w"])
    got = as_dict(once, ("country", "year"), "v")
    assert [got["X", y] for y in range(4)] == [None] * 4
    assert [got["Y", y] for y in range(4)] == [5.0, 5.0, 5.0, 7.0]
    assert as_dict(fill_gaps(once, ["country"], ["year"], ["v", "w"]), ("country", "year"), "v") == got
    assert plan_of(once).count("Exchange") == 1


def test_scale_uses_population_deviation_and_keeps_constants(make):
    df = make("country string, year int, x double, k double", [("X", 1, 1.0, 4.0), ("X", 2, 3.0, 4.0), ("Y", 1, None, 4.0)])
    got = {(r.country, r.year): (r.x_norm, r.k_norm) for r in scale(df, ["x", "k"]).collect()}
    assert got == {("X", 1): (-1.0, 0.0), ("X", 2): (1.0, 0.0), ("Y", 1): (None, 0.0)}
    early = {(r.country, r.year): r.x_norm for r in scale(df, ["x"], (1, 1)).collect()}
    assert early[("X", 2)] == 2.0
    assert "NestedLoop" not in plan_of(scale(df, ["x"])) and "Cartesian" not in plan_of(scale(df, ["x"]))


def test_derived_share(make):
    assert make("a double, b double", [(50.0, 8.0)]).select(share_of(F.col("a"), F.col("b"))).first()[0] == 4.0


def test_year_roll_up(make):
    schema = "product string, country string, year int, month int, value double, x double, code string"
    rows = [("p", "X", 1, m, float(m) if m > 6 else None, float(m), "C" if m > 6 else None) for m in range(1, 13)]
    rows += [("p", "X", 2, m, None, 1.0, None) for m in range(1, 13)] + [("p", None, 1, 1, 9.0, 1.0, None)]
    df = make(schema, rows)
    keep = {r.year: r for r in roll_up_years(df, MONTHLY, ["x"], ["code"]).collect()}
    assert (keep[1].value, keep[1].x, keep[1].code) == (57.0, 6.5, "C")
    assert (keep[2].value, keep[2].code) == (None, None) and len(keep) == 2
    zero = {r.year: r.value for r in roll_up_years(df, MONTHLY, empty_sum="zero").collect()}
    assert zero == {1: 57.0, 2: 0.0}


def test_calendar_features(monthly):
    df = add_calendar_features(monthly({("p", "X"): range(12)}))
    assert [(r.quarter, r.is_year_end) for r in df.orderBy("month").collect()] == [
        (q, int(q == 4 and i == 2)) for q in range(1, 5) for i in range(3)
    ]
    assert add_calendar_features(df.select("year")).columns == ["year"]


def test_lags_and_means(monthly):
    values = [1.0, None, 3.0, 4.0, 5.0]
    df = add_history_features(monthly({("p", "X"): values}), MONTHLY, lags=(1, 2), windows=(3,))
    rows = df.orderBy("month").collect()
    assert [r.value_lag_1 for r in rows] == [None, 1.0, None, 3.0, 4.0]
    assert [r.value_lag_2 for r in rows] == [None, None, 1.0, None, 3.0]
    assert [r.value_rollmean_3 for r in rows] == [1.0, 1.0, 2.0, 3.5, 4.0]
    past = add_history_features(monthly({("p", "X"): values}), MONTHLY, lags=(), windows=(3,), include_current=False)
    assert [r.value_rollmean_3 for r in past.orderBy("month").collect()] == [None, 1.0, 1.0, 2.0, 3.5]


def test_history_features_share_one_shuffle(monthly):
    assert plan_of(add_history_features(monthly({("p", "X"): [1.0]}), MONTHLY)).count("Exchange") == 1


def test_lag_of_lag_is_a_longer_lag(monthly):
    df = monthly({("p", "X"): range(20), ("q", "X"): range(20, 40)})
    one = add_history_features(df, MONTHLY, lags=(2, 5), windows=())
    moved = one.select(*CELL, F.col("value_lag_2").alias("value"), F.col("value_lag_5").alias("wanted"))
    two = add_history_features(moved, MONTHLY, lags=(3,), windows=())
    assert two.filter("not (value_lag_3 <=> wanted)").count() == 0


@pytest.mark.parametrize("include_current", [True, False])
def test_blocks_change_nothing(monthly, include_current):
    df = monthly({("p", "X"): [float(i * i % 17) for i in range(100)], ("q", "Y"): [None, 1.0] * 50})
    whole = add_history_features(df, MONTHLY, include_current=include_current)
    cut = add_history_features(df, MONTHLY, include_current=include_current, block=13)
    assert whole.exceptAll(cut.select(whole.columns)).count() == 0 and cut.count() == whole.count()


def test_incomplete_rows(make):
    rows = [(1.0, 1.0), (1.0, None), (1.0, float("inf")), (1.0, float("nan")), (None, None)]
    df = make("value double, x double", rows)
    assert drop_incomplete(df, MONTHLY, ["x"]).count() == 2


def test_split_holds_out_the_last_observed_periods(monthly):
    long = [float(i) for i in range(14)]
    long[13] = None
    df = split_last(monthly({("p", "X"): long, ("q", "X"): [1.0, 2.0]}), MONTHLY)
    rows = df.filter("product = 'p'").orderBy("year", "month").collect()
    assert [r.split for r in rows] == ["train"] + ["test"] * 12
    assert [r.step for r in rows] == [None, *range(1, 13)]
    short = df.filter("product = 'q'").orderBy("month").collect()
    assert [(r.split, r.step) for r in short] == [("test", 1), ("test", 2)]
    assert plan_of(df).count("Exchange") == 1


def test_split_at_cutoff(monthly):
    df = split_at(monthly({("p", "X"): range(36)}), MONTHLY, 2012, 2012)
    assert df.count() == 24
    assert [r.step for r in df.filter("split = 'test'").orderBy("month").collect()] == list(range(1, 13))
    yearly = split_at(df.select("product", "country", "year", "value"), YEARLY, 2012)
    assert {r.step for r in yearly.filter("split = 'test'").collect()} == {1}


def test_last_value_forecasts(monthly):
    df = split_last(monthly({("p", "X"): range(36)}), MONTHLY)
    rows = last_value_forecast(df, MONTHLY).orderBy("month").collect()
    assert [r.naive for r in rows] == [23.0] * 12
    assert [r.seasonal_naive for r in rows] == [float(12 + i) for i in range(12)]


def test_column_patterns(spark):
    names = "product country year month value flag_x value_lag_3 value_rollmean_6 quarter x_norm x"
    df = spark.createDataFrame([], ", ".join(f"`{n}` double" for n in names.split()))
    assert candidates(df, MONTHLY) == ["value_lag_3", "value_rollmean_6", "quarter", "x_norm"]
    assert candidates(df, MONTHLY, history=False) == ["quarter", "x_norm"]
    assert candidates(df, YEARLY) == ["month", "flag_x", "value_lag_3", "value_rollmean_6", "quarter", "x_norm", "x"]
    assert "flag_x" in drop_history_features(df).columns and "value_lag_3" not in drop_history_features(df).columns
    wide = df.withColumnRenamed("value_lag_3", "value_lag_1")
    assert future_candidates(wide, "rf", ("x",)) == ["value_lag_1", "x_norm", "x"]
    assert future_candidates(wide, "sarimax", ("x",)) == ["x_norm", "x"]


def test_preparation_end_to_end(make, monthly):
    sales = monthly({("a-b", "X"): range(1, 25), ("a-b", "Y"): range(1, 13)}).withColumn(
        "country_actual", F.concat(F.lit("C_"), "country")
    )
    usage = make("country string, year int, usage double", [("X", 2011, 50.0), ("Y", 2012, 20.0), ("Z", 2011, 1.0)])
    people = make("country string, year int, people double", [("X", 2011, 10.0), ("X", 2012, 30.0), ("Y", 2011, 10.0)])
    master = master_monthly(
        sales, {"usage": usage, "people": people}, 2011, 2012, {"users": ("usage", "people")}, ["usage"]
    )
    assert master.columns[:6] == ["product", "country", "country_actual", "year", "month", "value"]
    assert master.count() == 48 and "usage_norm" not in master.columns
    first = {(r.country, r.year): r for r in master.filter("month = 1").collect()}
    assert first["X", 2012].usage == 50.0 and first["X", 2012].users == 5.0
    assert first["Y", 2011].usage == 20.0 and first["Y", 2011].users is None
    assert first["X", 2012].people_norm == pytest.approx(3**0.5)
    features = features_monthly(master.drop("users", "users_norm"))
    assert features.filter("country = 'X' and value is not null").count() == 12
    assert features.filter("country = 'Y' and value is null").count() == 12
    yearly = master_yearly(master)
    assert {(r.country, r.year): (r.value, r.country_actual) for r in yearly.collect()} == {
        ("X", 2011): (78.0, "C_X"),
        ("X", 2012): (222.0, "C_X"),
        ("Y", 2011): (78.0, "C_Y"),
        ("Y", 2012): (None, None),
    }
    assert features_yearly(yearly).count() == 2
