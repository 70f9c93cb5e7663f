"""Scenarios and attribution.

A fixed linear scorer stands in for the fitted model where SQL has to follow.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.forecasting import _metrics
from loomcast.catalog.registry import query
from loomcast.operators.attribution import influential, linear_attribution, mean_absolute, tree_attribution
from loomcast.operators.models import fit_model
from loomcast.operators.scenario import (
    PERCENT_SHIFTS,
    POINT_SHIFTS,
    SCALED_SHIFTS,
    apply_shifts,
    expand,
    flag_influence,
    impact_analysis,
    panel_statistics,
    propagate,
    scenario_list,
    scenario_summary,
    score_scenarios,
    series_statistics,
)
from loomcast.operators.split import split_at
from loomcast.plans.whatif import analyse
from loomcast.session import checkpoint
from loomcast.spec import YEARLY

WEIGHTS = {"active_customers_norm": 250.0, "avg_order_value_norm": -80.0, "urgent_customers_norm": 40.0}
PERCENT = ("active_customers", "urgent_customers")
POINT = ("urgent_pct", "avg_order_value")
NORM = tuple(WEIGHTS)
COLUMNS = ("product", "country", "year", "testing_column", "scenario", "forecast", "scenario_forecast")


def scorer(rows):
    total = F.lit(1000.0)
    for name, weight in WEIGHTS.items():
        total = total + F.col(name) * weight
    return rows.withColumn("predicted", total)


def split_years(spark, folder):
    return split_at(t.yearly_features(spark, folder), YEARLY, t.CUTOFF, t.LAST)


def _values() -> str:
    listed = [(v, "percent", s, f"{s}%") for v in PERCENT for s in PERCENT_SHIFTS]
    listed += [(v, "point", s, f"{s:+} points") for v in POINT for s in POINT_SHIFTS]
    listed += [(v, "scaled", s, f"{s:+} points") for v in NORM for s in SCALED_SHIFTS]
    return ", ".join(f"('{v}', '{k}', {s}::double, '{label}')" for v, k, s, label in listed)


def _shifted(name: str) -> str:
    return (
        f"case when testing_column <> '{name}' then {name} when kind = 'percent' then {name} * (1 + shift / 100) "
        f"else {name} + shift end as {name}"
    )


def _renewed(name: str) -> str:
    return (
        f"case when testing_column = '{name}' then ({name} - {name}_mean) / {name}_std "
        f"else {name}_norm end as {name}_norm"
    )


SCORE = "1000.0::double + " + " + ".join(f"{n} * ({w})" for n, w in WEIGHTS.items())
YEARS = (
    t.WITH_MASTER
    + ", yearly as (select product, country, year, sum(value) as value, "
    + ", ".join(f"avg({c}) as {c}" for c in (*t.ALL_INDICATORS, *NORM))
    + """ from master group by 1, 2, 3),
    lagged as (select *, lag(value) over (partition by product, country order by year) as value_lag_1 from yearly),
    rows_kept as (select * from lagged where value is null or value_lag_1 is not null)"""
)
WITH_SCENARIOS = (
    YEARS
    + f""",
    future as (select * from rows_kept where year >= {t.CUTOFF}),
    shifts(testing_column, kind, shift, scenario) as (values {_values()}),
    moved as (select product, country, year, testing_column, kind, shift, scenario,
      {", ".join(_shifted(c) for c in (*t.ALL_INDICATORS, *NORM))} from future, shifts),
    renewed as (select product, country, year, testing_column, kind, shift, scenario,
      {", ".join(_renewed(c) for c in t.SCALED)}
      from moved, stats),
    scored as (
      select r.product, r.country, r.year, r.testing_column, r.kind, r.scenario, f.forecast,
             {SCORE} as scenario_forecast
      from renewed r join (select product, country, year, {SCORE} as forecast from future) f
        using (product, country, year))
"""
)


def _kind_sql(kind: str) -> str:
    return (
        WITH_SCENARIOS
        + f"""select product, country, year, testing_column, scenario, round(forecast, 6) as forecast,
              round(scenario_forecast, 6) as scenario_forecast from scored where kind = '{kind}'"""
    )


def scored(spark, folder, percent=(), point=(), scaled=()):
    indicators = checkpoint(t.indicator_rows(spark, folder))
    features = t.yearly_features_with(indicators, spark, folder)
    future = split_at(features, YEARLY, t.CUTOFF, t.LAST).filter(F.col("split") == "test")
    scenarios = scenario_list(percent, point, scaled)
    statistics = panel_statistics(indicators, t.SCALED)
    return score_scenarios(checkpoint(future), YEARLY, scenarios, scorer, statistics)


def shown(table):
    return t.rounded(table.select(*COLUMNS), 6, "forecast", "scenario_forecast")


@query("scenario_shift_pct", _kind_sql("percent"))
def scenario_shift_pct(spark, folder):
    return shown(scored(spark, folder, percent=PERCENT))


@query("scenario_shift_point", _kind_sql("point"))
def scenario_shift_point(spark, folder):
    return shown(scored(spark, folder, point=POINT))


@query("scenario_shift_norm", _kind_sql("scaled"))
def scenario_shift_norm(spark, folder):
    return shown(scored(spark, folder, scaled=NORM))


@query(
    "scenario_propagate",
    YEARS
    + f""",
    series_stats as (
      select product, country, avg(active_customers) as m, stddev_samp(active_customers) as s
      from rows_kept where year < {t.CUTOFF} group by 1, 2)
    select product, country, year, round(shift, 2) as shift,
           round(active_customers * (1 + shift / 100), 6) as active_customers,
           round((active_customers * (1 + shift / 100) - m) / nullif(s, 0), 6) as active_customers_norm
    from rows_kept left join series_stats using (product, country),
         (select unnest([{", ".join(f"{s}::double" for s in PERCENT_SHIFTS)}]) as shift)
    where year >= {t.CUTOFF}""",
)
def scenario_propagate(spark, folder):
    """A shift in actual units, scaled again by the statistics of the series."""
    split = checkpoint(split_years(spark, folder))
    statistics = series_statistics(split.filter("split = 'train'"), YEARLY, ["active_customers"])
    future = split.filter("split = 'test'").select(*YEARLY.cell, "active_customers", "active_customers_norm")
    moved = apply_shifts(expand(future, scenario_list(percent=["active_customers"])), ["active_customers"])
    out = propagate(moved, ["active_customers"], statistics, YEARLY.keys)
    kept = out.select(*YEARLY.cell, "shift", "active_customers", "active_customers_norm")
    return t.rounded(t.rounded(kept, 2, "shift"), 6, "active_customers", "active_customers_norm")


def _spread_sql(by: str) -> str:
    return (
        WITH_SCENARIOS
        + f"""select product, country, 'linear' as model, {by}, round(avg(scenario_forecast), 6) as mean,
              round(case when count(scenario_forecast) > 1 then stddev_samp(scenario_forecast) end, 5) as std,
              round(min(scenario_forecast), 6) as min, round(max(scenario_forecast), 6) as max
              from scored group by all"""
    )


def _spread(table):
    return t.rounded(t.rounded(table, 6, "mean", "min", "max"), 5, "std")


def everything(spark, folder):
    return scored(spark, folder, PERCENT, POINT, NORM).withColumn("model", F.lit("linear"))


@query("scenario_summary", _spread_sql("testing_column, scenario"))
def summary(spark, folder):
    return _spread(scenario_summary(everything(spark, folder), YEARLY))


@query("impact_analysis", _spread_sql("testing_column"))
def impact(spark, folder):
    return _spread(impact_analysis(everything(spark, folder), YEARLY))


ATTRIBUTION = (
    YEARS
    + f""",
    typical as (
      select product, country, {", ".join(f"avg({n}) as m_{n}" for n in NORM)}
      from rows_kept where year < {t.CUTOFF} group by 1, 2),
    attributed as ("""
    + " union all ".join(
        f"select product, country, year, case when year >= {t.CUTOFF} then 'test' else 'train' end as split, "
        f"'{n}' as variable, ({w}) * ({n} - m_{n}) as attribution "
        "from rows_kept left join typical using (product, country)"
        for n, w in WEIGHTS.items()
    )
    + ")"
)


def attributed(spark, folder):
    weights = {n: F.lit(w) for n, w in WEIGHTS.items()}
    return linear_attribution(split_years(spark, folder), YEARLY, weights)


@query(
    "attribution_linear",
    ATTRIBUTION
    + "select product, country, year, split, variable, round(attribution, 6) + 0.0::double as attribution from attributed",
)
def attribution_linear(spark, folder):
    # a zero has no sign
    return attributed(spark, folder).withColumn("attribution", F.round("attribution", 6) + F.lit(0.0))


IMPORTANCE = """, importance as (
      select product, country, variable, avg(abs(attribution)) as v from attributed where split = 'test'
      group by 1, 2, 3),
    ordered as (
      select *, row_number() over (partition by product, country order by round(v, 6) desc nulls last, variable) as place
      from importance)"""


def top_drivers(spark, folder, top):
    test = attributed(spark, folder).filter("split = 'test'")
    importance = t.rounded(mean_absolute(test, YEARLY), 6, "mean_abs_attribution")
    return influential(importance, YEARLY, top)


@query(
    "influential_variables",
    ATTRIBUTION
    + IMPORTANCE
    + " select product, country, variable, round(v, 6) as mean_abs_attribution, cast(place as int) as place "
    "from ordered where place <= 2",
)
def influential_variables(spark, folder):
    return top_drivers(spark, folder, 2)


@query(
    "scenario_influence_flags",
    WITH_SCENARIOS
    + ATTRIBUTION[len(YEARS) :]
    + IMPORTANCE
    + """ select s.product, s.country, s.year, testing_column, scenario,
             coalesce(l.place, 0) > 0 as influence_var
           from scored s left join (select product, country, variable, place from ordered where place = 1) l
             on l.product = s.product and l.country = s.country
                and replace(l.variable, '_norm', '') = replace(s.testing_column, '_norm', '')""",
)
def scenario_influence_flags(spark, folder):
    flagged = flag_influence(everything(spark, folder), top_drivers(spark, folder, 1), YEARLY)
    return flagged.select(*YEARLY.cell, "testing_column", "scenario", "influence_var")


@query("attribution_trees")
def attribution_trees(spark, folder):
    """Shapley values of a forest per series, along the paths of its trees."""
    frame = checkpoint(split_years(spark, folder).withColumn("t", YEARLY.index()))
    fitted = fit_model("rf", frame, YEARLY, list(NORM))
    return t.rounded(tree_attribution(fitted, frame), 4, "attribution")


@query("scenarios_of_top_models")
def scenarios_of_top_models(spark, folder):
    indicators = checkpoint(t.indicator_rows(spark, folder))
    features = checkpoint(t.yearly_features_with(indicators, spark, folder))
    made = analyse(
        features,
        _metrics(features, YEARLY, t.CUTOFF),
        YEARLY,
        t.CUTOFF,
        t.LAST,
        scenario_list(PERCENT, POINT, NORM),
        panel_statistics(indicators, t.SCALED),
    )
    return t.rounded(made.scenarios, 4, "forecast", "scenario_forecast")
