"""Fitted models, back-test and future forecasts, with the operators' full defaults."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.registry import query
from loomcast.operators.models import fit_model, predictions
from loomcast.operators.models.arima import fit_arima
from loomcast.operators.models.base import default_selection
from loomcast.operators.models.fourier import fit_fourier
from loomcast.operators.models.smoothing import GRID, fit_smoothing
from loomcast.operators.models.trees import fit_trees
from loomcast.operators.split import split_last
from loomcast.plans.backtest import backtest
from loomcast.plans.future import forecast_months, forecast_years, future_frame, seeded
from loomcast.session import checkpoint
from loomcast.spec import MONTHLY, YEARLY, candidates

FIXED = (0.3, 0.1, 0.1)
RESULT = ("product", "country", "year", "month", "step", "actual", "predicted")


def frame_of(split):
    return checkpoint(split.withColumn("t", MONTHLY.index()))


def panel_frame(spark, folder):
    return frame_of(split_last(t.dense(spark, folder), MONTHLY))


def feature_frame(spark, folder):
    return frame_of(split_last(t.monthly_features(spark, folder), MONTHLY))


def holdout_of(fitted, frame, digits=4):
    made = predictions(fitted, frame).filter((F.col("split") == "test") & F.col("predicted").isNotNull())
    return t.rounded(made.select(*RESULT), digits, "predicted")


def every_forecast(fitted, frame, digits=4):
    """All test rows with the status of their series; null where there is no prediction."""
    made = predictions(fitted, frame).filter("split = 'test'")
    return t.rounded(made.select(*RESULT, "status"), digits, "predicted")


def smoothing_sql(grid, digits: int | None = 4) -> str:
    """Holt-Winters recursion over arrays, all parameter sets at once.

    The queue ``q`` holds the season with the current phase in front. A month
    without a value moves the states on. Series without two seasons are
    smoothed without one, and need two values.
    """
    sets = ", ".join(f"({i}, {a}::double, {b}::double, {g}::double)" for i, (a, b, g) in enumerate(grid))
    return (
        t._with(t.LOCATED, t.PANEL, t.GRID, t.TRAIN_TEST).replace("with ", "with recursive ", 1)
        + f""", params(set_id, a, b, g) as (values {sets}),
    spans as (
      select product, country, min(year * 12 + month) as t0, max(year * 12 + month) as t1, count(*) as seen
      from held where split = 'train' group by 1, 2),
    series as (
      select d.product, d.country, any_value(t1) as t1, any_value(seen) as seen, list(d.value order by d.year, d.month) as y
      from dense d join spans s on s.product = d.product and s.country = d.country
           and d.year * 12 + d.month between t0 and t1
      group by 1, 2),
    started as (
      select product, country, t1, y, len(y) as n, list_avg(y[1:12]) as first_mean,
             (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 as slope
      from series where len(y) >= 24 and list_count(y[13:24]) > 0),
    smooth as (
      select product, country, t1, set_id, a, b, g, 12 as i, n, first_mean + slope * 11 / 2 as level, slope as trend,
             list_transform(range(1, 13), lambda k: coalesce(y[k] - (first_mean + slope * ((k - 1) - 5.5::double)), 0)) as q,
             0.0::double as sse, y
      from started, params
      union all
      select product, country, t1, set_id, a, b, g, i + 1, n,
             coalesce(a * (y[i + 1] - q[1]) + (1 - a) * (level + trend), level + trend),
             coalesce(b * (a * (y[i + 1] - q[1]) + (1 - a) * (level + trend) - level) + (1 - b) * trend, trend),
             list_append(q[2:12], coalesce(g * (y[i + 1] - level - trend) + (1 - g) * q[1], q[1])),
             sse + coalesce((y[i + 1] - (level + trend + q[1])) * (y[i + 1] - (level + trend + q[1])), 0), y
      from smooth where i < n),
    unseasoned as (
      select *, list_filter(range(2, len(y) + 1), lambda k: y[k] is not null)[1] as j from series s
      where seen >= 2 and not exists (select 1 from started x where x.product = s.product and x.country = s.country)),
    plain as (
      select product, country, t1, set_id, a, b, j as i, len(y) as n, y[j] as level, (y[j] - y[1]) / (j - 1) as trend,
             0.0::double as sse, y
      from unseasoned, params
      union all
      select product, country, t1, set_id, a, b, i + 1, n, coalesce(a * y[i + 1] + (1 - a) * (level + trend), level + trend),
             coalesce(b * (a * y[i + 1] + (1 - a) * (level + trend) - level) + (1 - b) * trend, trend),
             sse + coalesce((y[i + 1] - (level + trend)) * (y[i + 1] - (level + trend)), 0), y
      from plain where i < n),
    ends as (
      select product, country, t1, set_id, level, trend, q, sse, 'ok' as status from smooth where i = n
      union all
      select product, country, t1, set_id, level, trend, list_transform(range(12), lambda k: 0.0::double), sse, 'no_season'
      from plain where i = n),
    best as (
      select * from (
        select *, row_number() over (partition by product, country order by sse, set_id) as place from ends)
      where place = 1)
    select h.product, h.country, h.year, h.month, h.step, h.value as actual,
           {"" if digits is None else "round"}(s.level + (h.year * 12 + h.month - t1) * s.trend + s.q[(h.year * 12 + h.month - t1 - 1) % 12 + 1]{"" if digits is None else f", {digits}"}) as predicted,
           coalesce(s.status, 'too_short') as status
    from held h left join best s using (product, country) where h.split = 'test'"""
    )


@query("holt_winters_fixed", smoothing_sql([FIXED]))
def holt_winters_fixed(spark, folder):
    frame = panel_frame(spark, folder)
    return every_forecast(fit_smoothing(frame, MONTHLY, grid=[FIXED]), frame)


@query("holt_winters_fit", smoothing_sql(GRID))
def holt_winters_fit(spark, folder):
    frame = panel_frame(spark, folder)
    return every_forecast(fit_smoothing(frame, MONTHLY, grid=GRID), frame)


# Least squares on trend, sine and cosine, one regressor after the other:
# each is cleared of the earlier ones, then the measure of each in turn.
ONE_HARMONIC = """,
located_t as (select *, year * 12 + month - 1 as t from held),
bounds as (
  select product, country, min(t) as t0, max(t) as t1 from located_t where split = 'train' group by 1, 2),
terms as (
  select h.*, (t - t0) / cast(greatest(t1 - t0, 1) as double) as p,
         sin(t * (2 * pi() / 12)) as s, cos(t * (2 * pi() / 12)) as c
  from located_t h join bounds using (product, country)),
means as (
  select product, country, avg(value) as my, avg(p) as mp, avg(s) as ms, avg(c) as mc, count(*) as n,
         regr_slope(s, p) as s_p, regr_slope(c, p) as c_p
  from terms where split = 'train' group by 1, 2),
step_one as (
  select t.*, my, mp, ms, mc, s_p, c_p, n, p - mp as p1, s - ms - s_p * (p - mp) as s1, c - mc - c_p * (p - mp) as c1
  from terms t join means using (product, country)),
c_on_s as (
  select product, country, sum(c1 * s1) / sum(s1 * s1) as c_s from step_one where split = 'train' group by 1, 2),
cleared as (select o.*, c_s, c1 - c_s * s1 as c2 from step_one o join c_on_s using (product, country)),
weights as (
  select product, country, sum(value * p1) / sum(p1 * p1) as wp, sum(value * s1) / sum(s1 * s1) as ws,
         sum(value * c2) / sum(c2 * c2) as wc
  from cleared where split = 'train' group by 1, 2)
select h.product, h.country, h.year, h.month, h.step, h.value as actual,
       case when n >= 6 then round(my + wp * p1 + ws * s1 + wc * c2, 3) end as predicted,
       case when coalesce(n, 0) >= 6 then 'ok' else 'too_short' end as status
from held h left join cleared c using (product, country, year, month) left join weights w using (product, country)
where h.split = 'test'
"""


@query("trend_one_harmonic", t._with(t.LOCATED, t.PANEL, t.GRID, t.TRAIN_TEST) + ONE_HARMONIC)
def trend_one_harmonic(spark, folder):
    """Trend and one harmonic without variables or ridge, so SQL can follow."""
    frame = panel_frame(spark, folder)
    return every_forecast(fit_fourier(frame, MONTHLY, breaks=(), order=1, ridge=0.0, least=6), frame, 3)


# Each value is expected to equal the one before it, with a variance that grows with the periods between.
RANDOM_WALK = """,
steps as (
  select *, value - lag(value) over w as change, year * 12 + month - lag(year * 12 + month) over w as gap
  from held where split = 'train' window w as (partition by product, country order by year, month)),
fits as (
  select product, country, count(gap) as n, avg(change * change / gap) as sigma2, sum(ln(gap)) as logs,
         arg_max(value, year * 12 + month) as last
  from steps group by 1, 2 having count(*) >= 2)
select h.product, h.country, h.year, h.month, h.step, h.value as actual, round(last, 4) as predicted,
       case when n is null then 'too_short' else 'ok' end as status, n, round(sqrt(sigma2), 4) as sigma,
       round(case when sigma2 > 0 then -0.5 * (n * (ln(2 * pi() * sigma2) + 1) + logs) end, 4) as loglik
from held h left join fits using (product, country) where h.split = 'test'
"""


@query("arima_random_walk", t._with(t.LOCATED, t.PANEL, t.GRID, t.TRAIN_TEST) + RANDOM_WALK)
def arima_random_walk(spark, folder):
    """Orders (0, 1, 0): likelihood and forecasts of the filter over a calendar with missing months."""
    frame = panel_frame(spark, folder)
    fitted = fit_arima(frame, MONTHLY, order=(0, 1, 0), seasonal=(0, 0, 0))
    found = fitted.parameters.select(*MONTHLY.keys, "n", F.sqrt("sigma2").alias("sigma"), "loglik")
    made = predictions(fitted, frame).filter("split = 'test'").join(found, list(MONTHLY.keys))
    return t.rounded(made.select(*RESULT, "status", "n", "sigma", "loglik"), 4, "predicted", "sigma", "loglik")


@query("seasonal_arima_parameters")
def seasonal_arima_parameters(spark, folder):
    """Weights, variance and likelihood of the seasonal model of every monthly series, without variables."""
    fitted = fit_arima(panel_frame(spark, folder), MONTHLY)
    columns = [F.try_element_at("weights", F.lit(i + 1)).alias(c) for i, c in enumerate(("ar", "seasonal_ar", "ma", "seasonal_ma"))]
    rows = fitted.parameters.select(*MONTHLY.keys, "status", "n", *columns, F.sqrt("sigma2").alias("sigma"), "loglik")
    return t.rounded(rows, 4, "ar", "seasonal_ar", "ma", "seasonal_ma", "sigma", "loglik")


def model_query(name, model, history=True, **options):
    @query(name)
    def run(spark, folder):
        frame = feature_frame(spark, folder)
        names = candidates(frame, MONTHLY, history=history)
        return holdout_of(fit_model(model, frame, MONTHLY, names, **options), frame)

    return run


def first_five(model):
    """Model on its first five candidates, the default selection."""

    def run(spark, folder):
        frame = feature_frame(spark, folder)
        names = candidates(frame, MONTHLY, history=False)
        chosen = default_selection(frame, MONTHLY, names)
        return holdout_of(fit_model(model, frame, MONTHLY, names, chosen), frame)

    return run


query("seasonal_arx")(first_five("sarimax"))
query("trend_fourier")(first_five("prophet"))
model_query("random_forest", "rf")
model_query("gbt_deep", "xgb")
model_query("gbt_small", "lgb")


STUMP_VARIABLES = ("month", "active_customers_norm", "avg_order_value_norm")


def stump_sql(penalty: float, rate: float, least_rows: int) -> str:
    """One split per series from grouped sums of gradient and curvature: every cut of every variable.

    Curvature is one for each row, so its sum is a count.
    """
    branches = " union all ".join(
        f"select product, country, {i} as ordinal, '{c}' as variable, {c} as x, value from seen" for i, c in enumerate(STUMP_VARIABLES)
    )
    pick = "case f.variable " + " ".join(f"when '{c}' then h.{c}" for c in STUMP_VARIABLES) + " end"
    return (
        t._with(t.LOCATED, t.PANEL, t.GRID, t.RAW_INDICATORS, t.FOLDED, t.FILLED, t.SCALE, t.TRAIN_TEST)
        + f""",
    rows_ as (
      select h.*, s.active_customers_norm, s.avg_order_value_norm
      from held h left join scaled s on s.country = h.country and s.year = h.year),
    seen as (select * from rows_ where split = 'train' and {" and ".join(f"{c} is not null" for c in STUMP_VARIABLES)}),
    totals as (select product, country, avg(value) as base, count(*) as n from seen group by 1, 2),
    levels as (
      select product, country, ordinal, variable, x, sum(base - value) as g, count(*) as h
      from ({branches}) join totals using (product, country) group by 1, 2, 3, 4, 5),
    cuts as (
      select *, lead(x) over w as next_x, sum(g) over w as gl, sum(h) over w as hl, sum(g) over a as gt, sum(h) over a as ht
      from levels
      window w as (partition by product, country, ordinal order by x rows between unbounded preceding and current row),
             a as (partition by product, country, ordinal)),
    gains as (
      select *, gl * gl / (hl + {penalty}) + (gt - gl) * (gt - gl) / (ht - hl + {penalty}) - gt * gt / (ht + {penalty}) as gain
      from cuts where next_x is not null and hl >= {least_rows} and ht - hl >= {least_rows}),
    chosen as (
      select * from (
        select *, row_number() over (partition by product, country order by hl, ordinal) as place
        from (select *, max(gain) over (partition by product, country) as most from gains)
        where most > 1e-6 and gain >= most * (1 - 1e-9)) where place = 1),
    fits as (
      select product, country, base, c.variable, (x + next_x) / 2 as cut, n,
             -{rate} * gl / (hl + {penalty}) as low, -{rate} * (gt - gl) / (ht - hl + {penalty}) as high, hl * 1.0 / ht as share
      from totals left join chosen c using (product, country))
    select h.product, h.country, h.year, h.month, h.step, h.value as actual,
           case when f.n is null then 'too_short' else 'ok' end as status,
           round(base + case when cut is null then 0 when {pick} <= cut then low else high end, 3) as predicted,
           round(base + coalesce(low * share + high * (1 - share), 0), 3) as expected,
           f.variable as split_variable,
           round(case when cut is not null then case when {pick} <= cut then low else high end - low * share - high * (1 - share) end, 3) as attribution
    from rows_ h left join fits f using (product, country) where h.split = 'test'"""
    )


def stump_query(name, kind, **sql):
    """One tree of one split per series: prediction, expectation and what the split variable adds, against grouped sums."""

    @query(name, stump_sql(**sql))
    def run(spark, folder):
        frame = frame_of(split_last(t.master(spark, folder), MONTHLY))
        fitted = fit_trees(frame, MONTHLY, STUMP_VARIABLES, kind=kind, rounds=1, depth=1)
        made = fitted.explained(frame.filter("split = 'test'"))
        split = fitted.parameters.select(*MONTHLY.keys, F.try_element_at("feature", F.lit(1)).alias("feature"))
        at = F.when(F.col("feature") >= 0, F.col("feature") + 1)
        labels = F.array(*[F.lit(c) for c in STUMP_VARIABLES])
        rows = made.join(split, list(MONTHLY.keys)).select(
            "product", "country", "year", "month", "step", F.col("value").alias("actual"), "predicted", "status", "expected",
            F.try_element_at(labels, at).alias("split_variable"), F.try_element_at("parts", at).alias("attribution"),
        )
        return t.rounded(rows, 3, "predicted", "expected", "attribution")


stump_query("gbt_level_first_split", "xgb", penalty=1.0, rate=0.3, least_rows=1)
stump_query("gbt_leaf_first_split", "lgb", penalty=0.0, rate=0.1, least_rows=20)


TWO_MODELS = f"""
with smoothed as ({smoothing_sql(GRID, None)}),
repeated as ({t.WITH_NAIVE} select product, country, year, month, step, actual, naive as predicted from forecasts),
single as (
  select product, country, year, month, actual, 'exp_smoothing' as model, predicted, status from smoothed where predicted is not null
  union all
  select product, country, year, month, actual, 'naive', predicted, 'ok' from repeated where predicted is not null),
every as (
  select * from single
  union all
  select product, country, year, month, max(actual), 'ensemble', avg(predicted), 'ok' from single group by 1, 2, 3, 4)
select product, country, model, max(status) as status, count(*) as n,
       round(sqrt(avg((actual - predicted) * (actual - predicted))), 3) as rmse,
       round(avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)), 6) as mape,
       round(1 - sum((actual - predicted) * (actual - predicted)) / nullif(var_pop(actual) * count(*), 0), 6) as r2,
       '' as exo_var_1, '' as exo_var_5, model = 'exp_smoothing' as baseline
from every group by product, country, model
"""


@query("backtest_smoothing", TWO_MODELS)
def backtest_smoothing(spark, folder):
    """The whole back-test on two models that SQL can follow: split, fit, measure, rank, combine."""
    result = backtest(t.dense(spark, folder), MONTHLY, models=("exp_smoothing", "naive"), options={"exp_smoothing": {"grid": GRID}})
    kept = ("product", "country", "model", "status", "n", "rmse", "mape", "r2", "exo_var_1", "exo_var_5", "baseline")
    return t.rounded(t.rounded(result.metrics.select(*kept), 3, "rmse"), 6, "mape", "r2")


@query("backtest_metrics")
def backtest_metrics(spark, folder):
    result = backtest(t.monthly_features(spark, folder), MONTHLY)
    return t.rounded(result.metrics, 6, "mae", "mse", "rmse", "mape", "mape_pct", "r2")


@query("backtest_yearly_metrics")
def backtest_yearly_metrics(spark, folder):
    result = backtest(t.yearly_features(spark, folder), YEARLY)
    return t.rounded(result.metrics, 6, "mae", "mse", "rmse", "mape", "mape_pct", "r2")


SEEDED = f""",
last_known as (
  select product, country, arg_max(value, year * 12 + month) as seed
  from dense where year < {t.CUTOFF} and value is not null group by 1, 2),
united as (
  select d.product, d.country, d.year, d.month, case when d.year < {t.CUTOFF} then d.value else seed end as value
  from dense d join last_known using (product, country)),
made as (
  select *, lag(value, 3) over w as value_lag_3, lag(value, 12) over w as value_lag_12,
         avg(value) over (partition by product, country order by year, month
                          rows between 2 preceding and current row) as value_rollmean_3
  from united window w as (partition by product, country order by year, month))
select product, country, year, month, value,
""" + ", ".join(
    f"round(coalesce(last_value({c} ignore nulls) over (partition by product, country order by year, month "
    f"rows between unbounded preceding and current row), first_value({c} ignore nulls) over (partition by "
    f"product, country order by year, month rows between current row and unbounded following)), 7) as {c}"
    for c in ("value_lag_3", "value_lag_12", "value_rollmean_3")
) + " from made"


@query("seeded_future_features", t.WITH_DENSE + SEEDED)
def seeded_future_features(spark, folder):
    """History features that run on into the horizon over seed forecasts."""
    frame = checkpoint(future_frame(t.dense(spark, folder), MONTHLY, t.CUTOFF, t.LAST))
    seeds = predictions(fit_model("naive", frame, MONTHLY), frame).filter(
        (F.col("split") == "test") & F.col("predicted").isNotNull()
    )
    rows = seeded(frame, checkpoint(seeds), MONTHLY, lags=(3, 12), windows=(3,))
    made = ("value_lag_3", "value_lag_12", "value_rollmean_3")
    return t.rounded(rows.select("product", "country", "year", "month", "value", *made), 7, *made)


def _metrics(features, spec, cutoff):
    """Errors of the models on the years before the cut."""
    past = features.filter(F.col("year") < cutoff)
    return checkpoint(backtest(past, spec).metrics)


@query("future_forecast_monthly")
def future_forecast_monthly(spark, folder):
    features = checkpoint(t.monthly_features(spark, folder))
    made = forecast_months(features, _metrics(features, MONTHLY, t.CUTOFF), MONTHLY, t.CUTOFF, t.LAST)
    return t.rounded(made.forecasts, 4, "predicted")


@query("future_forecast_yearly")
def future_forecast_yearly(spark, folder):
    features = checkpoint(t.yearly_features(spark, folder))
    made = forecast_years(features, _metrics(features, YEARLY, t.CUTOFF), YEARLY, t.CUTOFF, t.LAST, ("active_customers",))
    return t.rounded(made.summary, 4, "forecast")


@query("future_forecast_yearly_rows")
def future_forecast_yearly_rows(spark, folder):
    """The rows behind the summary: in-sample and horizon of the three best models and their ensemble, with status."""
    features = checkpoint(t.yearly_features(spark, folder))
    made = forecast_years(features, _metrics(features, YEARLY, t.CUTOFF), YEARLY, t.CUTOFF, t.LAST, ("active_customers",))
    return t.rounded(made.forecasts, 4, "predicted")
