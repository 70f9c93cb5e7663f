"""Accuracy, ranking, ensembles, summaries.

Measures have four decimals, so their means over a few periods can be exact
halves at some digits; the digits below are those where that cannot happen.

Four simple forecasters stand in for fitted models, so that SQL can follow:
last value, same month of the last year, their mean, and a low variant.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.panel import naive
from loomcast.catalog.registry import query
from loomcast.functions.accuracy import accuracy_columns
from loomcast.operators.ranking import (
    combine,
    forecast_summary,
    model_metrics,
    rank_models,
    side_by_side,
    yearly_summary,
)
from loomcast.operators.reshape import columns_to_variables, variables_to_columns
from loomcast.session import checkpoint
from loomcast.spec import MONTHLY, YEARLY

WITH_LONG = t._with(t.LOCATED, t.PANEL, t.GRID, t.TRAIN_TEST, t.NAIVE, t.LONG)


def long_forecasts(spark, folder):
    wide = naive(spark, folder)
    blend = (F.col("naive") + F.col("seasonal_naive")) / 2
    entries = [
        F.struct(F.lit(name).alias("model"), column.alias("predicted"))
        for name, column in (
            ("naive", F.col("naive")),
            ("seasonal_naive", F.col("seasonal_naive")),
            ("blend", blend),
            ("low", F.col("seasonal_naive") * F.lit(0.9)),
        )
    ]
    return wide.select("product", "country", "year", "month", "actual", F.inline(F.array(*entries)))


def ranked(spark, folder):
    """Forecasts, materialised because ranking and combining both read them."""
    forecasts = checkpoint(long_forecasts(spark, folder))
    return forecasts, rank_models(model_metrics(forecasts, MONTHLY), MONTHLY)


ERRORS = ("mae", "mse", "rmse", "mape", "mape_pct", "r2")
METRIC_SQL = """
  count(actual - predicted) as n, round(avg(abs(actual - predicted)), 8) as mae,
  round(avg((actual - predicted) * (actual - predicted)), 1) as mse,
  round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) as rmse,
  round(avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)), 6) as mape,
  round(avg(case when actual <> 0 then abs(actual - predicted) / abs(actual) * 100 end), 6) as mape_pct,
  count(*) filter (where actual = 0 and predicted is not null) as n_zero_actual,
  round(1 - sum((actual - predicted) * (actual - predicted))
        / nullif(var_pop(case when predicted is not null then actual end) * count(actual - predicted), 0), 6) as r2
"""


def rounded_metrics(metrics):
    out = t.rounded(t.rounded(t.rounded(metrics, 8, "mae"), 4, "rmse"), 1, "mse")
    return t.rounded(out, 6, "mape", "mape_pct", "r2")


@query(
    "forecast_metrics",
    t.WITH_NAIVE
    + f"""select product, country, 'naive' as model, {METRIC_SQL}
          from (select *, naive as predicted from forecasts) group by 1, 2""",
)
def forecast_metrics(spark, folder):
    forecasts = naive(spark, folder).withColumn("predicted", F.col("naive")).withColumn("model", F.lit("naive"))
    return rounded_metrics(model_metrics(forecasts, MONTHLY))


@query(
    "forecast_metrics_all_models",
    WITH_LONG + f"select product, country, model, {METRIC_SQL} from long_forecasts group by 1, 2, 3",
)
def forecast_metrics_all_models(spark, folder):
    return rounded_metrics(model_metrics(long_forecasts(spark, folder), MONTHLY))


@query(
    "forecast_metrics_pct",
    t.WITH_DENSE
    + """, pairs as (select product, country, year, coalesce(value, 0) as actual,
             lag(value) over (partition by product, country order by year, month) as predicted from dense)
         select product, country, year, count(predicted) as n,
           round(avg(case when actual <> 0 then abs(actual - predicted) / abs(actual) * 100 end), 6) as mape_pct,
           count(*) filter (where actual = 0 and predicted is not null) as n_zero_actual
         from pairs group by 1, 2, 3""",
)
def forecast_metrics_pct(spark, folder):
    """Percentage errors where months without a sale count as zero."""
    lagged = F.lag("value").over(MONTHLY.ordered())
    pairs = t.dense(spark, folder).select(
        "product", "country", "year", F.coalesce("value", F.lit(0.0)).alias("actual"), lagged.alias("predicted")
    )
    metrics = pairs.groupBy("product", "country", "year").agg(*accuracy_columns())
    kept = metrics.select("product", "country", "year", "n", "mape_pct", "n_zero_actual")
    return t.rounded(kept, 6, "mape_pct")


@query(
    "model_ranking",
    t.WITH_RANKED
    + "select product, country, model, round(mape, 6) as mape, cast(rank as int) as rank from ranked",
)
def model_ranking(spark, folder):
    _, ranking = ranked(spark, folder)
    return t.rounded(ranking.select("product", "country", "model", "mape", "rank"), 6, "mape")


@query(
    "ensemble_equal",
    t.WITH_RANKED
    + """select product, country, year, month, max(actual) as actual, round(avg(predicted), 8) as predicted,
         count(*) as models_used
         from long_forecasts join ranked using (product, country, model)
         where predicted is not null group by 1, 2, 3, 4""",
)
def ensemble_equal(spark, folder):
    forecasts, ranking = ranked(spark, folder)
    return t.rounded(combine(forecasts, ranking, MONTHLY).drop("model"), 8, "predicted")


@query(
    "ensemble_inverse_mape",
    t.WITH_RANKED
    + """select product, country, year, month, max(actual) as actual,
         round(sum(predicted / (mape + 1e-6)) / sum(1 / (mape + 1e-6)), 5) as predicted, count(*) as models_used
         from long_forecasts join ranked using (product, country, model)
         where predicted is not null group by 1, 2, 3, 4""",
)
def ensemble_inverse_mape(spark, folder):
    forecasts, ranking = ranked(spark, folder)
    return t.rounded(combine(forecasts, ranking, MONTHLY, "inverse_mape").drop("model"), 5, "predicted")


@query(
    "ensemble_metrics",
    t.WITH_RANKED
    + f""", joint as (
         select product, country, year, month, max(actual) as actual, avg(predicted) as predicted
         from long_forecasts join ranked using (product, country, model)
         where predicted is not null group by 1, 2, 3, 4)
         select product, country, 'ensemble' as model, {METRIC_SQL} from joint group by 1, 2""",
)
def ensemble_metrics(spark, folder):
    forecasts, ranking = ranked(spark, folder)
    return rounded_metrics(model_metrics(combine(forecasts, ranking, MONTHLY), MONTHLY))


@query(
    "predictions_pivot",
    t.WITH_RANKED
    + """select product, country, year, month, max(actual) as actual,
         max(predicted) filter (where rank = 1) as pred_0, max(predicted) filter (where rank = 2) as pred_1,
         max(predicted) filter (where rank = 3) as pred_2, round(avg(predicted), 8) as ensemble_pred
         from long_forecasts join ranked using (product, country, model) group by 1, 2, 3, 4""",
)
def predictions_pivot(spark, folder):
    forecasts, ranking = ranked(spark, folder)
    return t.rounded(side_by_side(forecasts, ranking, MONTHLY), 8, "ensemble_pred")


@query(
    "forecast_summary",
    WITH_LONG
    + """select product, country, model, round(avg(predicted), 8) as mean,
         round(case when count(predicted) > 1 then stddev_samp(predicted) end, 4) as std,
         min(predicted) as min, max(predicted) as max
         from long_forecasts group by 1, 2, 3""",
)
def summary(spark, folder):
    made = forecast_summary(long_forecasts(spark, folder), MONTHLY)
    return t.rounded(t.rounded(made, 8, "mean"), 4, "std")


@query(
    "future_yearly_summary",
    t.WITH_RANKED
    + """select product, country, year, round(avg(predicted), 7) as forecast, count(*) as models_used
         from (select product, country, year, model, sum(predicted) as predicted
               from long_forecasts where predicted is not null group by 1, 2, 3, 4)
              join ranked using (product, country, model)
         group by 1, 2, 3""",
)
def future_yearly_summary(spark, folder):
    forecasts, ranking = ranked(spark, folder)
    yearly = (
        forecasts.filter(F.col("predicted").isNotNull())
        .groupBy("product", "country", "year", "model")
        .agg(F.sum("predicted").alias("predicted"), F.sum("actual").alias("actual"))
    )
    return t.rounded(yearly_summary(yearly, ranking, YEARLY), 7, "forecast")


@query(
    "variables_round_trip",
    t.WITH_RANKED
    + """, named as (select product, country, list(model order by rank) as vars from ranked group by 1, 2)
         select product, country, coalesce(vars[1], '') as exo_var_1, coalesce(vars[2], '') as exo_var_2,
           coalesce(vars[3], '') as exo_var_3, '' as exo_var_4, '' as exo_var_5,
           cast(len(list_filter(vars, lambda v: v <> 'low')) as int) as n_available
         from named""",
)
def variables_round_trip(spark, folder):
    """Array of names to five columns and back to the names that exist."""
    _, ranking = ranked(spark, folder)
    named = ranking.groupBy("product", "country").agg(
        F.array_sort(F.collect_list(F.struct("rank", "model"))).alias("r")
    )
    wide = named.select(
        "product", "country", *variables_to_columns(F.transform("r", lambda v: v["model"]))
    )
    back = columns_to_variables(wide, ["naive", "seasonal_naive", "blend"])
    return wide.withColumn("n_available", F.size(back))
