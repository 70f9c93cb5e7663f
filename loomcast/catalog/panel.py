"""Panels, grids, splits, roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.registry import query
from loomcast.operators.grid import densify
from loomcast.operators.integrate import roll_up_years
from loomcast.operators.reshape import unpivot_years
from loomcast.operators.split import last_value_forecast, split_at, split_last
from loomcast.spec import MONTHLY


@query("monthly_panel", t._with(t.LOCATED, t.PANEL) + "select * from panel")
def monthly_panel(spark, folder):
    return t.revenue(spark, folder)


@query("dense_grid_panel", t.WITH_DENSE + "select * from dense")
def dense_grid_panel(spark, folder):
    return t.dense(spark, folder)


@query(
    "dense_grid_observed_pairs",
    t.WITH_DENSE
    + """select d.* from dense d
         join (select distinct product, country from panel) using (product, country)""",
)
def dense_grid_observed_pairs(spark, folder):
    return densify(t.revenue(spark, folder), MONTHLY, t.FIRST, t.LAST, pairs="observed")


@query(
    "wide_to_long_years",
    t._with(t.LOCATED, t.PANEL)
    + ", wide as (select country, "
    + ", ".join(
        f"cast(sum(cast(value as decimal(28,4))) filter (where year = {y}) as double) as y{y}"
        for y in range(t.FIRST, t.LAST + 1)
    )
    + " from panel group by 1)\n"
    + " union all ".join(
        f"select country, cast({y} as int) as year, y{y} as revenue from wide"
        for y in range(1996, t.LAST + 1)
    ),
)
def wide_to_long_years(spark, folder):
    exact = F.col("value").cast("decimal(28,4)")
    wide = (
        t.revenue(spark, folder)
        .groupBy("country")
        .agg(
            *[
                F.sum(F.when(F.col("year") == y, exact)).cast("double").alias(str(y))
                for y in range(t.FIRST, t.LAST + 1)
            ]
        )
    )
    return unpivot_years(wide, ["country"], "revenue", 1996, t.LAST)


def _roll_up_sql(total: str) -> str:
    means = ", ".join(f"round(avg({c}), 6) as {c}" for c in t.ALL_INDICATORS)
    return (
        t.WITH_MASTER
        + f"select product, country, year, round({total}, 4) as value, {means} from master group by 1, 2, 3"
    )


def _roll_up(spark, folder, empty_sum):
    master = t.master(spark, folder)
    yearly = roll_up_years(master, MONTHLY, t.ALL_INDICATORS, empty_sum=empty_sum)
    return t.rounded(t.rounded(yearly, 4, "value"), 6, *t.ALL_INDICATORS)


@query("yearly_rollup", _roll_up_sql("sum(value)"))
def yearly_rollup(spark, folder):
    return _roll_up(spark, folder, "null")


@query("yearly_rollup_zero", _roll_up_sql("coalesce(sum(value), 0)"))
def yearly_rollup_zero(spark, folder):
    return _roll_up(spark, folder, "zero")


@query(
    "yearly_label",
    t.WITH_DENSE
    + """, labelled as (select *, case when value is not null then upper(substr(country, 1, 2)) end as code from dense)
    select product, country, year, round(sum(value), 4) as value, min(code) as country_actual
    from labelled group by 1, 2, 3""",
)
def yearly_label(spark, folder):
    """The code of a partly observed year is the one seen in its observed months."""
    code = F.when(F.col("value").isNotNull(), F.upper(F.substring("country", 1, 2)))
    dense = t.dense(spark, folder).withColumn("country_actual", code)
    return t.rounded(roll_up_years(dense, MONTHLY, labels=["country_actual"]), 4, "value")


@query(
    "holdout_split",
    t._with(t.LOCATED, t.PANEL, t.GRID, t.TRAIN_TEST) + "select * from held",
)
def holdout_split(spark, folder):
    return split_last(t.dense(spark, folder), MONTHLY).select(
        "product", "country", "year", "month", "value", "split", "step"
    )


@query(
    "cutoff_split",
    t.WITH_DENSE
    + f"""select *, case when year >= {t.CUTOFF} then 'test' else 'train' end as split,
          case when year >= {t.CUTOFF} then cast((year - {t.CUTOFF}) * 12 + month as int) end as step
          from dense""",
)
def cutoff_split(spark, folder):
    return split_at(t.dense(spark, folder), MONTHLY, t.CUTOFF, t.LAST)


@query("naive_forecast", t.WITH_NAIVE + "select * from forecasts")
def naive_forecast(spark, folder):
    return naive(spark, folder)


def naive(spark, folder):
    split = split_last(t.dense(spark, folder), MONTHLY)
    return last_value_forecast(split, MONTHLY).withColumnRenamed("value", "actual")
