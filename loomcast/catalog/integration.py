"""Indicators: fold, derive, fill, scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.registry import query
from loomcast.operators.grid import add_calendar, distinct_keys
from loomcast.operators.integrate import fill_gaps, fold_indicators, scale, share_of
from loomcast.operators.reshape import clean_numbers
from loomcast.plans.prepare import indicator_table

WITH_FOLDED = t._with(t.LOCATED, t.PANEL, t.GRID, t.GAPPY_INDICATORS, t.FOLDED)
WITH_SCALED = t._with(t.LOCATED, t.PANEL, t.GRID, t.GAPPY_INDICATORS, t.FOLDED, t.FILLED, t.SCALE)
NORM = [f"{c}_norm" for c in t.SCALED]


def folded(spark, folder):
    countries = distinct_keys(t.revenue(spark, folder), "country")
    grid = add_calendar(countries, t.FIRST, t.LAST, monthly=False)
    return grid.join(fold_indicators(t.indicator_tables(spark, folder, gaps=True)), ["country", "year"], "left")


def derived(spark, folder):
    users = share_of(F.col("urgent_pct"), F.col("active_customers"))
    return folded(spark, folder).withColumn("urgent_customers", users)


@query(
    "indicator_fold",
    WITH_FOLDED + f"select country, year, {t.round_sql(6, *t.INDICATORS)} from folded",
)
def indicator_fold(spark, folder):
    return t.rounded(folded(spark, folder), 6, *t.INDICATORS)


@query(
    "indicator_fold_repeated",
    t._with(t.LOCATED)
    + """select country, year, round(avg(o_totalprice), 4) as spend, round(avg(urgent), 6) as urgent from (
           select country, year, o_totalprice, case when o_orderpriority = '1-URGENT' then 1.0 else 0.0 end as urgent
           from located) group by 1, 2""",
)
def indicator_fold_repeated(spark, folder):
    """Many rows per country and year are averaged, not multiplied."""
    orders = t.located_orders(spark, folder)
    urgent = (F.col("o_orderpriority") == "1-URGENT").cast("double")
    tables = {
        "spend": orders.select("country", "year", F.col("o_totalprice").alias("spend")),
        "urgent": orders.select("country", "year", urgent.alias("urgent")),
    }
    return t.rounded(t.rounded(fold_indicators(tables), 4, "spend"), 6, "urgent")


@query(
    "derived_indicator",
    WITH_FOLDED + f"select country, year, {t.round_sql(6, *t.ALL_INDICATORS)} from folded",
)
def derived_indicator(spark, folder):
    return t.rounded(derived(spark, folder), 6, *t.ALL_INDICATORS)


@query(
    "fill_forward_backward",
    t._with(t.LOCATED, t.PANEL, t.GRID, t.GAPPY_INDICATORS, t.FOLDED, t.FILLED)
    + f"select country, year, {t.round_sql(6, *t.ALL_INDICATORS)} from filled",
)
def fill_forward_backward(spark, folder):
    filled = fill_gaps(derived(spark, folder), ["country"], ["year"], t.ALL_INDICATORS)
    return t.rounded(filled, 6, *t.ALL_INDICATORS)


@query(
    "standard_scale",
    WITH_SCALED + f"select country, year, {t.round_sql(6, *NORM)} from scaled",
)
def standard_scale(spark, folder):
    countries = distinct_keys(t.revenue(spark, folder), "country")
    table = indicator_table(
        countries, t.indicator_tables(spark, folder, gaps=True), t.FIRST, t.LAST, t.DERIVED, t.UNSCALED
    )
    return t.rounded(table.select("country", "year", *NORM), 6, *NORM)


@query(
    "standard_scale_history_only",
    t._with(t.LOCATED, t.PANEL, t.GRID, t.GAPPY_INDICATORS, t.FOLDED, t.FILLED)
    + f"""select country, year, round((active_customers - m) / s, 6) as active_customers_norm
          from filled, (select avg(active_customers) as m, stddev_pop(active_customers) as s
                        from filled where year between {t.FIRST} and {t.CUTOFF - 1})""",
)
def standard_scale_history_only(spark, folder):
    filled = fill_gaps(folded(spark, folder), ["country"], ["year"], ["active_customers"])
    scored = scale(filled, ["active_customers"], (t.FIRST, t.CUTOFF - 1))
    return t.rounded(
        scored.select("country", "year", "active_customers_norm"), 6, "active_customers_norm"
    )


@query(
    "indicator_text_to_panel",
    WITH_FOLDED
    + "select country, year, active_customers from folded where active_customers is not null",
)
def indicator_text_to_panel(spark, folder):
    """Indicator values that arrive as '$1,234' become numbers again."""
    known = t.indicator_tables(spark, folder, gaps=True)["active_customers"]
    text = F.concat(F.lit("$"), F.format_number("active_customers", 0))
    return clean_numbers(known.withColumn("active_customers", text), ["active_customers"])


@query(
    "master_panel",
    t.WITH_MASTER
    + f"select product, country, year, month, value, {t.round_sql(6, *t.ALL_INDICATORS, *NORM)} from master",
)
def master_panel(spark, folder):
    return t.rounded(t.master(spark, folder), 6, *t.ALL_INDICATORS, *NORM)
