"""Calendar, lag and rolling features; filter on incomplete rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.registry import query
from loomcast.operators.features import add_calendar_features, add_history_features
from loomcast.plans.prepare import yearly_from_monthly
from loomcast.spec import MONTHLY

LAGS = ("value_lag_3", "value_lag_6", "value_lag_12")
MEANS = ("value_rollmean_3", "value_rollmean_6", "value_rollmean_12")
ORDERED = "over (partition by product, country order by year, month"


def history_sql(source: str, shift: int = 0) -> str:
    lags = ", ".join(f"lag(value, {k}) {ORDERED}) as value_lag_{k}" for k in (3, 6, 12))
    means = ", ".join(
        f"avg(value) {ORDERED} rows between {w - 1 + shift} preceding and "
        f"{'current row' if not shift else f'{shift} preceding'}) as value_rollmean_{w}"
        for w in (3, 6, 12)
    )
    return f"select *, {lags}, {means} from {source}"


CALENDAR = "cast((month - 1) // 3 + 1 as int) as quarter, cast(month = 12 as int) as is_year_end"
NORM = [f"{c}_norm" for c in t.SCALED]
COMPLETE = " and ".join(f"{c} is not null and isfinite({c})" for c in (*LAGS, *MEANS, *NORM))


@query("calendar_features", t.WITH_DENSE + f"select *, {CALENDAR} from dense")
def calendar_features(spark, folder):
    return add_calendar_features(t.dense(spark, folder))


@query(
    "lag_features",
    t.WITH_DENSE
    + f", made as ({history_sql('dense')}) select product, country, year, month, {', '.join(LAGS)} from made",
)
def lag_features(spark, folder):
    made = add_history_features(t.dense(spark, folder), MONTHLY, windows=())
    return made.drop("value")


@query(
    "rolling_mean_features",
    t.WITH_DENSE
    + f", made as ({history_sql('dense')}) select product, country, year, month, {t.round_sql(7, *MEANS)} from made",
)
def rolling_mean_features(spark, folder):
    made = add_history_features(t.dense(spark, folder), MONTHLY, lags=())
    return t.rounded(made.drop("value"), 7, *MEANS)


@query(
    "rolling_mean_past_only",
    t.WITH_DENSE
    + f", made as ({history_sql('dense', 1)}) select product, country, year, month, {t.round_sql(7, *MEANS)} from made",
)
def rolling_mean_past_only(spark, folder):
    made = add_history_features(t.dense(spark, folder), MONTHLY, lags=(), include_current=False)
    return t.rounded(made.drop("value"), 7, *MEANS)


@query(
    "history_features_in_blocks",
    t.WITH_DENSE
    + f", made as ({history_sql('dense')}) "
    + f"select product, country, year, month, {', '.join(LAGS)}, {t.round_sql(7, *MEANS)} from made",
)
def history_features_in_blocks(spark, folder):
    """The same features with every series cut into overlapping stretches."""
    made = add_history_features(t.dense(spark, folder), MONTHLY, block=24)
    return t.rounded(made.drop("value"), 7, *MEANS)


@query(
    "bad_row_filter",
    t.WITH_GAPPY_MASTER
    + f", made as ({history_sql('master')}) "
    + f"select product, country, year, month, value, {', '.join(LAGS)}, {t.round_sql(7, *MEANS, *NORM)}, {CALENDAR} "
    + f"from made where value is null or ({COMPLETE})",
)
def bad_row_filter(spark, folder):
    made = t.monthly_features(spark, folder, include_current=True, gaps=True).drop(*t.ALL_INDICATORS)
    return t.rounded(made, 7, *MEANS, *NORM)


@query(
    "yearly_features",
    t.WITH_MASTER
    + """, yearly as (select product, country, year, sum(value) as value from master group by 1, 2, 3),
      made as (select *, lag(value) over (partition by product, country order by year) as value_lag_1 from yearly)
      select product, country, year, round(value, 4) as value, round(value_lag_1, 4) as value_lag_1
      from made where value is null or value_lag_1 is not null""",
)
def yearly_feature_table(spark, folder):
    made = t.yearly_features(spark, folder).select("product", "country", "year", "value", "value_lag_1")
    return t.rounded(made, 4, "value", "value_lag_1")


@query(
    "yearly_history_from_text",
    t.WITH_DENSE
    + """, yearly as (select product, country, year, sum(floor(value)) as value from dense group by 1, 2, 3)
      select product, country, year, value,
        lag(value) over (partition by product, country order by year) as value_lag_1,
        avg(value) over (partition by product, country order by year rows between 1 preceding and current row)
          as value_rollmean_2
      from yearly""",
)
def yearly_history_from_text(spark, folder):
    """A monthly table whose measure is text such as '$1,234', rolled up to years."""
    text = F.concat(F.lit("$"), F.format_number(F.floor("value"), 0))
    return yearly_from_monthly(t.dense(spark, folder).withColumn("value", text))
