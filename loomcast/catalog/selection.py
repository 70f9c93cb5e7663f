"""Choice of exogenous variables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.features import CALENDAR, COMPLETE, history_sql
from loomcast.catalog.registry import query
from loomcast.operators.selection import (
    causality_scores,
    causality_tests,
    choose,
    long_form,
    mutual_information,
    tree_importance,
    varying,
    without_gaps,
)
from loomcast.operators.split import split_last
from loomcast.session import checkpoint
from loomcast.spec import MONTHLY, candidates

NAMES = (
    *[f"{c}_norm" for c in t.SCALED],
    "quarter",
    "is_year_end",
    "value_lag_3",
    "value_lag_6",
    "value_lag_12",
    "value_rollmean_3",
    "value_rollmean_6",
    "value_rollmean_12",
)
WITH_LONG = (
    t.WITH_MASTER
    + f""",
made as ({history_sql('master', 1)}),
feature_rows as (select *, {CALENDAR} from made where value is not null and {COMPLETE}),
train as (
  select * from (
    select *, row_number() over (partition by product, country order by year desc, month desc) as back
    from feature_rows) where back > 12),
long as ("""
    + " union all ".join(
        f"select product, country, year, month, value as y, '{n}' as variable, "
        f"cast({i} as int) as ordinal, cast({n} as double) as x from train"
        for i, n in enumerate(NAMES, 1)
    )
    + """),
usable as (
  select product, country, variable, ordinal from long group by 1, 2, 3, 4
  having count(distinct x) > 1)
"""
)


def training_rows(spark, folder):
    split = split_last(t.monthly_features(spark, folder), MONTHLY)
    return split.filter(F.col("split") == "train")


def long_rows(spark, folder):
    train = checkpoint(training_rows(spark, folder))
    assert candidates(train, MONTHLY) and set(candidates(train, MONTHLY)) == set(NAMES)
    return train, long_form(train, MONTHLY, NAMES)


def listed(selection):
    return selection.select("product", "country", F.array_join("exo_vars", ",").alias("exo_vars"))


@query("select_non_constant", WITH_LONG + "select * from usable")
def select_non_constant(spark, folder):
    _, long = long_rows(spark, folder)
    return varying(long, MONTHLY)


MUTUAL = """,
binned as (
  select product, country, variable, ordinal,
    ntile(4) over (partition by product, country, variable order by coalesce(x, 0), year, month) as bx,
    ntile(4) over (partition by product, country, variable order by y, year, month) as byy
  from long),
cells as (select product, country, variable, ordinal, bx, byy, count(*) as n from binned group by all),
margins as (
  select *, sum(n) over (partition by product, country, variable) as total,
    sum(n) over (partition by product, country, variable, bx) as n_x,
    sum(n) over (partition by product, country, variable, byy) as n_y
  from cells),
information as (
  select product, country, variable, ordinal,
    sum(n / cast(total as double) * ln(n * total / cast(n_x * n_y as double))) as score
  from margins group by 1, 2, 3, 4)
"""


@query(
    "mutual_information",
    WITH_LONG + MUTUAL + "select product, country, variable, ordinal, round(score, 6) as score from information",
)
def information(spark, folder):
    _, long = long_rows(spark, folder)
    return t.rounded(mutual_information(long, MONTHLY), 6, "score")


@query(
    "select_mutual_info",
    WITH_LONG
    + MUTUAL
    + """, scored as (
      select u.*, round(i.score, 9) as score, i.score > 0 as qualified from usable u left join information i
        using (product, country, variable)),
    placed as (
      select *, row_number() over (partition by product, country
        order by qualified desc, score desc nulls last, ordinal) as place from scored)
    select product, country, string_agg(variable, ',' order by place) as exo_vars
    from placed where place <= 5 and qualified group by 1, 2""",
)
def select_mutual_info(spark, folder):
    _, long = long_rows(spark, folder)
    scores = t.rounded(mutual_information(long, MONTHLY), 9, "score")
    return listed(choose(varying(long, MONTHLY), scores, MONTHLY))


@query(
    "select_first_five",
    WITH_LONG
    + """select product, country, string_agg(variable, ',' order by ordinal) as exo_vars from (
           select *, row_number() over (partition by product, country order by ordinal) as place from usable)
         where place <= 5 group by 1, 2""",
)
def select_first_five(spark, folder):
    _, long = long_rows(spark, folder)
    return listed(choose(varying(long, MONTHLY), None, MONTHLY))


def _gaps_sql(rule: str) -> str:
    names = ("value", *t.ALL_INDICATORS)
    gone = ", ".join(f"case when {rule}({n} is null) then '{n}' end" for n in names)
    listed = ", ".join(f"'{n}'" for n in names)
    return (
        t.WITH_GAPPY_MASTER
        + f""", gaps as (select product, country, [{gone}] as gone from master group by 1, 2)
        select product, country,
          array_to_string(list_filter([{listed}], lambda v: not coalesce(list_contains(gone, v), false)), ',')
            as exo_vars
        from gaps"""
    )


def _without_gaps(spark, folder, rule):
    names = ["value", *t.ALL_INDICATORS]
    rows = checkpoint(t.master(spark, folder, gaps=True))
    everything = F.array(*[F.lit(n) for n in names])
    selection = rows.select(*MONTHLY.keys).distinct().withColumn("exo_vars", everything)
    return listed(without_gaps(selection, rows, MONTHLY, names, rule))


@query("select_without_any_gap", _gaps_sql("bool_or"))
def select_without_any_gap(spark, folder):
    return _without_gaps(spark, folder, "any")


@query("select_with_some_value", _gaps_sql("bool_and"))
def select_with_some_value(spark, folder):
    return _without_gaps(spark, folder, "all")


# One lag in closed form: residuals of y and of x1 on y1 first, then y on x1.
ONE_LAG = """,
paired as (
  select product, country, variable, ordinal, year, month, y, x,
    count(*) over (partition by product, country, variable) as n_rows
  from long where x is not null and y is not null),
lagged as (
  select *, lag(y) over w as y1, lag(x) over w as x1 from paired where n_rows > 10
  window w as (partition by product, country, variable order by year, month)),
sums as (
  select product, country, variable, ordinal, count(*) as n,
    regr_syy(y, y1) as syy, regr_sxx(y, y1) as s11, regr_sxy(y, y1) as sy1,
    regr_sxx(y, x1) as sxx, regr_sxy(y, x1) as sxy, regr_sxy(y1, x1) as s1x
  from lagged where y1 is not null group by 1, 2, 3, 4),
fits as (
  select *, syy - sy1 * sy1 / s11 as rss_without, sxx - s1x * s1x / s11 as x_left, sxy - sy1 * s1x / s11 as xy_left
  from sums where sxx > 1e-9)
"""


@query(
    "granger_one_lag",
    WITH_LONG
    + ONE_LAG
    + """select product, country, variable, n,
           round((xy_left * xy_left / x_left) / ((rss_without - xy_left * xy_left / x_left) / (n - 3)), 4) as f
         from fits""",
)
def granger_one_lag(spark, folder):
    """F statistic of the causality test with one lag, variables that vary."""
    _, long = long_rows(spark, folder)
    tests = causality_tests(long, MONTHLY, max_lag=1).select("product", "country", "variable", "n", "f")
    return t.rounded(tests, 4, "f")


@query("select_granger")
def select_granger(spark, folder):
    train, _ = long_rows(spark, folder)
    names = candidates(train, MONTHLY, history=False)
    long = long_form(train, MONTHLY, names)
    return listed(choose(varying(long, MONTHLY), causality_scores(long, MONTHLY), MONTHLY, True, False))


@query("select_tree_importance")
def select_tree_importance(spark, folder):
    train, long = long_rows(spark, folder)
    return listed(choose(varying(long, MONTHLY), tree_importance(train, MONTHLY, NAMES), MONTHLY))
