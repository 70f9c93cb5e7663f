"""Text cleaning, recoding, profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomcast.catalog import inputs as t
from loomcast.catalog.registry import query
from loomcast.functions.text import parse_number, parse_year, snake_case_column
from loomcast.operators.grid import distinct_keys
from loomcast.operators.integrate import repeated_rows
from loomcast.operators.profile import describe, missing_report, run_statistics
from loomcast.operators.reshape import clean_numbers
from loomcast.sources.readers import recode, unit_in_years

# Short codes of four of the five regions; the fifth has no entry.
REGION_CODES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU"}


@query(
    "header_snake_case",
    r"""
    with headers as (
      select p_partkey, concat(p_type, ' ', 'partName', p_brand, 'X (', p_size, ')') as header from part)
    select p_partkey, header,
           lower(array_to_string(regexp_extract_all(header, '[A-Z]+[a-z0-9]*|[a-z0-9]+'), '_')) as name
    from headers""",
)
def header_snake_case(spark, folder):
    header = F.concat(
        "p_type", F.lit(" "), F.lit("partName"), "p_brand", F.lit("X ("), F.col("p_size").cast("string"), F.lit(")")
    )
    parts = t.table(spark, folder, "part").select("p_partkey", header.alias("header"))
    return parts.withColumn("name", snake_case_column(F.col("header")))


@query(
    "text_number_clean",
    r"""
    with dirty as (
      select o_orderkey, case o_orderpriority
        when '5-LOW' then 'n/a'
        when '4-NOT SPECIFIED' then concat(cast(cast(floor(o_totalprice) as bigint) as varchar), 'd')
        when '3-MEDIUM' then concat(' $', format('{:,}', cast(floor(o_totalprice) as bigint)), '.5 ')
        when '2-HIGH' then concat('-', cast(cast(floor(o_totalprice) as bigint) as varchar), 'e2')
        else format('{:,}', cast(floor(o_totalprice) as bigint)) end as amount
      from orders),
    bare as (select o_orderkey, amount, trim(regexp_replace(amount, '[$,]', '', 'g')) as b from dirty)
    select o_orderkey, amount,
           case when regexp_matches(b, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') then cast(b as double) end
             as number
    from bare""",
)
def text_number_clean(spark, folder):
    whole = F.floor("o_totalprice").cast("bigint")
    grouped = F.format_number(whole, 0)
    kind = F.col("o_orderpriority")
    amount = (
        F.when(kind == "5-LOW", "n/a")
        .when(kind == "4-NOT SPECIFIED", F.concat(whole.cast("string"), F.lit("d")))
        .when(kind == "3-MEDIUM", F.concat(F.lit(" $"), grouped, F.lit(".5 ")))
        .when(kind == "2-HIGH", F.concat(F.lit("-"), whole.cast("string"), F.lit("e2")))
        .otherwise(grouped)
    )
    dirty = t.table(spark, folder, "orders").select("o_orderkey", amount.alias("amount"))
    return clean_numbers(dirty.withColumn("number", F.col("amount")), ["number"])


@query(
    "year_from_text",
    r"""
    with texts as (
      select o_orderkey, case o_orderstatus
        when 'F' then concat(cast(year(o_orderdate) as varchar), '-Q', cast(quarter(o_orderdate) as varchar))
        when 'O' then cast(year(o_orderdate) as varchar)
        else concat('19x', cast(month(o_orderdate) as varchar)) end as period from orders)
    select o_orderkey, period, try_cast(substr(period, 1, 4) as int) as year from texts""",
)
def year_from_text(spark, folder):
    date, status = F.col("o_orderdate"), F.col("o_orderstatus")
    year = F.year(date).cast("string")
    period = (
        F.when(status == "F", F.concat(year, F.lit("-Q"), F.quarter(date).cast("string")))
        .when(status == "O", year)
        .otherwise(F.concat(F.lit("19x"), F.month(date).cast("string")))
    )
    texts = t.table(spark, folder, "orders").select("o_orderkey", period.alias("period"))
    return texts.withColumn("year", parse_year(F.col("period")))


@query(
    "recode_map",
    t._with(t.LOCATED)
    + "select o_orderkey, country, case country "
    + " ".join(f"when '{k}' then '{v}'" for k, v in REGION_CODES.items())
    + " end as code from located",
)
def recode_map(spark, folder):
    orders = t.located_orders(spark, folder).select("o_orderkey", "country")
    return recode(orders, "country", "code", REGION_CODES)


@query(
    "filter_unit_year",
    """
    select o_orderkey, o_orderpriority as unit_of_measure, cast(year(o_orderdate) as int) as year, o_totalprice
    from orders where o_orderpriority = '1-URGENT' and year(o_orderdate) between 1996 and 1999""",
)
def filter_unit_year(spark, folder):
    rows = t.table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("unit_of_measure"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year"),
        "o_totalprice",
    )
    return unit_in_years(rows, "1-URGENT", 1996, 1999)


@query(
    "distinct_keys",
    t._with(t.LOCATED, t.PANEL) + "select distinct product, country from panel",
)
def distinct_series(spark, folder):
    return distinct_keys(t.revenue(spark, folder), "product", "country")


MASTER_COLUMNS = {"product": "string", "country": "string", "year": "int", "month": "int"} | {
    c: "double" for c in ("value", *t.ALL_INDICATORS, *[f"{c}_norm" for c in t.SCALED])
}


@query(
    "missing_report",
    t.WITH_GAPPY_MASTER
    + " union all ".join(
        f"select 'master' as table_name, '{c}' as column_name, '{kind}' as data_type, count(*) as n, "
        f"count(*) - count({c}) as nulls, round((count(*) - count({c})) * 100.0::double / count(*), 6) as null_pct "
        "from master"
        for c, kind in MASTER_COLUMNS.items()
    ),
)
def missing(spark, folder):
    report = missing_report(t.master(spark, folder, gaps=True), "master")
    return t.rounded(report, 6, "null_pct")


def _describe_sql(name: str, column: str, number: bool) -> str:
    stats = (
        f"round(avg({column}), 4), round(stddev_samp({column}), 4), min({column}), "
        + ", ".join(f"round(quantile_cont({column}, {q}), 4)" for q in (0.25, 0.5, 0.75))
        + f", max({column})"
        if number
        else ", ".join(["cast(null as double)"] * 7)
    )
    return f"""
    select '{column}', count({column}), count(distinct {column}),
           (select v from (select cast({column} as varchar) as v, count(*) as k from {name}
             where {column} is not null group by 1) order by k desc, v desc limit 1),
           (select max(k) from (select count(*) as k from {name} where {column} is not null group by {column})),
           {stats} from {name}"""


#: Every column of the table, and whether it is a number.
LINE_COLUMNS = {
    "l_orderkey": True, "l_partkey": True, "l_suppkey": True, "l_linenumber": True, "l_quantity": True,
    "l_extendedprice": True, "l_discount": True, "l_tax": True, "l_returnflag": False, "l_linestatus": False,
    "l_shipdate": False,
}


@query(
    "describe_all",
    "with d(column_name, n, n_unique, top, freq, mean, std, min, q1, median, q3, max) as ("
    + " union all ".join(
        _describe_sql("lineitem", c, number)
        for c, number in LINE_COLUMNS.items()
    )
    + ") select column_name, n, n_unique, top, freq, mean, std, cast(min as double) as min, q1, median, q3, "
    "cast(max as double) as max from d",
)
def describe_all(spark, folder):
    described = describe(t.table(spark, folder, "lineitem"), list(LINE_COLUMNS))
    return t.rounded(described, 4, "mean", "std", "q1", "median", "q3")


@query(
    "run_stats",
    t.WITH_DENSE
    + """select count(*) as n_rows, min(year) as min_year, max(year) as max_year,
         count(distinct product) as n_product, count(distinct country) as n_country, count(distinct year) as n_year
         from dense""",
)
def run_stats(spark, folder):
    return run_statistics(t.dense(spark, folder), ["year"], ["product", "country", "year"])


@query(
    "repeated_indicator_rows",
    t._with(t.LOCATED)
    + """select variable, cast(sum(k - 1) as bigint) as repeated from (
           select 'orders_rows' as variable, country, year, count(*) as k from located group by 2, 3
           union all
           select 'customer_rows', country, year, count(*) from (
             select distinct country, year, o_custkey from located) group by 2, 3)
         group by 1""",
)
def repeated_indicator_rows(spark, folder):
    """How many rows a left join on (country, year) would multiply."""
    orders = t.located_orders(spark, folder)
    return repeated_rows(
        {"orders_rows": orders, "customer_rows": orders.select("country", "year", "o_custkey").distinct()}
    )


@query(
    "infinite_and_signed_numbers",
    r"""
    select event_id, case event_type when 'error' then 'inf' when 'click' then '-Infinity'
             when 'view' then 'nan' else concat('+', cast(value as varchar)) end as raw,
           case event_type when 'error' then cast('inf' as double) when 'click' then cast('-inf' as double)
             when 'view' then null else value end as number
    from events""",
)
def infinite_and_signed_numbers(spark, folder):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "error", "inf")
        .when(kind == "click", "-Infinity")
        .when(kind == "view", "nan")
        .otherwise(F.concat(F.lit("+"), F.col("value").cast("string")))
    )
    return (
        t.table(spark, folder, "events")
        .select("event_id", raw.alias("raw"))
        .withColumn("number", parse_number(F.col("raw")))
    )
