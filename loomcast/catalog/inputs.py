"""Panels derived from the test tables, in Spark and as SQL building blocks.

A product is a part brand, a country a region name, the measure the discounted
revenue of a month. Indicators per region and year come from the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.operators.grid import densify
from loomcast.plans.prepare import (
    features_monthly,
    features_yearly,
    indicator_table,
    master_monthly,
    master_yearly,
)
from loomcast.session import checkpoint
from loomcast.spec import MONTHLY

FIRST, LAST, CUTOFF = 1995, 2001, 2000
INDICATORS = ("active_customers", "urgent_pct", "avg_order_value")
DERIVED = {"urgent_customers": ("urgent_pct", "active_customers")}
ALL_INDICATORS = (*INDICATORS, *DERIVED)
UNSCALED = ("urgent_pct",)
SCALED = ("active_customers", "avg_order_value", "urgent_customers")


# Known column types spare one job per table that would only read file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def located_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the region of their customer, year and month.

    The base tables are joined one by one, so that Spark knows the size of each
    right side from its files and broadcasts the small ones only.
    """
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region").withColumnRenamed("r_name", "country")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("year", F.year("o_orderdate"))
        .withColumn("month", F.month("o_orderdate"))
    )


def exact_total(units: str, scale: int = 10_000):
    """Sum of whole units as a double, correct to the last digit at any size.

    Prices are counted in whole ten-thousandths, which keeps decimals out of
    the per-row work. High and low parts are summed apart, so that no sum of
    64-bit numbers can overflow, and put together once per group.
    """
    high, low = F.sum(F.expr(f"{units} div 1000000")), F.sum(F.expr(f"{units} % 1000000"))
    whole = high.cast("decimal(30,0)") * F.lit(1_000_000).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    return (whole / F.lit(scale).cast("decimal(5,0)")).cast("double")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly revenue per brand and region; exact sums.

    Lines and orders are the two large tables: neither may be broadcast on the
    strength of an estimate, so their join is a merge join at every scale.
    """
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("product"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", (cents("l_extendedprice") * (100 - cents("l_discount"))).alias("units")
    )
    return (
        lines.hint("merge")
        .join(located_orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("product", "country", "year", "month")
        .agg(exact_total("units").alias("value"))
    )


def yearly_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """Region-year indicators as they would arrive, one row per region and year."""
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    spent = exact_total("cents", 100)
    return (
        located_orders(spark, folder)
        .withColumn("cents", cents("o_totalprice"))
        .groupBy("country", "year")
        .agg(
            F.count_distinct("o_custkey").cast("double").alias("active_customers"),
            (urgent * 100.0 / F.count(F.lit(1))).alias("urgent_pct"),
            (spent / F.count(F.lit(1))).alias("avg_order_value"),
        )
    )


def indicator_tables(spark: SparkSession, folder: str, gaps: bool = False) -> dict[str, DataFrame]:
    """One table per indicator; the orders are read once for all of them.

    ``gaps`` is for queries about gaps: two years in ASIA and one in AFRICA are
    then missing everywhere, and EUROPE has no order values at all.
    """
    rows = checkpoint(yearly_indicators(spark, folder))
    if gaps:
        asia = (F.col("country") == "ASIA") & F.col("year").isin(1997, 1998)
        africa = (F.col("country") == "AFRICA") & (F.col("year") == 1995)
        rows = rows.filter(~asia & ~africa)
    tables = {name: rows.select("country", "year", name) for name in INDICATORS}
    if gaps:
        tables["avg_order_value"] = tables["avg_order_value"].filter(F.col("country") != "EUROPE")
    return tables


def dense(spark: SparkSession, folder: str) -> DataFrame:
    return densify(revenue(spark, folder), MONTHLY, FIRST, LAST)


def master(spark: SparkSession, folder: str, gaps: bool = False) -> DataFrame:
    return master_monthly(
        revenue(spark, folder), indicator_tables(spark, folder, gaps), FIRST, LAST, DERIVED, UNSCALED
    )


def monthly_features(
    spark: SparkSession, folder: str, include_current: bool = False, gaps: bool = False
) -> DataFrame:
    return features_monthly(master(spark, folder, gaps), MONTHLY, include_current)


def yearly_features(spark: SparkSession, folder: str) -> DataFrame:
    return features_yearly(master_yearly(master(spark, folder)))


def _with(*blocks: str) -> str:
    return "with " + ",\n".join(b.strip() for b in blocks) + "\n"


LOCATED = f"""
located as (
  select o.*, r_name as country, cast(year(o_orderdate) as int) as year,
         cast(month(o_orderdate) as int) as month
  from orders o join customer on c_custkey = o_custkey
       join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)
"""
PANEL = """
panel as (
  select p_brand as product, country, year, month,
         cast(sum(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))))
              as double) as value
  from lineitem join located on o_orderkey = l_orderkey join part on p_partkey = l_partkey
  group by 1, 2, 3, 4)
"""
GRID = f"""
years as (select cast(range as int) as year from range({FIRST}, {LAST + 1})),
months as (select cast(range as int) as month from range(1, 13)),
grid as (
  select product, country, year, month
  from (select distinct product from panel), (select distinct country from panel), years, months),
dense as (
  select g.*, p.value from grid g left join panel p using (product, country, year, month))
"""
RAW_INDICATORS = """
raw_indicators as (
  select country, year, cast(count(distinct o_custkey) as double) as active_customers,
         count(*) filter (where o_orderpriority = '1-URGENT') * 100.0::double / count(*) as urgent_pct,
         cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as avg_order_value
  from located group by 1, 2),
indicators as (select * from raw_indicators)
"""
GAPPY_INDICATORS = RAW_INDICATORS.replace(
    "indicators as (select * from raw_indicators)",
    """indicators as (
  select country, year, active_customers, urgent_pct,
         case when country <> 'EUROPE' then avg_order_value end as avg_order_value
  from raw_indicators
  where not (country = 'ASIA' and year in (1997, 1998)) and not (country = 'AFRICA' and year = 1995))""",
)
FOLDED = """
folded as (
  select c.country, y.year, i.active_customers, i.urgent_pct, i.avg_order_value,
         i.urgent_pct / 100.0::double * i.active_customers as urgent_customers
  from (select distinct country from panel) c cross join years y
       left join indicators i on i.country = c.country and i.year = y.year)
"""
FILLED = (
    "filled as (select country, year, "
    + ", ".join(
        f"coalesce(last_value({c} ignore nulls) over (partition by country order by year "
        f"rows between unbounded preceding and current row), first_value({c} ignore nulls) over "
        f"(partition by country order by year rows between current row and unbounded following)) as {c}"
        for c in ALL_INDICATORS
    )
    + " from folded)"
)
SCALE = (
    "stats as (select "
    + ", ".join(
        f"avg({c}) as {c}_mean, case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end as {c}_std"
        for c in SCALED
    )
    + " from filled),\nscaled as (select f.*, "
    + ", ".join(f"(f.{c} - {c}_mean) / {c}_std as {c}_norm" for c in SCALED)
    + " from filled f, stats)"
)
MASTER = """
master as (select d.product, d.country, d.year, d.month, d.value, s.* exclude (country, year)
  from dense d left join scaled s on s.country = d.country and s.year = d.year)
"""
WITH_DENSE = _with(LOCATED, PANEL, GRID)
WITH_MASTER = _with(LOCATED, PANEL, GRID, RAW_INDICATORS, FOLDED, FILLED, SCALE, MASTER)
WITH_GAPPY_MASTER = _with(LOCATED, PANEL, GRID, GAPPY_INDICATORS, FOLDED, FILLED, SCALE, MASTER)
TRAIN_TEST = """
observed as (
  select *, row_number() over (partition by product, country order by year desc, month desc) as back,
         count(*) over (partition by product, country) as n_series
  from dense where value is not null),
held as (
  select product, country, year, month, value,
         case when back <= 12 then 'test' else 'train' end as split,
         case when back <= 12 then cast(least(n_series, 12) - back + 1 as int) end as step
  from observed)
"""
NAIVE = """
last_train as (
  select product, country, arg_max(value, year * 12 + month) as naive
  from held where split = 'train' group by 1, 2),
phase_train as (
  select product, country, month, arg_max(value, year) as seasonal_naive
  from held where split = 'train' group by 1, 2, 3),
forecasts as (
  select h.product, h.country, h.year, h.month, h.step, h.value as actual, l.naive, p.seasonal_naive
  from held h left join last_train l using (product, country)
       left join phase_train p using (product, country, month)
  where h.split = 'test')
"""
WITH_NAIVE = _with(LOCATED, PANEL, GRID, TRAIN_TEST, NAIVE)
# Three simple forecasters stand in for fitted models where a query is about
# ranking and combining: last value, same month last year, and their mean.
LONG = """
long_forecasts as (
  select product, country, year, month, actual, 'naive' as model, naive as predicted from forecasts
  union all
  select product, country, year, month, actual, 'seasonal_naive', seasonal_naive from forecasts
  union all
  select product, country, year, month, actual, 'blend', (naive + seasonal_naive) / 2 from forecasts
  union all
  select product, country, year, month, actual, 'low', seasonal_naive * 0.9::double from forecasts)
"""
METRICS = """
metrics as (
  select product, country, model, avg(abs(actual - predicted)) as mae,
         avg(abs(actual - predicted) / greatest(abs(actual), 2.220446049250313e-16)) as mape
  from long_forecasts group by 1, 2, 3),
ranked as (
  select * from (
    select *, row_number() over (partition by product, country order by mape nulls last, model) as rank
    from metrics) where rank <= 3)
"""
WITH_RANKED = _with(LOCATED, PANEL, GRID, TRAIN_TEST, NAIVE, LONG, METRICS)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round derived numbers, as the SQL side does, before results are compared."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def round_sql(digits: int, *columns: str) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


def indicator_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Filled and scaled indicators per region and year."""
    regions = table(spark, folder, "region").select(F.col("r_name").alias("country"))
    return indicator_table(
        regions, indicator_tables(spark, folder), FIRST, LAST, DERIVED, UNSCALED
    )


def yearly_features_with(indicators: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Yearly feature table on indicators that are already there."""
    panel = densify(revenue(spark, folder), MONTHLY, FIRST, LAST).join(indicators, ["country", "year"], "left")
    return features_yearly(master_yearly(panel))
