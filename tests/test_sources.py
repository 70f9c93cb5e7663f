import json

import pytest
from pyspark.sql import functions as F

from loomcast.sources.readers import (
    read_csv_after_preamble,
    read_long_indicator,
    read_measure,
    read_wide_indicator,
    read_wide_indicators,
)
from loomcast.sources.tables import read_table, write_by_series, write_table

PREAMBLE = '"Data Source","Indicators"\n\n"Last Updated","2024"\n\n'


def write(path, text):
    path.write_text(text)
    return str(path)


def test_measure_keeps_code_and_maps_country(spark, tmp_path):
    path = write(
        tmp_path / "revenue.csv",
        "Country,Product,Year,Month,Value\nCountry_A,P-1,2011,1,10.5\nCountry_Z,P-1,2011,2,\"$1,000\"\n",
    )
    rows = read_measure(spark, path, {"Country_A": "India"}).orderBy("month").collect()
    assert [(r.country_actual, r.country, r.product, r.year, r.month, r.value) for r in rows] == [
        ("Country_A", "India", "P-1", 2011, 1, 10.5),
        ("Country_Z", None, "P-1", 2011, 2, 1000.0),
    ]


def test_long_indicator_filters_unit_and_years_and_survives_colliding_headers(spark, tmp_path):
    path = write(
        tmp_path / "long.csv",
        "REF,Reference area,TIME_PERIOD,Time period,OBS_VALUE,Obs value,Unit of measure\n"
        "x,India,2011-Q1,ignored,1.5,9,Per 1 000 inhabitants\n"
        "x,India,2010,ignored,1.4,9,Per 1 000 inhabitants\n"
        "x,India,20x1,ignored,1.4,9,Per 1 000 inhabitants\n"
        "x,India,2012,ignored,300,9,Persons\n",
    )
    rows = read_long_indicator(spark, path, "physicians", "Per 1 000 inhabitants").collect()
    assert [tuple(r) for r in rows] == [("India", 2011, "1.5")]


def test_wide_indicator_without_preamble(spark, tmp_path):
    path = write(
        tmp_path / "wide.csv",
        "Country Name,Code,2010,2011,2012 ,2012 [YR2012]\nIndia,IN,1,2,3,4\nChina,CN,5,,7,8\n",
    )
    rows = read_wide_indicator(spark, path, "population").orderBy("country", "year").collect()
    assert [tuple(r) for r in rows] == [
        ("China", 2011, None),
        ("China", 2012, "7"),
        ("India", 2011, "2"),
        ("India", 2012, "3"),
    ]


def test_preamble_is_skipped_exactly(spark, tmp_path):
    text = PREAMBLE + 'Country Name,2011,2012,\n"Korea, Rep.",1,2,\nIndia,"1,000",,\n'
    path = write(tmp_path / "pre.csv", text)
    df = read_csv_after_preamble(spark, path)
    assert df.columns == ["country_name", "2011", "2012", "unnamed_3"]
    assert {r.country_name for r in df.collect()} == {"Korea, Rep.", "India"}
    long = read_wide_indicators(spark, {"usage": path})["usage"]
    assert {(r.country, r.year): r.usage for r in long.collect()}[("India", 2011)] == "1,000"
    assert long.count() == 4


def test_file_without_header_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        read_csv_after_preamble(spark, write(tmp_path / "short.csv", "a\nb\n"))


def test_sinks(spark, make, tmp_path):
    df = make(
        "product string, country string, model string, year int, mape double",
        [("P-1", "New Land", "rf", 2011, 0.5), ("P-1", "India", "lgb", 2012, None)],
    )
    write_table(df, str(tmp_path / "t"), partition_by=("year",))
    back = read_table(spark, str(tmp_path / "t"))
    assert back.filter("year = 2011").select("mape").collect()[0][0] == 0.5
    assert "PartitionFilters: [isnotnull(year" in back.filter("year = 2011")._jdf.queryExecution().executedPlan().toString()
    write_by_series(df, str(tmp_path / "m"), "json")
    files = list((tmp_path / "m").rglob("*.json"))
    assert len(files) == 2
    (one,) = [f for f in files if "model=rf" in str(f)]
    assert "product=P-1" in str(one) and json.loads(one.read_text()) == {"year": 2011, "mape": 0.5}
    write_table(df, str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).filter(F.col("model") == "rf").count() == 1
