import math

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcast.functions.text import finite, null_if_nan, parse_number, parse_year, snake_case, snake_case_column

HEADERS = {
    "Country Name": "country_name",
    "countryName2X": "country_name2_x",
    "OBS_VALUE": "obs_value",
    "Obs value": "obs_value",
    "2011 [YR2011]": "2011_yr2011",
    "2011": "2011",
    "__a--b__": "a_b",
}


def test_headers_become_snake_case():
    assert {h: snake_case(h) for h in HEADERS} == HEADERS


def test_column_form_agrees_with_the_header_form(make):
    df = make("h string", [(h,) for h in HEADERS]).withColumn("s", snake_case_column(F.col("h")))
    assert {r.h: r.s for r in df.collect()} == HEADERS


@given(st.text(max_size=40))
def test_snake_case_is_idempotent(text):
    once = snake_case(text)
    assert snake_case(once) == once and not once.startswith("_") and not once.endswith("_")


def test_numbers_out_of_dirty_text(make):
    cases = {
        "$1,234.5": 1234.5,
        "": None,
        "nan": None,
        "inf": math.inf,
        "-Infinity": -math.inf,
        "12d": None,
        "0x1f": None,
        " 7 ": 7.0,
        "n/a": None,
        "-1e3": -1000.0,
        "+.5": 0.5,
        "1.": 1.0,
        "..": None,
    }
    df = make("s string", [(s,) for s in cases] + [(None,)]).withColumn("x", parse_number(F.col("s")))
    got = {r.s: r.x for r in df.collect()}
    assert got.pop(None) is None
    assert got == cases


def test_years_out_of_mixed_text(make):
    cases = {"2011": 2011, "2011-Q1": 2011, "2010": 2010, "20x1": None, "": None}
    df = make("s string", [(s,) for s in cases]).withColumn("y", parse_year(F.col("s")))
    assert {r.s: r.y for r in df.collect()} == cases


def test_finite_and_nan(make):
    rows = [(1.0,), (None,), (math.nan,), (math.inf,)]
    df = make("x double", rows).select(finite(F.col("x")).alias("f"), null_if_nan(F.col("x")).alias("n"))
    assert [(r.f, r.n) for r in df.collect()] == [(True, 1.0), (False, None), (False, None), (False, math.inf)]
