"""Registered queries against their SQL on the smallest test data."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import difference, reference

from .conftest import plan_of

FOLDER = "/root/testdata/sf0.001"
#: Nodes of a plan that run Python.
PYTHON = re.compile("ArrowEvalPython|BatchEvalPython|InPandas|InArrow|FlatMapGroups")


@pytest.fixture(scope="module")
def duck():
    return reference(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = queries()[name](spark, FOLDER)
    assert not PYTHON.search(plan_of(got)) or name.startswith(("holt", "trend", "granger", "arima", "gbt", "backtest"))
    assert "CartesianProduct" not in plan_of(got) and "NestedLoop" not in plan_of(got)
    found = difference(got.toPandas(), duck.execute(oracle_sql()[name]).df())
    assert found is None, found


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


TREES = [
    "random_forest", "gbt_deep", "gbt_small", "select_tree_importance", "attribution_trees", "backtest_metrics", "backtest_yearly_metrics",
    "future_forecast_monthly", "future_forecast_yearly", "future_forecast_yearly_rows", "scenarios_of_top_models",
]


@pytest.mark.parametrize("name", TREES)
def test_tree_queries_ask_for_full_rounds(spark, monkeypatch, name):
    """The first fit of each query is asked for 100 rounds of the default depth, and is then broken off."""
    from loomcast.operators import selection
    from loomcast.operators.models import trees

    class Asked(Exception):
        pass

    def asked(kind, rounds, depth=None):
        raise Asked(rounds, depth)

    monkeypatch.setattr(trees, "regressor", asked)
    monkeypatch.setattr(selection, "regressor", asked)
    with pytest.raises(Asked) as found:
        # the smallest data have no ranked model for the monthly future
        queries()[name](spark, FOLDER.replace("0.001", "0.01") if name == "future_forecast_monthly" else FOLDER).count()
    assert found.value.args in ((100, None), (100, 10))
