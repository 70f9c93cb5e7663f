import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loomcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Frame from a schema string and rows."""

    def build(schema, rows):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def monthly(spark):
    """Monthly panel from {(product, country): [values]}, starting January 2011."""

    def build(series, first=2011):
        rows = [
            (p, c, first + i // 12, i % 12 + 1, None if v is None else float(v))
            for (p, c), values in series.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "product string, country string, year int, month int, value double")

    return build


def plan_of(df) -> str:
    """Physical plan as planned, also after a run has adapted it."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def as_dict(df, key, value):
    return {tuple(r[k] for k in key): r[value] for r in df.collect()}
