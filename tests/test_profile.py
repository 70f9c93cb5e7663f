import numpy as np
import pandas as pd
import pytest

from loomcast.operators.profile import describe, missing_report, quantiles, run_statistics, value_counts


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.exponential(size=997) * 50, 2)
    x[: 997 // 3] = 7.25  # a third of all rows share one value
    pdf = pd.DataFrame({"x": x, "k": rng.integers(0, 9, 997), "s": [f"s{v}" for v in rng.integers(0, 5, 997)]})
    pdf.loc[5:20, "x"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, k int, s string")
    return pdf, df.repartition(4)


def test_missing_report(frame):
    got = {r.column_name: r for r in missing_report(frame[1], "t").collect()}
    assert (got["x"].n, got["x"].nulls, got["x"].data_type) == (997, 16, "double")
    assert got["x"].null_pct == pytest.approx(1600 / 997) and got["s"].nulls == 0


@pytest.mark.parametrize("pieces", [3, 128])
def test_quantiles_are_exact_whatever_the_cut(frame, pieces):
    pdf, df = frame
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    counts = value_counts(df, ["x", "k", "s"])
    got = {r.column_name: list(r)[1:] for r in quantiles(counts, probabilities, pieces).collect()}
    for c in ("x", "k"):
        assert got[c] == pytest.approx(list(pdf[c].astype(float).quantile(probabilities)))
    assert "s" not in got


def test_describe_matches_pandas(frame):
    pdf, df = frame
    got = {r.column_name: r for r in describe(df, ["x", "k", "s"]).collect()}
    for c in ("x", "k"):
        d, r = pdf[c].astype(float).describe(), got[c]
        assert [r.n, r.mean, r.std, r.min, r.q1, r.median, r.q3, r.max] == pytest.approx(list(d))
        assert r.n_unique == pdf[c].nunique()
    assert float(got["x"].top) == 7.25 and got["x"].freq == (pdf.x == 7.25).sum()
    top = pdf.s.value_counts()
    assert got["s"].freq == top.iloc[0] and got["s"].mean is None and got["s"].n_unique == 5


def test_run_statistics(frame):
    row = run_statistics(frame[1], ["k"], ["k", "s"]).first()
    assert (row.n_rows, row.min_k, row.max_k, row.n_k, row.n_s) == (997, 0, 8, 9, 5)
