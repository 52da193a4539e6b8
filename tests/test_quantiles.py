import numpy as np
import pytest

from envstats.operators import quantiles


def _np_quantile(x, p):
    return float(np.quantile(np.asarray(x, dtype=float), p, method="linear"))


@pytest.mark.parametrize("final_rows", [50, 1000, 10**9])
def test_exact_quantiles_match_numpy(spark, final_rows):
    rng = np.random.default_rng(1)
    a = rng.lognormal(0, 2, 5000)
    b = np.round(rng.normal(10, 3, 5000), 1)           # many ties
    pdf_rows = [(float(x), float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(pdf_rows, "a double, b double")
    # small accuracy / final_rows force several refinement passes
    q = quantiles.exact_quantiles(df, ["a", "b"], (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0),
                                  accuracy=200, grid=20, final_rows=final_rows)
    for r in q.collect():
        src = a if r["column"] == "a" else b
        assert r["n"] == 5000
        assert r["value"] == pytest.approx(_np_quantile(src, r["p"]), rel=1e-12, abs=1e-12)


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(2)
    vals = list(rng.normal(0, 1, 4000)) + [0.25] * 2000     # one value holds 1/3
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    q = quantiles.exact_quantiles(df, ["x"], (0.25, 0.5, 0.6, 0.75), accuracy=100, grid=10,
                                  final_rows=30)
    for r in q.collect():
        assert r["value"] == pytest.approx(_np_quantile(vals, r["p"]), rel=1e-12, abs=1e-12)


def test_nulls_and_nan_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    r = {x["p"]: x["value"] for x in quantiles.exact_quantiles(df, ["x"], (0.5,)).collect()}
    assert r[0.5] == 2.0


def test_box_stats_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 3000), [15.0, -12.0, 30.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = quantiles.box_stats(df, ["x"], accuracy=100, grid=10, final_rows=100).first()
    q1, q3 = _np_quantile(x, 0.25), _np_quantile(x, 0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = x[(x >= lo) & (x <= hi)]
    assert r["q1"] == pytest.approx(q1) and r["q3"] == pytest.approx(q3)
    assert r["whisker_low"] == inside.min() and r["whisker_high"] == inside.max()
    assert r["n_outliers"] == int(((x < lo) | (x > hi)).sum())
    assert r["outlier_fraction"] == pytest.approx(r["n_outliers"] / len(x))


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.integers(-20, 20).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False)),
                       min_size=1, max_size=400),
       probs=st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4, unique=True))
def test_exact_quantiles_property(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    q = quantiles.exact_quantiles(df, ["x"], tuple(probs), accuracy=20, grid=4, final_rows=5)
    for r in q.collect():
        assert r["value"] == pytest.approx(_np_quantile(values, r["p"]), rel=1e-9, abs=1e-9)
