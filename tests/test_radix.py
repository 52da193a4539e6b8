"""Radix selection against numpy and the sketch search."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envstats.operators import quantiles, radix


def _quantile(x, p):
    return float(np.quantile(np.asarray(x, dtype=float), p, method="linear"))


def test_binades_keep_the_order_and_split_at_powers(spark):
    around = [math.nextafter(2.0**e, to) for e in range(-1022, 1024) for to in (0.0, math.inf)]
    edge = [0.0, 5e-324, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, 0.1, 3.0]
    values = edge + around + [2.0**e for e in range(-1074, 1024)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = sorted((r["x"], r["k"]) for r in df.select("x", radix.binade(F.col("x")).alias("k")).collect())
    digits = [k for _, k in got]
    assert digits == sorted(digits)
    size: dict = {}
    for x, k in got:
        size.setdefault(k, []).append(x)
    for k, xs in size.items():
        assert xs[0] == xs[-1] or max(map(abs, xs)) <= 2.0 * (1 + 1e-9) * min(map(abs, xs))
        if xs[0] != xs[-1]:
            assert (xs[-1] - xs[0]) / math.ulp(min(map(abs, xs))) <= 2.0**54


@pytest.mark.parametrize("bits", [3, 8, 12])
@pytest.mark.parametrize("share", [0, 10**9])
def test_quantiles_match_numpy(spark, bits, share):
    rng = np.random.default_rng(1)
    a = rng.normal(0, 1e3, 4000)                       # both signs
    b = np.round(rng.normal(10, 3, 4000), 1)           # many ties
    c = np.where(rng.random(4000) < 0.34, 0.25, rng.lognormal(0, 5, 4000))     # one hot value
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c)], "a double, b double, c double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    for r in radix.radix_quantiles(df, ["a", "b", "c"], probs, bits=bits, write_share=share).collect():
        assert r["n"] == 4000
        want = _quantile({"a": a, "b": b, "c": c}[r["column"]], r["p"])
        assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_box_stats_equal_the_sketch_search(spark):
    rng = np.random.default_rng(4)
    rows = [(float(x), None if i % 5 else float(x) ** 3, math.nan if i % 3 else -float(i), None)
            for i, x in enumerate(rng.normal(0, 1, 3000))]
    df = spark.createDataFrame(rows, "a double, b double, c double, none double")
    cols = ["a", "b", "c", "none"]
    assert radix.box_stats(df, cols).collect() == quantiles.box_stats(df, cols).collect()


def test_empty_and_infinite(spark):
    empty = spark.createDataFrame([], "a double")
    assert [tuple(r) for r in radix.radix_quantiles(empty, ["a"], (0.5,)).collect()] == [("a", 0.5, None, 0)]
    assert radix.box_stats(empty, ["a"]).first()["n"] == 0
    ends = spark.createDataFrame([(math.inf,), (-math.inf,), (0.0,), (-0.0,), (5e-324,)], "a double")
    got = [r["value"] for r in radix.radix_quantiles(ends, ["a"], (0.0, 0.25, 0.5, 0.75, 1.0)).collect()]
    assert got == [-math.inf, 0.0, 0.0, 5e-324, math.inf]


def test_integers_take_one_pass_and_no_pass_multiplies_groups(spark, monkeypatch):
    passes = []
    digits = radix._digits
    monkeypatch.setattr(radix, "_digits", lambda inside: passes.append(1) or digits(inside))
    df = spark.range(2000).select((F.col("id") % 2).cast("double").alias("a"))
    radix.order_statistics(df, ["a"], (0.25, 0.5, 0.75))
    assert len(passes) == 1
    passes.clear()
    df = spark.range(20000).select((F.hash("id") / 7.0).alias("a"), F.rand(1).alias("b"))
    radix.order_statistics(df, ["a", "b"], (0.25, 0.5, 0.75))
    assert len(passes) <= 1 + -(-54 // radix.BITS)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=40),
       probs=st.lists(st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]), min_size=1, max_size=3, unique=True),
       bits=st.integers(1, 12))
def test_any_values(spark, values, probs, bits):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    exact = sorted(v + 0.0 for v in values)
    counts, found = radix.order_statistics(df, ["x"], tuple(probs), bits=bits)
    assert counts == [len(values)]
    assert found == {(0, k): exact[k] for k in radix._ranks(len(values), probs)}


def test_passes_over_columns_make_no_row_per_value(spark, monkeypatch):
    """Digits and fences of the columns are counted in the tasks; values get rows only when few are written."""
    def none(*_):
        raise AssertionError("a row per value")

    rows = [(float(i % 97) ** 3, None if i % 5 == 0 else -1.5 ** (i % 50), float("nan")) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    want = quantiles.box_stats(df, ["a", "b", "c"]).collect()
    monkeypatch.setattr(radix, "long_values", none)
    assert radix.box_stats(df, ["a", "b", "c"], write_share=10**9).collect() == want
