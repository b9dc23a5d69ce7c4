import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.operators.quantiles import grouped_quantile, quantile_edges, quantiles, value_counts


def check(spark, data, probabilities):
    df = spark.createDataFrame([(v,) for v in data], "x double")
    row = quantiles(df, {f"q{i}": ("x", p) for i, p in enumerate(probabilities)}).collect()[0]
    present = [v for v in data if v is not None]
    for got, p in zip(row, probabilities):
        if present:
            assert math.isclose(got, np.quantile(present, p), rel_tol=1e-12, abs_tol=1e-12)
        else:
            assert got is None


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), max_size=40
    )
)
def test_matches_linear_interpolation(spark, data):
    check(spark, data, [0.0, 0.25, 0.5, 0.99, 1.0])


def test_one_value_with_a_third_of_the_rows(spark):
    rng = np.random.default_rng(7)
    data = [float(v) for v in rng.normal(size=2000)] + [0.25] * 1000
    check(spark, data, [0.01, 0.3, 0.5, 0.6, 0.75, 0.99])


def test_many_slices(spark):
    """Ranks are right when the values are spread over many range partitions."""
    settings_before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rng = np.random.default_rng(3)
        check(spark, [float(v) for v in rng.exponential(size=5000)], [0.0, 0.1, 0.5, 0.9, 1.0])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", settings_before)


def test_expressions_and_several_columns(make):
    df = make([(-1.0, 1), (2.0, 2), (4.0, None)], "a double, b int")
    positive = F.when(F.col("a") > 0, F.col("a"))
    out = quantiles(df, {"m": (positive, 0.5), "b0": ("b", 0.0), "b1": ("b", 1.0)})
    assert values(out) == [(3.0, 1.0, 2.0)]


def test_entry_named_like_another_column(make):
    df = make([(float(v),) for v in (-4, 1, 2, 3, 5)], "fare double")
    positive = F.when(F.col("fare") > 0, F.col("fare"))
    out = quantiles(df, {"fare": (positive, 0.5), "q1": ("fare", 0.25)})
    assert values(out) == [(2.5, 1.0)]


def test_approximate_mode_and_unknown_mode(make):
    df = make([(float(i),) for i in range(1, 102)], "x double")
    assert values(quantiles(df, {"m": ("x", 0.5)}, "approx")) == [(51.0,)]
    with pytest.raises(ValueError):
        quantiles(df, {"m": ("x", 0.5)}, "guess")


def test_value_counts_skip_nulls(make):
    df = make([(1.0, 5), (1.0, None), (None, 5)], "x double, y int")
    assert sorted(values(value_counts(df, {"x": "x", "y": "y"}))) == [("x", 1.0, 2), ("y", 5.0, 2)]


def test_grouped_quantile_and_edges(make):
    rows = [(k, float(v)) for k, n in ((1, 11), (2, 4), (3, 1)) for v in range(n)]
    df = make(rows + [(None, 1.0), (4, None)], "k int, v double")
    assert sorted(values(grouped_quantile(df, "k", "v", 0.5, "m", groups=4))) == [(1, 5.0), (2, 1.5), (3, 0.0)]
    edges, names = quantile_edges(make([(float(i),) for i in range(11)], "x double"), "x", 5)
    assert names == ["edge_1", "edge_2", "edge_3", "edge_4"]
    assert values(edges) == [(2.0, 4.0, 6.0, 8.0)]
