import math

import numpy as np
import pandas as pd

from tests.conftest import values
from tripmart.operators import profile

ROWS = [(i, None if i % 4 == 0 else float(i % 7), "Y" if i % 3 else None, 1) for i in range(40)]
SCHEMA = "id int, x double, f string, one int"


def test_schema_table(make):
    out = values(profile.schema_table(make(ROWS, SCHEMA), "id", samples=3))
    assert [r[1:5] for r in out] == [
        (1, "int", 40, 0.0),
        (2, "double", 30, 25.0),
        (3, "string", 26, 35.0),
        (4, "int", 40, 0.0),
    ] or [r[:5] for r in out] == [
        ("id", 1, "int", 40, 0.0),
        ("x", 2, "double", 30, 25.0),
        ("f", 3, "string", 26, 35.0),
        ("one", 4, "int", 40, 0.0),
    ]
    samples = {r["column_name"]: r["samples"] for r in profile.column_samples(make(ROWS, SCHEMA), "id", 3).collect()}
    assert samples == {"id": "0, 1, 2", "x": "1.0, 2.0, 3.0", "f": "Y, Y, Y", "one": "1, 1, 1"}


def test_samples_of_an_empty_column_and_width(make):
    df = make([(1, None, "a" * 100)], "id int, x double, s string")
    samples = {r["column_name"]: r["samples"] for r in profile.column_samples(df, "id").collect()}
    assert samples["x"] == "" and samples["s"] == "a" * 60


def test_missing_table_and_chart(make):
    df = make(ROWS, SCHEMA)
    assert values(profile.missing_table(df)) == [("f", 14, 35.0), ("x", 10, 25.0)]
    assert values(profile.missing_chart(df)) == [(2, "x", 25.0), (3, "f", 35.0)]
    whole = make([(1,)], "a int")
    assert values(profile.missing_table(whole)) == []
    assert values(profile.missing_chart(whole)) == [(0, "(no nulls)", 0.0)]


def test_empty_table(make):
    df = make([], "a int, b double")
    assert values(profile.missing_table(df)) == []
    assert values(profile.duplicate_summary(df)) == [(0, 0)]
    summary = values(profile.numeric_summary(df))
    assert summary == [("a", None, None, None, None, None), ("b", None, None, None, None, None)]
    issues = profile.quality_issues(df, profile.QualityRules(("a",), ("b",), ("b",), ("a",), {}))
    assert sorted(values(issues, "issue", "issue_count", "pct")) == [
        ("duplicate rows", 0, 0.0),
        ("negative values", 0, 0.0),
        ("non-positive values", 0, 0.0),
    ]


def test_numeric_summary_against_pandas(make):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"a": rng.normal(size=101), "b": rng.integers(0, 9, 101).astype(float)})
    out = {r["column_name"]: r for r in profile.numeric_summary(make(list(data.itertuples(index=False, name=None)), "a double, b double")).collect()}
    for c in "ab":
        want = data[c].agg(["mean", "median", "std", "min", "max"])
        got = [out[c][k] for k in ("mean", "median", "std_dev", "min", "max")]
        assert np.allclose(got, want, atol=6e-5)


def test_quality_issues(make):
    rows = [(10.0, 1.0, 20.0, 1.0, "Y")] * 2 + [
        (-1.0, 0.0, 21.0, None, "N"),
        (-2.0, -1.0, 22.0, 1.0, None),
        (5.0, 2.0, 23.0, 1.0, "X"),
        (5.0, None, 500.0, 1.0, "N"),
    ]
    df = make(rows, "fare_amount double, trip_distance double, total_amount double, passenger_count double, store_and_fwd_flag string")
    found = {(i, c): (n, p) for i, c, n, p, _ in values(profile.quality_issues(df))}
    assert found == {
        ("duplicate rows", "(entire row)"): (1, 16.67),
        ("negative values", "fare_amount"): (2, 33.33),
        ("non-positive values", "trip_distance"): (2, 33.33),
        ("outliers", "total_amount"): (1, 16.67),
        ("missing values", "passenger_count"): (1, 16.67),
        ("missing flag", "store_and_fwd_flag"): (1, 16.67),
        ("unexpected flag values", "store_and_fwd_flag"): (1, 16.67),
    }
    assert all(a for *_, a in values(profile.quality_issues(df)))


def test_issue_of_nothing_missing_is_not_listed(make):
    df = make([(1.0,)], "passenger_count double")
    assert [i for i, *_ in values(profile.quality_issues(df))] == ["duplicate rows"]


def test_histogram_against_numpy(make):
    rng = np.random.default_rng(11)
    data = rng.exponential(size=800)
    out = profile.histograms(make([(float(v),) for v in data] + [(None,)], "x double"), ["x"], digits=12)
    shown = data[data <= np.quantile(data, 0.99)]
    counts, edges = np.histogram(shown, bins=50)
    got = out.collect()
    assert [r["bin_count"] for r in got] == list(counts)
    assert np.allclose([r["bin_low"] for r in got], edges[:-1])
    assert np.allclose([r["bin_high"] for r in got], edges[1:])
    assert math.isclose(got[0]["mean"], shown.mean(), rel_tol=1e-9)


def test_histogram_of_a_constant(make):
    got = profile.histograms(make([(3.0,)] * 5, "x double"), ["x"]).collect()
    counts, edges = np.histogram([3.0] * 5, bins=50)
    assert [r["bin_count"] for r in got] == list(counts)
    assert got[0]["bin_low"] == 2.5 and got[-1]["bin_high"] == 3.5


def density(data, points):
    h = data.std(ddof=1) * len(data) ** -0.2
    z = (points[:, None] - data[None, :]) / h
    return np.exp(-0.5 * z * z).sum(axis=1) / (len(data) * h * np.sqrt(2 * np.pi))


def test_density_against_direct_sum(make):
    rng = np.random.default_rng(2)
    data = np.round(rng.gamma(2.0, size=500), 2)
    df = make([(float(v),) for v in data], "x double")
    shown = data[data <= np.quantile(data, 0.99)]
    grid = np.linspace(shown.min(), shown.max(), 200)
    got = [r["density"] for r in profile.densities(df, ["x"]).collect()]
    assert np.allclose(got, density(shown, grid), atol=1e-6)
    coarse = [r["density"] for r in profile.densities(df, ["x"], cells=400).collect()]
    assert np.allclose(coarse, density(shown, grid), atol=5e-3)


def test_density_needs_spread(make):
    assert profile.densities(make([(1.0,)] * 3, "x double"), ["x"]).count() == 0


def test_samples_against_a_plain_sort(make):
    rng = np.random.default_rng(8)
    rows = [
        (None if rng.random() < 0.1 else int(rng.integers(0, 12)), None if rng.random() < 0.3 else f"v{rng.integers(0, 40)}", None, float(i))
        for i in range(700)
    ]
    df = make(rows, "k int, s string, z string, x double").repartition(13)
    for order_by, n in (("k", 7), (None, 5), ("x", 3)):
        place = {"k": 0, "x": 3, None: None}[order_by]
        got = {r.column_name: r.samples for r in profile.column_samples(df, order_by, n, width=400).collect()}
        for i, name in enumerate(df.columns):
            key = lambda r: (0, 0) if place is None else (r[place] is not None, r[place] or 0)
            known = sorted((*key(r), str(r[i])) for r in rows if r[i] is not None)
            assert got[name] == ", ".join(v for *_, v in known[:n])


def test_samples_in_the_order_of_any_simple_type(make):
    rows = [(i, i % 2 == 0, f"{i:03d}") for i in range(60, 0, -1)]
    df = make(rows, "i int, b boolean, s string").selectExpr(
        "i", "b", "s", "CAST(i AS DECIMAL(9,2)) AS d", "date_add(DATE'2024-01-01', i) AS day",
        "timestamp_seconds(i) AS t", "CAST(timestamp_seconds(i) AS TIMESTAMP_NTZ) AS ntz", "CAST(i AS FLOAT) AS f",
        "CAST(s AS BINARY) AS bin", "array(i) AS list",
    )
    for order_by in ("i", "s", "d", "day", "t", "ntz", "f", "bin"):
        got = {r.column_name: r.samples for r in profile.column_samples(df, order_by, 3).collect()}
        assert got["i"] == "1, 2, 3" and got["list"] == "[1], [2], [3]"
    assert {r.column_name: r.samples for r in profile.column_samples(df, "b", 2).collect()}["i"] == "1, 11"


def test_samples_of_no_rows_and_of_names_used_inside(make):
    assert values(profile.column_samples(make([], "a int"))) == []
    assert [r[-1] for r in values(profile.schema_table(make([], "a int")))] == [None]
    df = make([("x", 2, 3)], "value string, place int, c0 int")
    assert dict(values(profile.column_samples(df, "place"), "column_name", "samples")) == {"value": "x", "place": "2", "c0": "3"}


def test_densities_of_many_blocks_and_tasks(make):
    rng = np.random.default_rng(3)
    data = rng.normal(size=5000)
    df = make([(float(v), float(v) ** 2) for v in data], "x double, y double").repartition(9)
    for column, of in (("x", data), ("y", data**2)):
        shown = of[of <= np.quantile(of, 0.99)]
        grid = np.linspace(shown.min(), shown.max(), 200)
        found = profile.densities(df, ["x", "y"], digits=9).filter(f"column_name = '{column}'").collect()
        assert [r.point for r in found] == list(range(200))
        assert np.allclose([r.density for r in found], density(shown, grid), atol=1e-8)


def test_profile_plans_do_not_multiply_rows(make, spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    dense = profile.densities(df, ["o_totalprice"])._jdf.queryExecution().optimizedPlan().toString()
    # Only the grids of the tasks are exploded, above the task function.
    assert dense.index("posexplode(mass") < dense.index("MapInArrow") and "sequence(" not in dense
    samples = profile.column_samples(df, "o_orderkey")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in samples and "Window" not in samples
