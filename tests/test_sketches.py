import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.operators import sketches

SF = "/root/testdata/sf0.01"


def monthly(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    return lines.select(
        "l_extendedprice", "l_quantity", "l_linenumber", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    )


def off(data, value, p):
    """By how much the rank of a value misses a share, ties counting in its favour."""
    below, upto = (data < value).mean(), (data <= value).mean()
    return max(below - p, p - upto, 0)


def test_merged_quantiles_stay_within_the_error(spark, tmp_path):
    rows, path = monthly(spark), str(tmp_path / "s")
    sketches.land_sketches(rows, ["l_extendedprice", "l_quantity"], ["year", "month"], path)
    shares = {f"p{i}": i / 20 for i in range(21)}
    stored = sketches.read_sketches(spark, path)
    assert stored.count() == 2 * rows.select("year", "month").distinct().count()
    data = rows.toPandas()
    for r in sketches.merged_quantiles(stored, shares).collect():
        column = data[r.series].to_numpy()
        assert (r.n, r.low, r.high) == (len(column), column.min(), column.max())
        assert (r.p0, r.p20) == (r.low, r.high)
        for name, p in shares.items():
            assert off(column, r[name], p) <= 2 * sketches.rank_error()
    for r in sketches.merged_quantiles(stored, {"half": 0.5}, ["year"]).collect():
        column = data[data.year == r.year][r.series].to_numpy()
        assert r.n == len(column) and off(column, r.half, 0.5) <= 2 * sketches.rank_error()


def test_a_month_that_lands_again_takes_the_place_of_its_sketch(spark, tmp_path):
    rows, path = monthly(spark), str(tmp_path / "s")
    sketches.land_sketches(rows.filter("l_linenumber = 1"), ["l_quantity"], ["year", "month"], path)
    before = {(r.year, r.month): (r.n, bytes(r.sketch)) for r in sketches.read_sketches(spark, path).collect()}
    sketches.land_sketches(rows.filter("year = 1995"), ["l_quantity"], ["year", "month"], path)
    after = {(r.year, r.month): (r.n, bytes(r.sketch)) for r in sketches.read_sketches(spark, path).collect()}
    whole = {(r.year, r.month): r["count"] for r in rows.groupBy("year", "month").count().collect()}
    for month, (n, sketch) in after.items():
        if month[0] == 1995:
            assert n == whole[month]
        else:
            assert (n, sketch) == before[month]
    only = sketches.read_sketches(spark, path, "year = 1995")
    assert only.agg(F.sum("n")).first()[0] == rows.filter("year = 1995").count()
    assert "PartitionFilters: [isnotnull(year" in only._jdf.queryExecution().executedPlan().toString()


def test_nulls_nan_and_columns_without_values(make):
    rows = [(1, 1.0, None), (1, None, None), (1, float("nan"), None), (2, None, None), (2, 3.0, None)]
    found = sketches.sketch_columns(make(rows, "g int, x double, y double"), {"a": "x", "b": F.col("y"), "c": F.col("x") * 2}, ["g"])
    assert sorted(values(found, "g", "series", "n", "low", "high")) == [
        (1, "a", 1, 1.0, 1.0), (1, "b", 0, None, None), (1, "c", 1, 2.0, 2.0),
        (2, "a", 1, 3.0, 3.0), (2, "b", 0, None, None), (2, "c", 1, 6.0, 6.0),
    ]
    merged = sketches.merged_quantiles(found, {"least": 0.0, "most": 1.0})
    assert sorted(values(merged)) == [("a", 2, 1.0, 3.0, 1.0, 3.0), ("c", 2, 2.0, 6.0, 2.0, 6.0)]


def test_shares_and_fences(make):
    data = np.arange(1, 101, dtype=float)
    found = sketches.sketch_columns(make([(float(v),) for v in data], "x double"), ["x"])
    assert values(sketches.merged_shares(found, {"half": 50.0, "all": 1000.0, "none": 0.0})) == [("x", 100, 0.5, 1.0, 0.0)]
    ((_, n, q1, median, q3, low, high),) = values(sketches.sketched_fences(found))
    assert (n, q1, median, q3) == (100, 25.0, 50.0, 75.0) and (low, high) == (q1 - 75, q3 + 75)


def test_empty_table_and_clashing_names(make):
    empty = make([], "g int, x double")
    assert values(sketches.sketch_columns(empty, ["x"], ["g"])) == []
    assert values(sketches.merged_quantiles(sketches.sketch_columns(empty, ["x"]), {"m": 0.5})) == []
    with pytest.raises(ValueError, match="sketch"):
        sketches.sketch_columns(make([(1, 1.0)], "sketch int, x double"), ["x"], ["sketch"])
    # Columns may have the names of the result.
    rows = make([(1, 2.0)], "g int, n double")
    assert values(sketches.sketch_columns(rows, ["n"], ["g"]), "series", "n", "low") == [("n", 1, 2.0)]


def test_one_sketch_per_task_and_group_is_shuffled(spark):
    found = sketches.sketch_columns(monthly(spark), ["l_quantity"], ["year"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan
