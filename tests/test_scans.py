"""Running values and ranks over all rows, held against windows in one task and plain Python."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import values
from tests.test_plans import final_plan
from tripmart.operators import scans, windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def series(spark, tmp_path_factory):
    """2,000 rows in 40 files, every seventh value null; a third of the keys equal."""
    path = str(tmp_path_factory.mktemp("series") / "rows")
    spark.range(2000).repartition(40).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        "id",
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 11).cast("decimal(18,2)").alias("v"),
        F.lit("x").alias("_slice"), F.lit(1).alias("_At"), F.lit(2).alias("_value"), F.lit(3).alias("_key0"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_positions_without_gap(series):
    found = values(scans.with_positions(series, ["k", "id"], "p", slices=13), "k", "id", "p")
    want = {(k, i): n for n, (k, i) in enumerate(sorted((k, i) for k, i, _ in found))}
    assert len(found) == 2000 and {(k, i): p for k, i, p in found} == want


@pytest.mark.parametrize("slices", [1, 13, 700])  # 700: slices with fewer rows than the frame
def test_running_values_equal_windows(series, slices):
    got = scans.scan_rows(series, "v", ["k", "id"], "total", "prev", "delta", "mean", slices=slices)
    want = windows.lag_delta(series, "v", ["k", "id"], "prev", "delta")
    want = windows.running_total(want, "v", ["k", "id"], "total")
    want = windows.moving_average(want, "v", ["k", "id"], "mean", 7)
    columns = ("k", "id", "total", "prev", "delta", "mean")

    def plain(df):
        return sorted((k, i, *[x if x is None else float(x) for x in rest]) for k, i, *rest in values(df, *columns))

    assert got.columns == [*series.columns, "total", "prev", "delta", "mean"]
    assert plain(got) == plain(want)


@pytest.mark.parametrize("slices", [1, 13, 700])
def test_ranks_equal_windows_with_ties_over_slices(series, slices):
    got = scans.rank_rows(series, [("k", "desc")], "r", "d", slices=slices)
    over = Window.orderBy(F.desc("k"))
    want = series.withColumn("r", F.rank().over(over)).withColumn("d", F.dense_rank().over(over))
    assert sorted(values(got, "id", "r", "d")) == sorted(values(want, "id", "r", "d"))
    assert got.columns == [*series.columns, "r", "d"]


@pytest.mark.parametrize("tiles", [1, 3, 7, 1999, 2000, 3000])
def test_ntile_equals_window(series, tiles):
    got = scans.rank_rows(series, ["k", "id"], row_number="n", ntile={"t": tiles}, slices=9)
    over = Window.orderBy("k", "id")
    want = series.withColumn("n", F.row_number().over(over)).withColumn("t", F.ntile(tiles).over(over))
    assert sorted(values(got, "id", "n", "t")) == sorted(values(want, "id", "n", "t"))


def test_null_keys_rank_like_a_window(spark, tmp_path):
    spark.range(60).select(F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("k"), "id").repartition(5).write.parquet(str(tmp_path / "n"))
    df = spark.read.parquet(str(tmp_path / "n"))
    for way in ("asc", "desc"):
        got = scans.rank_rows(df, [("k", way)], "r", "d", slices=11)
        over = Window.orderBy(F.desc("k") if way == "desc" else F.asc("k"))
        want = df.withColumn("r", F.rank().over(over)).withColumn("d", F.dense_rank().over(over))
        assert sorted(values(got, "id", "r", "d")) == sorted(values(want, "id", "r", "d"))


def test_a_hot_key_of_equal_rows_fills_several_slices(spark, tmp_path):
    spark.range(3000).select(F.lit(1).alias("k")).repartition(6).write.parquet(str(tmp_path / "hot"))
    sliced = scans.slice_rows(spark.read.parquet(str(tmp_path / "hot")), ["k"], slices=6)
    sizes = [n for _, n in values(sliced.rows.groupBy(sliced.slice).count())]
    assert sum(sizes) == 3000 and len(sizes) == 6 and max(sizes) < 1000


def test_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/events.parquet").filter("false")
    assert values(scans.scan_rows(empty, "value", ["ts"], "t", "p", "d", "m")) == []
    assert values(scans.rank_rows(empty, ["ts"], "r", "d", "n", {"t": 3})) == []
    assert values(scans.with_positions(empty, ["ts"], "p")) == []


def test_only_nulls(spark, tmp_path):
    spark.range(20).select("id", F.lit(None).cast("double").alias("v")).write.parquet(str(tmp_path / "z"))
    df = spark.read.parquet(str(tmp_path / "z"))
    assert set(values(scans.scan_rows(df, "v", ["id"], "t", "p", "d", "m", slices=3), "t", "p", "d", "m")) == {(None,) * 4}


def test_no_task_gets_all_rows(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    for df in (
        scans.scan_rows(events, "value", ["ts", "event_id"], "t", "p", "d", "m"),
        scans.rank_rows(events, ["ts"], "r", "d", "n", {"tile": 4}),
        scans.with_positions(events, ["ts"], "p"),
    ):
        plan = final_plan(df)
        for window in re.findall(r"Window \[.*", plan):
            # The window's second list is its partition: never empty.
            assert re.search(r"\], \[[^\]]+\], \[", window), window
        assert "CartesianProduct" not in plan


def test_row_numbers_group_no_key(series):
    """Row numbers and tiles keep one group per slice, not one per key, in any task."""
    got = scans.rank_rows(series, ["k", "id"], row_number="n", ntile={"t": 4}, slices=9)
    for aggregate in re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", final_plan(got)):
        assert "_key" not in aggregate, aggregate
    over = Window.orderBy("k", "id")
    want = series.withColumn("n", F.row_number().over(over)).withColumn("t", F.ntile(4).over(over))
    assert sorted(values(got, "id", "n", "t")) == sorted(values(want, "id", "n", "t"))


def test_slices_grow_with_the_rows(spark, series, monkeypatch):
    monkeypatch.setattr(scans, "SLICE_ROWS", 100)
    sliced = scans.slice_rows(series, ["k", "id"])
    sizes = [n for _, n in values(sliced.rows.groupBy(sliced.slice).count())]
    assert sum(sizes) == 2000 and max(sizes) <= 150 and len(sizes) > 8
