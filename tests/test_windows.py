import statistics

from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.operators import windows


def test_three_ranks_on_ties(make):
    df = make([("a", 3), ("b", 3), ("c", 1), ("d", None)], "k string, v int")
    order = [F.desc("v")]
    df = windows.rank_within(df, "r", order)
    df = windows.rank_within(df, "d", order, kind="dense_rank")
    df = windows.rank_within(df, "n", [F.desc("v"), F.asc("k")], kind="row_number")
    assert sorted(values(df, "k", "r", "d", "n")) == [("a", 1, 1, 1), ("b", 1, 1, 2), ("c", 3, 2, 3), ("d", 4, 3, 4)]


def test_rank_within_partitions_and_ntile(make):
    df = make([(p, v) for p in "xy" for v in range(4)], "p string, v int")
    out = windows.rank_within(df, "r", [F.desc("v")], ["p"])
    assert {(p, v): r for p, v, r in values(out)}[("y", 3)] == 1
    tiles = windows.ntile_within(df, "t", 2, ["v"], ["p"])
    assert sorted(values(tiles.filter("p = 'x'"), "v", "t")) == [(0, 1), (1, 1), (2, 2), (3, 2)]


def test_top_k_with_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 7).alias("g"), F.col("id").alias("v")
    )
    out = windows.top_k(df, 2, [F.desc("v")], ["g"])
    rows = {}
    for v in range(3000):
        rows.setdefault(-1 if v % 3 == 0 else v % 7, []).append(v)
    want = {(g, v, i) for g, vs in rows.items() for i, v in enumerate(sorted(vs)[::-1][:2], 1)}
    assert {tuple(r) for r in values(out, "g", "v", "position")} == want
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_share_of_total(make):
    df = make([("a", 1), ("b", 2), ("c", 1)], "k string, n long")
    assert values(windows.share_of_total(df, "n", "s").orderBy("k"), "s") == [(25.0,), (50.0,), (25.0,)]
    zero = make([("a", 0)], "k string, n long")
    assert values(windows.share_of_total(zero, "n", "s"), "s") == [(None,)]


def test_lag_delta_running_and_moving(make):
    data = [(d, float(d * d)) for d in range(1, 11)]
    df = make(data, "d int, v double")
    out = windows.lag_delta(df, "v", ["d"], "prev", "delta")
    out = windows.running_total(out, "v", ["d"], "total")
    out = windows.moving_average(out, "v", ["d"], "mean", 7).orderBy("d")
    rows = values(out, "prev", "delta", "total", "mean")
    assert rows[0] == (None, None, 1.0, 1.0)
    assert rows[1] == (1.0, 3.0, 5.0, 2.5)
    assert rows[9] == (81.0, 19.0, 385.0, round(sum(d * d for d in range(4, 11)) / 7, 2))


def test_moving_average_counts_rows_not_days(make):
    df = make([(1, 1.0), (100, 3.0)], "d int, v double")
    assert values(windows.moving_average(df, "v", ["d"], "m", 7).orderBy("d"), "m") == [(1.0,), (2.0,)]


def test_deviation_alert(make):
    series = [10.0, 10.1, 9.9, 10.0, 10.1, 9.9, 30.0, 10.0]
    df = make(list(enumerate(series)), "d int, v double")
    rows = values(windows.deviation_alert(df, "v", ["d"]).orderBy("d"), "alert", "moving_sd")
    assert [a for a, _ in rows] == [False] * 6 + [True, False]
    assert rows[0][1] is None
    assert rows[6][1] == round(statistics.stdev(series[:7]), 4)
    strict = windows.deviation_alert(df, "v", ["d"], rows=5, include_current=False).orderBy("d")
    assert values(strict, "alert")[6] == (True,)
