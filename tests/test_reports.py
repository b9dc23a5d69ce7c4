import math
import re

import pytest
from pyspark.sql import functions as F

from checks.trip_source import NUDGE, RULES, raw_trips
from tests.conftest import values
from tripmart.operators.validation import require_rows, validate_tables
from tripmart.plans import charts, reports, warehouse
from tripmart.plans.trip_rules import FACT_COLUMNS, TIME_ORDER
from tripmart.sources.workspace import workspace

SF = "/root/testdata/sf0.001"
FACT_SCHEMA = (
    "pickup_date date, pickup_hour int, pickup_dayofweek int, time_of_day string, PULocationID long, "
    "VendorID long, passenger_count int, trip_distance double, trip_duration_mins double, "
    "payment_type long, payment_label string, fare_amount double, tip_amount double, tip_pct double, "
    "total_amount double, revenue_per_mile double"
)


@pytest.fixture(scope="module")
def built(spark):
    return warehouse.build_warehouse(spark, raw_trips(spark, SF), workspace(spark, "w"), RULES)


@pytest.fixture(scope="module")
def fact(spark, built):
    return built.table(spark, "fact_trips")


def total(df, column="trip_count"):
    return df.agg(F.sum(column)).collect()[0][0]


def test_stored_tables(spark, built, fact):
    assert set(built.paths) == {"fact_trips", *warehouse.DIMENSIONS}
    assert set(fact.columns) == {*FACT_COLUMNS, "pickup_year"}
    assert fact.select("trip_id").distinct().count() == fact.count()
    assert built.register(spark) == []
    assert spark.sql("SELECT count(*) FROM dim_payment").collect()[0][0] <= 5
    summary = validate_tables({n: built.table(spark, n) for n in built.paths})
    require_rows(summary)
    assert {s for (s,) in values(summary, "status")} == {"OK"}


def test_fact_files_are_ordered_by_date(spark, built):
    for path in built.table(spark, "fact_trips").inputFiles():
        dates = [d for (d,) in values(spark.read.parquet(path), "pickup_date")]
        assert dates == sorted(dates)
    one_day = built.table(spark, "fact_trips", "pickup_year = 2024 AND pickup_date = DATE'2024-01-05'")
    assert one_day.count() == values(
        reports.daily_fares(built.table(spark, "fact_trips")).filter("pickup_date = DATE'2024-01-05'"),
        "trip_count",
    )[0][0]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^]]*)", plan).group(1)
    assert "EqualTo(pickup_date,2024-01-05)" in pushed, pushed


def test_missing_dimension_is_skipped(spark, built):
    paths = {k: v for k, v in built.paths.items() if k != "dim_vendor"}
    assert warehouse.Warehouse(paths).register(spark) == ["dim_vendor"]


def test_trip_counts_add_up(fact):
    n = fact.count()
    results = reports.run_reports(fact, NUDGE)
    assert list(results) == list(reports.REPORTS)
    for name in ("hour_weekday_revenue", "payment_tips", "daily_fares", "vendor_performance", "revenue_trend"):
        assert total(results[name]) == n, name
    assert total(results["segment_anomalies"], "total_trips") == n
    assert total(results["passenger_groups"]) == fact.filter("passenger_count BETWEEN 1 AND 6").count()


def test_running_total_ends_at_the_sum(fact):
    rows = reports.revenue_trend(fact, nudge=NUDGE).collect()
    assert [r["pickup_date"] for r in rows] == sorted(r["pickup_date"] for r in rows)
    assert math.isclose(rows[-1]["running_total_revenue"], sum(r["daily_revenue"] for r in rows), abs_tol=0.01)
    assert math.isclose(sum(r["pct_of_monthly_revenue"] for r in rows), 100.0, abs_tol=0.3)
    mean = sum(r["avg_fare"] for r in rows[-7:]) / 7
    assert math.isclose(rows[-1]["moving_avg_7d"], mean, abs_tol=0.006)


def test_first_day_has_no_previous(fact):
    rows = reports.daily_fares(fact, nudge=NUDGE).collect()
    assert rows[0]["prev_day_avg_fare"] is None and rows[0]["fare_change"] is None
    for before, row in zip(rows, rows[1:]):
        assert row["prev_day_avg_fare"] == before["avg_fare"]
        assert math.isclose(row["fare_change"], row["avg_fare"] - before["avg_fare"], abs_tol=1e-9)


def test_zone_ranks_are_dense_and_descending(fact):
    seen = {}
    for r in reports.zone_demand(fact, 3, NUDGE).collect():
        seen.setdefault(r["time_of_day"], []).append((r["zone_rank"], -r["trip_count"], r["zone_id"]))
    for rows in seen.values():
        assert [r for r, *_ in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 3
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_report_orders(fact):
    tips = [v for (v,) in values(reports.payment_tips(fact, NUDGE), "avg_tip_pct")]
    assert tips == sorted(tips, reverse=True)
    ranks = [v for (v,) in values(reports.segment_anomalies(fact, nudge=NUDGE), "anomaly_rank")]
    assert ranks == sorted(ranks) and ranks[0] == 1
    fares = [v for (v,) in values(reports.passenger_groups(fact, NUDGE), "fare_rank")]
    assert fares == sorted(fares)


def small_fact(make):
    import datetime as dt

    day = dt.date(2023, 1, 2)
    rows = [
        (day, 8, 2, "Morning", 5, 1, 1, 0.05, 5.0, 3, "No Charge", 60.0, 0.0, 0.0, 61.0, 1200.0),
        (day, 8, 2, "Morning", 5, 1, 7, 1.0, 5.0, 1, "Credit Card", 10.0, 1.0, 10.0, 12.0, 10.0),
        (day, 9, 2, "Morning", 6, 1, 2, 1.0, 5.0, 1, "Credit Card", 10.0, 3.0, 30.0, 12.0, 10.0),
        (day + dt.timedelta(days=9), 22, 4, "Night", 6, 2, 4, 2.0, 5.0, 4, "Dispute", 20.0, 0.0, 0.0, 20.0, 10.0),
    ]
    return make(rows, FACT_SCHEMA)


def test_reports_by_hand(make):
    fact = small_fact(make)
    anomalies = {(t, p): (n, s, d, pct, r) for t, p, n, s, d, pct, r in values(reports.segment_anomalies(fact))}
    assert anomalies[("Morning", "No Charge")] == (1, 1, 1, 100.0, 1)
    assert anomalies[("Morning", "Credit Card")] == (2, 0, 0, 0.0, 3)
    groups = {g: row for g, *row in values(reports.passenger_groups(fact))}
    assert set(groups) == {"Solo(1)", "Pair(2)", "Group(4-6)"}  # seven passengers are cut
    assert groups["Group(4-6)"][4:] == [20.0, 21.51, 2]
    hours = values(reports.hour_weekday_revenue(fact), "pickup_hour", "day_name", "trip_count", "hour_rank")
    assert hours == [(8, "Mon", 2, 1), (9, "Mon", 1, 2), (22, "Wed", 1, 1)]
    tiles = values(reports.passenger_groups(fact, revenue_tiles=2), "pax_group", "revenue_tile")
    assert dict(tiles) == {"Solo(1)": 1, "Group(4-6)": 1, "Pair(2)": 2}
    vendors = values(reports.vendor_performance(fact), "VendorID", "time_of_day", "dispute_rate", "vendor_fare_rank")
    assert vendors == [(1, "Morning", 33.33, 1), (2, "Night", 100.0, 1)]


def test_chart_datasets(make):
    fact = small_fact(make)
    grid = charts.hour_weekday_grid(fact)
    assert grid.columns == ["pickup_hour", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
    assert values(grid, "pickup_hour", "Mon", "Wed") == [(8, 36.5, None), (9, 12.0, None), (22, None, 20.0)]
    assert values(charts.top_zones(fact, 1)) == [(5, 2)]
    assert values(charts.bucket_volume(fact), "time_of_day", "trip_count") == [("Morning", 3), ("Night", 1)]
    assert values(charts.anomaly_volume(fact)) == [("Morning", 1, 1), ("Night", 1, 0)]
    line = charts.fare_trend_line(fact, 5).collect()
    assert [r["point"] for r in line] == [0, 1, 2, 3, 4]
    assert (line[0]["fitted_fare"], line[4]["fitted_fare"]) == (26.67, 20.0)
    cells = values(charts.vendor_grid(fact), "VendorID", "time_of_day", "position", "avg_fare")
    assert [c[:3] for c in cells] == [(v, t, i) for v in (1, 2) for i, t in enumerate(TIME_ORDER, 1)]
    assert [c[3] for c in cells] == [26.67, None, None, None, None, None, None, 20.0]


def test_alerts_cover_every_day(fact):
    days = reports.daily_revenue(fact).count()
    assert reports.fare_alerts(fact).count() == days
