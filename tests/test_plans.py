"""What the physical plans look like: scans, shuffles, pushdown."""

import re

import pytest

from checks.queries import fact, stored
from checks.trip_source import RULES, raw_trips
from tripmart.operators import profile
from tripmart.plans import reports, trips
from tripmart.plans.trip_rules import DISTRIBUTION_COLUMNS

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan):
    return len(re.findall(r"[-] Exchange ", plan))


def test_cleaning_scans_and_removes_duplicates_once(spark):
    plan = final_plan(trips.clean_trips(raw_trips(spark, SF), RULES))
    assert plan.count("FileScan") == 1
    assert plan.count("ReusedExchange") == 2  # the distinct rows and the value counts
    assert "BroadcastNestedLoopJoin" in plan  # against one row
    assert "CartesianProduct" not in plan


def test_share_repair_scans_once(spark):
    rows = raw_trips(spark, SF).dropDuplicates()
    assert final_plan(trips.repair_by_share(rows)).count("FileScan") == 1


@pytest.mark.parametrize("shape", [profile.histograms, profile.densities])
def test_distributions_scan_once(spark, shape):
    assert final_plan(shape(raw_trips(spark, SF), DISTRIBUTION_COLUMNS)).count("FileScan") == 1


def test_no_plan_leaves_the_jvm(spark):
    for df in (trips.clean_trips(raw_trips(spark, SF), RULES), *reports.run_reports(fact(spark, SF)).values()):
        plan = final_plan(df)
        assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_reports_read_few_columns_once_and_shuffle_groups_only(spark, name):
    plan = final_plan(reports.REPORTS[name](fact(spark, SF)))
    assert plan.count("FileScan") == 1
    read = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert len(read.split(",")) <= 7
    assert "partial_count" in plan
    # One shuffle for the groups, one for the window and one for the final order.
    assert shuffles(plan) <= 3


def test_passenger_filter_reaches_the_scan(spark):
    plan = final_plan(reports.passenger_groups(fact(spark, SF)))
    assert "GreaterThanOrEqual(passenger_count,1)" in plan
    assert "LessThanOrEqual(passenger_count,6)" in plan


def test_top_zones_are_cut_before_the_shuffle(spark):
    assert final_plan(reports.zone_demand(fact(spark, SF))).count("WindowGroupLimit") == 2


def test_period_reads_its_partitions_only(spark):
    period = stored(spark, SF).table(spark, "fact_trips", "pickup_year = 2024 AND pickup_month = 1")
    plan = final_plan(period.groupBy("pickup_date").count())
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_year[^\]]*pickup_month", plan)
