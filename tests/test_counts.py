import pytest

from checks.trip_source import RULES, raw_trips
from pyspark.sql import Observation
from pyspark.sql import functions as F
from tests.conftest import values
from tripmart import jobs
from tripmart.operators.cleaning import distinct_positive, drop_exact_duplicates, keep_positive
from tripmart.operators.validation import counted_checks, reconcile, validate_tables
from tripmart.plans.trips import clean_trips, clean_trips_counted
from tripmart.plans.warehouse import FACT, build_warehouse_counted
from tripmart.sources.sinks import write_counted, write_table

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_counted_rows_are_those_of_the_two_steps(make):
    rows = [(1.0, "a", 1), (1.0, "a", 1), (1.0, None, 1), (0.0, "a", 2), (None, "a", 3), (-1.0, "b", 4), (-1.0, "b", 4)]
    df = make(rows, "d double, _kept0 string, `a.b` int")
    found, counts = distinct_positive(df, "d")
    plain = df.transform(drop_exact_duplicates).transform(keep_positive, "d")
    assert found.columns == df.columns
    assert sorted(map(str, values(found))) == sorted(map(str, values(plain)))
    assert counts.first().asDict() == {"raw_rows": 7, "unmeasured_rows": 4, "distinct_rows": 2}


def test_nothing_counts_nothing(make):
    found, counts = distinct_positive(make([], "d double, x string"), "d")
    assert values(found) == []
    assert counts.first().asDict() == {"raw_rows": 0, "unmeasured_rows": 0, "distinct_rows": 0}


def test_counted_cleaning_scans_once_and_gives_the_same_trips(spark):
    raw = raw_trips(spark, SF)
    seen = Observation()
    counted, _ = clean_trips_counted(raw, RULES, seen)
    plan = plan_of(counted)
    assert plan.count("FileScan") == 1
    assert "CartesianProduct" not in plan
    assert seen.get["raw_rows"] == raw.count()
    plain = clean_trips(raw, RULES)
    assert counted.columns == plain.columns
    assert counted.exceptAll(plain).count() == 0 and plain.exceptAll(counted).count() == 0


@pytest.mark.parametrize("wanted", ["true", "user_id < 5"])
def test_build_counts_what_the_tables_hold(spark, tmp_path, wanted):
    raw = raw_trips(spark, SF).filter(F.expr(wanted.replace("user_id", "PULocationID")))
    built, counts = build_warehouse_counted(spark, raw, str(tmp_path), RULES)
    tables = {n: built.table(spark, n) for n in built.paths}
    assert sorted(values(counted_checks(spark, counts.tables, built.paths))) == sorted(
        values(validate_tables(tables, paths=built.paths))
    )
    before, stored, removed, _ = values(reconcile(raw, tables[FACT]))[0]
    assert (counts.load["raw_rows"], counts.tables[FACT]["row_count"]) == (before, stored)
    assert sum(counts.removed().values()) == removed and min(counts.removed().values()) >= 0


@pytest.mark.parametrize("nothing", ["false", "trip_distance > 1e9", "trip_distance <= 0.3"])
def test_counts_of_few_or_no_trips(spark, tmp_path, nothing):
    raw = raw_trips(spark, SF)
    path = write_table(raw, str(tmp_path / "raw"))
    raw = spark.read.parquet(path).filter(nothing).withColumn("trip_distance", F.col("trip_distance") - 0.3)
    _, counts = build_warehouse_counted(spark, raw, str(tmp_path / "wh"), RULES)
    assert counts.load["raw_rows"] == raw.count()
    assert counts.load["unmeasured_rows"] == raw.count()
    assert {n: c["row_count"] for n, c in counts.tables.items()} == dict.fromkeys(counts.tables, 0)


def test_written_tables_are_counted_with_their_nulls(make, spark, tmp_path):
    df = make([(1, "a"), (2, None), (2, None), (None, "b")], "k int, v string")
    found = write_counted(df, str(tmp_path / "t"), ["v", "k", "absent"], ["k"])
    assert found == {"row_count": 4, "v": 2, "k": 1}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_build_job_tells_all_counts(spark, tmp_path):
    raw = raw_trips(spark, SF)
    told = jobs.build(spark, raw, str(tmp_path / "wh"), RULES)
    assert values(told["load"], "row_count") == [(raw.count(),)]
    assert len(values(told["key_nulls"])) == 10
    assert values(told["reconciliation"], "removed_rows")[0][0] == sum(n for _, n in values(told["removed"]))
