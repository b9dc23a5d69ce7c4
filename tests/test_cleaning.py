import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.operators import cleaning
from tripmart.plans.trip_rules import RAW_COLUMNS, CleaningRules
from tripmart.plans.trips import clean_trips, repair_by_share

RAW_SCHEMA = (
    "VendorID long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID long, DOLocationID long, payment_type long, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, airport_fee double"
)
NOON = dt.datetime(2023, 1, 2, 12, 0)


def trip(minutes=10.0, **changes):
    row = dict(
        VendorID=1,
        tpep_pickup_datetime=NOON,
        tpep_dropoff_datetime=NOON + dt.timedelta(minutes=minutes),
        passenger_count=1.0,
        trip_distance=2.0,
        RatecodeID=1.0,
        store_and_fwd_flag="N",
        PULocationID=10,
        DOLocationID=20,
        payment_type=1,
        fare_amount=10.0,
        extra=0.0,
        mta_tax=0.5,
        tip_amount=2.0,
        tolls_amount=0.0,
        improvement_surcharge=0.3,
        total_amount=13.0,
        congestion_surcharge=2.5,
        airport_fee=0.0,
    )
    row.update(changes)
    return tuple(row[c] for c in RAW_COLUMNS)


def test_duplicates_with_nulls_collapse(make):
    df = make([(1, None), (1, None), (1, 2.0)], "a int, b double")
    assert cleaning.drop_exact_duplicates(df).count() == 2


def test_keep_positive_drops_zero_negative_and_null(make):
    df = make([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    assert values(cleaning.keep_positive(df, "x")) == [(1.0,)]


def test_range_is_open_below_and_closed_above(make):
    df = make([(0.0,), (0.1,), (360.0,), (360.1,), (None,)], "x double")
    assert values(cleaning.keep_in_range(df, "x", 0, 360)) == [(0.1,), (360.0,)]


def test_repair_keeps_zero_and_null(make):
    df = make([(-1.0,), (0.0,), (2.0,), (None,)], "x double")
    out = cleaning.repair_negative(df, "x", F.lit(9.0))
    assert [v for (v,) in values(out)] == [9.0, 0.0, 2.0, None]


def test_winsorise_clamps_and_keeps_null(make):
    df = make([(-9.0,), (1.0,), (9.0,), (None,)], "x double")
    assert [v for (v,) in values(cleaning.winsorise(df, "x", F.lit(-2.0), F.lit(3.0)))] == [-2.0, 1.0, 3.0, None]
    open_ended = cleaning.winsorise(df, "x", F.lit(None).cast("double"), F.lit(None).cast("double"))
    assert [v for (v,) in values(open_ended)] == [-9.0, 1.0, 9.0, None]


def test_impute_flag_fill(make):
    df = make(
        [(None, "Y", None), (0.0, "N", 5.0), (7.0, None, float("nan"))],
        "n double, f string, r double",
    )
    df = cleaning.impute_missing_or_zero(df, "n", 1)
    df = cleaning.flag_to_boolean(df, "f")
    df = cleaning.fill_nulls(df, {"r": 1.0})
    assert dict(df.dtypes) == {"n": "int", "f": "boolean", "r": "double"}
    out = values(df)
    assert out[:2] == [(1, True, 1.0), (1, False, 5.0)]
    assert out[2][:2] == (7, False) and out[2][2] != out[2][2]  # NaN is a value


def test_bad_timestamp_text_becomes_null(make):
    df = make([("2023-01-01 00:00:00",), ("soon",)], "t string")
    out = cleaning.standardise_timestamps(df, ["t"])
    assert values(out) == [(dt.datetime(2023, 1, 1),), (None,)]


def test_clean_trips_end_to_end(make):
    rows = [
        trip(),
        trip(),  # exact copy
        trip(trip_distance=0.0),
        trip(trip_distance=None),
        trip(fare_amount=-5.0, PULocationID=11),
        trip(fare_amount=20.0, PULocationID=12, total_amount=1000.0),
        trip(fare_amount=30.0, PULocationID=13, passenger_count=None, store_and_fwd_flag=None,
             RatecodeID=None, congestion_surcharge=None, airport_fee=None, payment_type=None),
        trip(fare_amount=0.0, PULocationID=14, passenger_count=0.0, payment_type=9),
        trip(fare_amount=None, PULocationID=15, passenger_count=8.0),
        trip(minutes=0, PULocationID=16, fare_amount=40.0),
        trip(minutes=361, PULocationID=17, fare_amount=50.0),
        trip(minutes=360, PULocationID=18, fare_amount=60.0),
        trip(tpep_dropoff_datetime=None, PULocationID=19, fare_amount=70.0),
    ]
    out = {r["PULocationID"]: r for r in clean_trips(make(rows, RAW_SCHEMA)).collect()}
    assert sorted(out) == [10, 11, 12, 13, 14, 15, 18]
    # Median of the positive fares of distinct trips, those with odd durations included.
    assert out[11]["fare_amount"] == 40.0
    assert out[11]["revenue_per_mile"] == 20.0 and out[11]["tip_pct"] == 5.0
    assert out[12]["total_amount"] == 13.0  # all quartiles are 13, so the fences are too
    blank = out[13]
    assert (blank["passenger_count"], blank["store_and_fwd_flag"], blank["RatecodeID"]) == (1, False, 1.0)
    assert (blank["congestion_surcharge"], blank["airport_fee"]) == (0.0, 0.0)
    assert blank["payment_label"] == "Unknown"
    assert out[14]["passenger_count"] == 1 and out[14]["tip_pct"] == 0.0
    assert out[14]["payment_label"] == "Unknown"
    assert out[15]["fare_amount"] is None and out[15]["revenue_per_mile"] is None
    assert out[15]["tip_pct"] == 0.0 and out[15]["passenger_count"] == 8
    assert out[18]["trip_duration_mins"] == 360.0
    first = out[10]
    assert (first["pickup_hour"], first["pickup_dayofweek"], first["time_of_day"]) == (12, 2, "Afternoon")
    assert first["is_weekend"] is False


def test_approximate_statistics_are_an_option(make):
    rows = [trip(fare_amount=float(i), PULocationID=i) for i in range(1, 12)] + [trip(fare_amount=-1.0)]
    out = clean_trips(make(rows, RAW_SCHEMA), CleaningRules(quantile_method="approx"))
    repaired = [r["fare_amount"] for r in out.collect() if r["PULocationID"] == 10 and r["fare_amount"] != 10.0]
    assert repaired == [6.0]


def test_copies_of_one_trip_are_combined_before_the_shuffle(make):
    rows = [trip()] * 3000 + [trip(PULocationID=i, fare_amount=float(i)) for i in range(100, 200)]
    out = clean_trips(make(rows, RAW_SCHEMA).repartition(4))
    assert out.count() == 101
    plan = cleaning.drop_exact_duplicates(make(rows, RAW_SCHEMA))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning")[1]
    assert "HashAggregate(keys=[" in below


def test_clean_trips_of_nothing(make):
    assert clean_trips(make([], RAW_SCHEMA)).count() == 0


def test_share_repair_uses_the_median_of_its_share(make):
    rows = [(float(d), float(d * 10)) for d in range(1, 21)] + [(1.5, -1.0), (19.5, -1.0), (None, 5.0)]
    df = make(rows, "trip_distance double, fare_amount double")
    out = repair_by_share(df, parts=2)
    fixed = {r["trip_distance"]: r for r in out.collect()}
    assert len(fixed) == 23
    assert (fixed[1.5]["share"], fixed[1.5]["fare_amount"]) == (1, 55.0)
    assert (fixed[19.5]["share"], fixed[19.5]["fare_amount"]) == (2, 155.0)
    assert (fixed[None]["share"], fixed[None]["fare_amount"]) == (0, 5.0)
