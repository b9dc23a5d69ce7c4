import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.functions import (
    bucket_for,
    count_where,
    flag_equals,
    label_for,
    minutes_between,
    null_counts,
    percent_where,
    rounded,
    safe_ratio,
    weekend_flag,
    with_time_parts,
)
from tripmart.plans.trip_rules import (
    PASSENGER_DEFAULT,
    PASSENGER_GROUPS,
    PAYMENT_DEFAULT,
    PAYMENT_LABELS,
    TIME_BUCKETS,
    TIME_DEFAULT,
    WEEKDAY_NAMES,
)


def test_labels_default_and_null(make):
    df = make([(1,), (4,), (0,), (None,)], "p long")
    out = df.select(
        label_for("p", PAYMENT_LABELS, PAYMENT_DEFAULT).alias("pay"),
        label_for("p", WEEKDAY_NAMES).alias("day"),
    )
    assert values(out) == [
        ("Credit Card", "Sun"),
        ("Dispute", "Wed"),
        ("Unknown", None),
        ("Unknown", None),
    ]


def test_passenger_groups(make):
    df = make([(1,), (2,), (3,), (4,), (6,)], "n int")
    out = df.select(label_for("n", PASSENGER_GROUPS, PASSENGER_DEFAULT))
    assert [v for (v,) in values(out)] == ["Solo(1)", "Pair(2)", "Small(3)", "Group(4-6)", "Group(4-6)"]


def test_time_buckets_at_their_bounds(make):
    df = make([(h,) for h in (0, 5, 6, 11, 12, 16, 17, 20, 21, 23, None)], "h int")
    out = [v for (v,) in values(df.select(bucket_for("h", TIME_BUCKETS, TIME_DEFAULT)))]
    assert out == ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 2 + ["Night"] * 3


def test_empty_label_and_bucket_lists_give_the_default(make):
    df = make([(1,)], "n int")
    assert values(df.select(label_for("n", {}, "x"), bucket_for("n", [], "y"))) == [("x", "y")]


def test_safe_ratio_guards(make):
    df = make([(1.0, 3.0), (1.0, 0.0), (1.0, -2.0), (1.0, None), (None, 3.0)], "a double, b double")
    out = [v for (v,) in values(df.select(safe_ratio("a", "b", 100.0)))]
    assert out == [33.33, 0.0, 0.0, 0.0, None]


def test_rounding_is_half_up_and_nudge_settles_ties(make):
    df = make([(0.125,), (-0.125,), (1.005,)], "x double")
    assert [v for (v,) in values(df.select(rounded("x")))][:2] == [0.13, -0.13]
    noisy = make([(24.1249999999999,)], "x double")
    assert values(noisy.select(rounded("x"), rounded("x", 2, 1e-9))) == [(24.12, 24.13)]


def test_time_parts_and_duration(make):
    sunday = dt.datetime(2023, 1, 1, 23, 59, 30)
    df = make([(sunday, sunday + dt.timedelta(seconds=90)), (None, None)], "a timestamp, b timestamp")
    out = with_time_parts(df, "a").select(
        "pickup_hour",
        "pickup_dayofweek",
        "pickup_month",
        "pickup_year",
        "pickup_date",
        minutes_between("a", "b").alias("m"),
        weekend_flag("pickup_dayofweek").alias("w"),
    )
    assert values(out) == [
        (23, 1, 1, 2023, dt.date(2023, 1, 1), 1.5, True),
        (None, None, None, None, None, None, False),
    ]


def test_weekend_is_saturday_and_sunday(make):
    df = make([(d,) for d in range(1, 8)], "d int")
    assert [v for (v,) in values(df.select(weekend_flag("d")))] == [True] + [False] * 5 + [True]


def test_flag_only_accepts_the_true_value(make):
    df = make([("Y",), ("N",), ("y",), ("",), (None,)], "f string")
    assert [v for (v,) in values(df.select(flag_equals("f")))] == [True, False, False, False, False]


def test_conditional_aggregates(make):
    df = make([(1,), (3,), (4,), (None,)], "p long")
    disputed = F.col("p").isin(3, 4)
    assert values(df.agg(count_where(disputed), percent_where(disputed))) == [(2, 50.0)]
    assert values(null_counts(df.withColumn("q", F.lit(1)))) == [(1, 0)]
