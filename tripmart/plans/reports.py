"""The eight trip reports. Each takes the fact table and returns an ordered frame.

All follow one shape: aggregate the fact once, with partial aggregation on the map side, and
apply window functions to the few grouped rows. ``nudge`` is passed to every rounding
of an average or ratio (see ``functions.scalars.rounded``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.aggregates import count_where, percent_where, row_count
from tripmart.functions.scalars import label_for, rounded
from tripmart.operators.windows import (
    deviation_alert,
    lag_delta,
    moving_average,
    ntile_within,
    rank_within,
    running_total,
    share_of_total,
    top_k,
)
from tripmart.plans.trip_rules import (
    DISPUTE_TYPES,
    PASSENGER_DEFAULT,
    PASSENGER_GROUPS,
    PASSENGER_RANGE,
    WEEKDAY_NAMES,
)


def summarise(
    df: DataFrame,
    keys: Sequence[Column | str],
    means: Mapping[str, Column | str],
    count_as: str = "trip_count",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Row count, unrounded means and further aggregates per group."""
    return df.groupBy(*keys).agg(
        row_count().alias(count_as),
        *[F.avg(c).alias(n) for n, c in means.items()],
        *[e.alias(n) for n, e in (extra or {}).items()],
    )


def round_columns(df: DataFrame, columns: Sequence[str], nudge: float, digits: int = 2) -> DataFrame:
    return df.withColumns({c: rounded(c, digits, nudge) for c in columns})


def hour_weekday_revenue(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Averages per hour and weekday; hours ranked within their day by unrounded revenue."""
    means = {
        "avg_fare": "fare_amount",
        "avg_total": "total_amount",
        "avg_rev_per_mile": "revenue_per_mile",
    }
    grouped = summarise(fact, ["pickup_hour", "pickup_dayofweek"], means)
    ranked = rank_within(grouped, "hour_rank", [F.desc("avg_total")], ["pickup_dayofweek"])
    return (
        round_columns(ranked, list(means), nudge)
        .withColumn("day_name", label_for("pickup_dayofweek", WEEKDAY_NAMES))
        .select(
            "pickup_hour",
            "pickup_dayofweek",
            "day_name",
            "trip_count",
            *means,
            "hour_rank",
        )
        .orderBy("pickup_dayofweek", "pickup_hour")
    )


def zone_demand(fact: DataFrame, k: int = 10, nudge: float = 0.0) -> DataFrame:
    """The busiest ``k`` pick-up zones of every time bucket; equal counts order by zone."""
    grouped = summarise(
        fact, [F.col("PULocationID").alias("zone_id"), "time_of_day"], {"avg_revenue": "total_amount"}
    )
    best = top_k(grouped, k, [F.desc("trip_count"), F.asc("zone_id")], ["time_of_day"], "zone_rank")
    return round_columns(best, ["avg_revenue"], nudge).orderBy("time_of_day", "zone_rank")


def payment_tips(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Tips and fares per payment label, with each label's share of all trips."""
    means = {
        "avg_tip_pct": "tip_pct",
        "avg_tip_amount": "tip_amount",
        "avg_fare": "fare_amount",
        "avg_total": "total_amount",
    }
    grouped = round_columns(summarise(fact, ["payment_label"], means), list(means), nudge)
    shared = share_of_total(grouped, "trip_count", "pct_of_all_trips", nudge=nudge)
    return shared.orderBy(F.desc("avg_tip_pct"), "payment_label")


def daily_fares(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Daily averages, the previous day's average fare and the change to it."""
    means = {
        "avg_distance": "trip_distance",
        "avg_duration": "trip_duration_mins",
        "avg_fare": "fare_amount",
        "avg_rev_per_mile": "revenue_per_mile",
    }
    daily = round_columns(summarise(fact, ["pickup_date"], means), list(means), nudge)
    with_change = lag_delta(daily, "avg_fare", ["pickup_date"], "prev_day_avg_fare", "fare_change")
    return with_change.select(
        "pickup_date", *means, "trip_count", "prev_day_avg_fare", "fare_change"
    ).orderBy("pickup_date")


def segment_anomalies(
    fact: DataFrame,
    short_distance: float = 0.1,
    high_fare: float = 50.0,
    nudge: float = 0.0,
) -> DataFrame:
    """Suspicious (short but expensive) and disputed trips per time bucket and payment label."""
    disputed = F.col("payment_type").isin(*DISPUTE_TYPES)
    suspicious = (F.col("trip_distance") < short_distance) & (F.col("fare_amount") > high_fare)
    grouped = summarise(
        fact,
        ["time_of_day", "payment_label"],
        {},
        count_as="total_trips",
        extra={
            "suspicious": count_where(suspicious),
            "disputed": count_where(disputed),
            "dispute_pct": rounded(percent_where(disputed), 2, nudge),
        },
    )
    return rank_within(grouped, "anomaly_rank", [F.desc("disputed")]).orderBy(
        "anomaly_rank", "time_of_day", "payment_label"
    )


def passenger_groups(
    fact: DataFrame, nudge: float = 0.0, revenue_tiles: int | None = None
) -> DataFrame:
    """Fares, tips and revenue share per passenger group; groups ranked by unrounded fare.

    ``revenue_tiles`` adds a segmentation of the groups into classes of equal size by revenue.
    """
    means = {"avg_fare": "fare_amount", "avg_tip_pct": "tip_pct", "avg_distance": "trip_distance"}
    counted = fact.filter(F.col("passenger_count").between(*PASSENGER_RANGE))
    group = label_for("passenger_count", PASSENGER_GROUPS, PASSENGER_DEFAULT).alias("pax_group")
    grouped = summarise(counted, [group], means, extra={"total_revenue": F.sum("total_amount")})
    ranked = rank_within(grouped, "fare_rank", [F.desc("avg_fare")], kind="dense_rank")
    shared = share_of_total(ranked, "total_revenue", "revenue_share_pct", nudge=nudge)
    columns = ["pax_group", "trip_count", *means, "total_revenue", "revenue_share_pct", "fare_rank"]
    if revenue_tiles:
        order = [F.desc("total_revenue"), F.asc("pax_group")]
        shared = ntile_within(shared, "revenue_tile", revenue_tiles, order)
        columns.append("revenue_tile")
    return (
        round_columns(shared, [*means, "total_revenue"], nudge)
        .select(*columns)
        .orderBy("fare_rank", "pax_group")
    )


def vendor_performance(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Fares, tips, duration and dispute rate per vendor and time bucket, ranked per bucket."""
    means = {"avg_fare": "fare_amount", "avg_tip_pct": "tip_pct", "avg_duration": "trip_duration_mins"}
    disputed = percent_where(F.col("payment_type").isin(*DISPUTE_TYPES))
    grouped = summarise(
        fact, ["VendorID", "time_of_day"], means, extra={"dispute_rate": rounded(disputed, 2, nudge)}
    )
    ranked = rank_within(
        grouped, "vendor_fare_rank", [F.desc("avg_fare")], ["time_of_day"], "dense_rank"
    )
    return round_columns(ranked, list(means), nudge).orderBy(
        "time_of_day", "vendor_fare_rank", "VendorID"
    )


def daily_revenue(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """One row per day: trips, average fare, revenue."""
    daily = summarise(
        fact, ["pickup_date"], {"avg_fare": "fare_amount"}, extra={"daily_revenue": F.sum("total_amount")}
    )
    return round_columns(daily, ["avg_fare", "daily_revenue"], nudge)


def revenue_trend(fact: DataFrame, window_rows: int = 7, nudge: float = 0.0) -> DataFrame:
    """Daily revenue with running total, moving mean fare and share of the whole period."""
    order = ["pickup_date"]
    return (
        daily_revenue(fact, nudge)
        .transform(running_total, "daily_revenue", order, "running_total_revenue", nudge=nudge)
        .transform(moving_average, "avg_fare", order, "moving_avg_7d", window_rows, nudge=nudge)
        .transform(share_of_total, "daily_revenue", "pct_of_monthly_revenue", nudge=nudge)
        .orderBy("pickup_date")
    )


def fare_alerts(
    fact: DataFrame, window_rows: int = 7, k: float = 2.0, nudge: float = 0.0
) -> DataFrame:
    """Days whose average fare leaves the band around its moving mean."""
    daily = daily_revenue(fact, nudge).select("pickup_date", "avg_fare")
    return deviation_alert(daily, "avg_fare", ["pickup_date"], window_rows, k, nudge=nudge).orderBy(
        "pickup_date"
    )


REPORTS = {
    "hour_weekday_revenue": hour_weekday_revenue,
    "zone_demand": zone_demand,
    "payment_tips": payment_tips,
    "daily_fares": daily_fares,
    "segment_anomalies": segment_anomalies,
    "passenger_groups": passenger_groups,
    "vendor_performance": vendor_performance,
    "revenue_trend": revenue_trend,
}


def run_reports(fact: DataFrame, nudge: float = 0.0) -> dict[str, DataFrame]:
    """All eight reports by name, as lazy frames."""
    return {name: report(fact, nudge=nudge) for name, report in REPORTS.items()}
