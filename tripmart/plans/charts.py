"""Datasets behind the report charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions.aggregates import row_count
from tripmart.functions.scalars import rounded
from tripmart.plans.reports import daily_fares, segment_anomalies, vendor_performance
from tripmart.plans.trip_rules import TIME_ORDER, WEEKDAY_NAMES, WEEKDAY_ORDER


def _display_order(column: str, values: Sequence[str]):
    """Position of a label in a fixed display order (null for other labels)."""
    position = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(position > 0, position.cast("int"))


def hour_weekday_grid(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Mean total per hour (rows) and weekday (columns Mon .. Sun)."""
    by_name = {name: number for number, name in WEEKDAY_NAMES.items()}
    numbers = [by_name[name] for name in WEEKDAY_ORDER]
    pivoted = (
        fact.groupBy("pickup_hour").pivot("pickup_dayofweek", numbers).agg(F.avg("total_amount"))
    )
    return pivoted.select(
        "pickup_hour",
        *[rounded(F.col(str(by_name[n])), 2, nudge).alias(n) for n in WEEKDAY_ORDER],
    ).orderBy("pickup_hour")


def top_zones(fact: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` zones with most pick-ups over all trips."""
    return (
        fact.groupBy(F.col("PULocationID").alias("zone_id"))
        .agg(row_count().alias("trip_count"))
        .orderBy(F.desc("trip_count"), F.asc("zone_id"))
        .limit(k)
    )


def bucket_volume(fact: DataFrame) -> DataFrame:
    """Trips per time bucket in display order."""
    return (
        fact.groupBy("time_of_day")
        .agg(row_count().alias("trip_count"))
        .withColumn("position", _display_order("time_of_day", TIME_ORDER))
        .orderBy("position")
    )


def anomaly_volume(
    fact: DataFrame, short_distance: float = 0.1, high_fare: float = 50.0
) -> DataFrame:
    """Disputed and suspicious trips per time bucket."""
    return (
        segment_anomalies(fact, short_distance, high_fare)
        .groupBy("time_of_day")
        .agg(F.sum("disputed").alias("disputed"), F.sum("suspicious").alias("suspicious"))
        .orderBy("time_of_day")
    )


def fare_trend_line(fact: DataFrame, points: int = 50, nudge: float = 0.0) -> DataFrame:
    """Least-squares line of daily average fare on daily average distance, at equal steps
    between the smallest and the largest distance."""
    daily = daily_fares(fact, nudge)
    x, y = F.col("avg_distance"), F.col("avg_fare")
    line = daily.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    )
    steps = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    at = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / F.lit(float(points - 1))
    return (
        line.select("*", steps)
        .select(
            "point",
            at.alias("x"),
            "slope",
            (F.col("slope") * at + F.col("intercept")).alias("y"),
        )
        .select(
            "point",
            rounded("x", 4, nudge).alias("avg_distance"),
            rounded("y", 4, nudge).alias("fitted_fare"),
            rounded("slope", 4, nudge).alias("slope"),
        )
        .orderBy("point")
    )


def vendor_grid(fact: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Vendor report on a dense vendor x bucket grid: cells without trips hold nulls."""
    cell = F.struct("avg_fare", "avg_tip_pct")
    by_bucket = F.map_from_entries(F.collect_list(F.struct("time_of_day", cell)))
    # A map of at most one entry per bucket and vendor, opened on the fixed list of buckets.
    rows = vendor_performance(fact, nudge).groupBy("VendorID").agg(by_bucket.alias("cells"))
    buckets = F.array(*[F.lit(t) for t in TIME_ORDER])
    return (
        rows.select("VendorID", "cells", F.posexplode(buckets).alias("at", "time_of_day"))
        .withColumn("cell", F.try_element_at("cells", F.col("time_of_day")))
        .select(
            "VendorID",
            "time_of_day",
            (F.col("at") + 1).alias("position"),
            "cell.avg_fare",
            "cell.avg_tip_pct",
        )
        .orderBy("VendorID", "position")
    )


def display_sorted(report: DataFrame, measure: str, tiebreak: str) -> DataFrame:
    """A report in display order: largest measure first."""
    return report.orderBy(F.desc(measure), F.asc(tiebreak))
