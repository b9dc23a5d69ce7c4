"""Raw trips -> clean trips: one lazy plan, no job until the result is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.functions.scalars import (
    bucket_for,
    label_for,
    minutes_between,
    safe_ratio,
    weekend_flag,
    with_time_parts,
)
from tripmart.operators import cleaning
from tripmart.operators.quantiles import grouped_quantile, quantile_edges
from tripmart.plans.trip_rules import (
    PAYMENT_DEFAULT,
    PAYMENT_LABELS,
    TIME_BUCKETS,
    TIME_DEFAULT,
    CleaningRules,
)


def derive_times_and_labels(df: DataFrame) -> DataFrame:
    """Add duration, time parts, weekend flag, time bucket and payment label."""
    timed = with_time_parts(df, "tpep_pickup_datetime", "pickup")
    return timed.withColumns(
        {
            "trip_duration_mins": minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime"),
            "is_weekend": weekend_flag("pickup_dayofweek"),
            "time_of_day": bucket_for("pickup_hour", TIME_BUCKETS, TIME_DEFAULT),
            "payment_label": label_for("payment_type", PAYMENT_LABELS, PAYMENT_DEFAULT),
        }
    )


def derive_ratios(df: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Add tip percentage and revenue per mile, zero where the denominator is not positive."""
    return df.withColumns(
        {
            "tip_pct": safe_ratio("tip_amount", "fare_amount", scale=100.0, nudge=nudge),
            "revenue_per_mile": safe_ratio("fare_amount", "trip_distance", nudge=nudge),
        }
    )


def derive_measures(df: DataFrame, nudge: float = 0.0) -> DataFrame:
    """All derived columns of trips that need no repair."""
    return derive_ratios(derive_times_and_labels(df), nudge)


def trip_limits(distinct: DataFrame, rules: CleaningRules) -> DataFrame:
    """The one row every trip is checked against: repair value, caps, plausible duration.

    The duration bounds are aggregates of constants on purpose: as columns of this row they
    reach the trips through the join below, above the duplicate removal. As literals they
    would be pushed beneath it on one side only, and the duplicate removal, the one wide
    shuffle of the plan, would run twice instead of being shared with the statistics.
    """
    stats = cleaning.repair_limits(
        distinct,
        "fare_amount",
        "total_amount",
        rules.iqr_multiplier,
        rules.quantile_method,
        rules.quantile_accuracy,
    )
    return stats.groupBy().agg(
        F.max("repair_value").alias("repair_value"),
        F.max("cap_low").alias("cap_low"),
        F.max("cap_high").alias("cap_high"),
        F.max(F.lit(rules.min_minutes)).alias("min_minutes"),
        F.max(F.lit(rules.max_minutes)).alias("max_minutes"),
    )


def clean_trips(raw: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Remove, repair, cap, impute, derive; then drop implausible durations.

    Order matters: the median and the quartiles are taken after duplicates and empty trips
    are gone but before the duration check, and ratios use the repaired fare.
    """
    distinct = raw.transform(cleaning.drop_exact_duplicates).transform(
        cleaning.keep_positive, "trip_distance"
    )
    return _plausible_trips(distinct, trip_limits(distinct, rules), rules)


def clean_trips_counted(
    raw: DataFrame, rules: CleaningRules, loaded: Observation
) -> tuple[DataFrame, DataFrame]:
    """``clean_trips``, with the rows that came in counted by the same plan; and the counts by themselves.

    ``loaded`` is told ``raw_rows``, ``unmeasured_rows`` and ``distinct_rows`` when the trips have been
    written. What it observes is the maximum of one row made behind the shuffle, which stays the same
    when a lost task is repeated; a count of rows observed before a shuffle would grow.
    """
    distinct, counts = cleaning.distinct_positive(raw, "trip_distance")
    observed = counts.observe(loaded, *[F.max(c).alias(c) for c in counts.columns])
    limits = trip_limits(distinct, rules).join(F.broadcast(observed))  # exactly one row each
    return _plausible_trips(distinct, limits, rules), counts


def _plausible_trips(distinct: DataFrame, limits: DataFrame, rules: CleaningRules) -> DataFrame:
    prepared = (
        distinct.transform(
            cleaning.standardise_timestamps,
            ["tpep_pickup_datetime", "tpep_dropoff_datetime"],
            rules.timestamp_type,
        )
        .transform(cleaning.impute_missing_or_zero, "passenger_count", rules.passenger_default)
        .transform(cleaning.flag_to_boolean, "store_and_fwd_flag")
        .transform(cleaning.fill_nulls, rules.null_defaults)
        .transform(derive_times_and_labels)
    )
    minutes = F.col("trip_duration_mins")
    inside = (minutes > F.col("min_minutes")) & (minutes <= F.col("max_minutes"))
    # A bare comparison would let the optimizer derive "minutes is not null" and push that
    # beneath the duplicate removal on this side only, with the effect described above.
    plausible = prepared.join(
        F.broadcast(limits),  # exactly one row
        F.coalesce(inside, F.lit(False)),
    )
    return (
        plausible.transform(cleaning.repair_negative, "fare_amount", "repair_value")
        .transform(cleaning.winsorise, "total_amount", "cap_low", "cap_high")
        .drop(*limits.columns)
        .transform(derive_ratios, rules.nudge)
    )


def repair_by_share(
    trips: DataFrame,
    column: str = "fare_amount",
    by: str = "trip_distance",
    parts: int = 10,
    method: str = "exact",
) -> DataFrame:
    """Replace negative values by the median of the positive values in the same share of ``by``.

    The shares are ranges between quantile edges, not a ranking of all trips: a trip's share
    is the number of edges below its value, counted in an array that one row carries. Trips
    without a value in ``by`` form share 0.
    """
    edges, names = quantile_edges(trips, by, parts, method)
    below = F.filter(F.col("share_edges"), lambda edge: edge < F.col(by))
    placed = (
        trips.join(F.broadcast(edges.select(F.array(*names).alias("share_edges"))))  # exactly one row
        .withColumn("share", F.when(F.col(by).isNull(), F.lit(0)).otherwise(F.size(below) + 1))
        .drop("share_edges")
    )
    positive = F.when(F.col(column) > 0, F.col(column))
    medians = grouped_quantile(placed, "share", positive, 0.5, "share_median", groups=parts + 1)
    return (
        placed.join(F.broadcast(medians), F.col("share") == F.col("series"), "left")
        .transform(cleaning.repair_negative, column, "share_median")
        .drop("series", "share_median")
    )
