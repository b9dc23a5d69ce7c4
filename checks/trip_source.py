"""Trips derived from the ``events`` table: the input of every registered trip query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.trip_rules import RAW_COLUMNS, CleaningRules

NUDGE = 1e-9
RULES = CleaningRules(timestamp_type="timestamp_ntz", nudge=NUDGE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with defects: repeated rows, negative fares, nulls, odd durations.

    One scan: rows to be repeated are exploded to two copies rather than read again.
    """
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    vendorless = F.col("user_id") % 8 == 7
    dropoff_zone = (F.col("user_id") * 7 + F.col("event_id")) % 150
    tip = F.when(F.col("event_type") == "view", F.round(F.col("value") * 0.2, 2)).otherwise(0.0)

    def unless_vendorless(value: Column) -> Column:
        return F.when(~vendorless, value)

    trips = events.select(
        (1 + F.col("user_id") % 2).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", k * 300 - 600, F.col("ts")).alias("tpep_dropoff_datetime"),
        unless_vendorless((F.col("user_id") % 8).cast("double")).alias("passenger_count"),
        (k / F.lit(10.0)).alias("trip_distance"),
        unless_vendorless(F.lit(2.0)).alias("RatecodeID"),
        F.when(vendorless, F.lit(None).cast("string"))
        .when(F.col("user_id") % 5 == 0, "Y")
        .otherwise("N")
        .alias("store_and_fwd_flag"),
        F.col("user_id").alias("PULocationID"),
        dropoff_zone.alias("DOLocationID"),
        F.when(F.col("event_type") == "view", 1)
        .when(F.col("event_type") == "click", 2)
        .when(F.col("event_type") == "signup", 3)
        .when(F.col("event_type") == "error", 4)
        .otherwise(0)
        .cast("bigint")
        .alias("payment_type"),
        F.round(F.col("value") - 2, 2).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        tip.alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.round(F.col("value") + 1 + tip, 2).alias("total_amount"),
        unless_vendorless(F.lit(2.5)).alias("congestion_surcharge"),
        unless_vendorless(F.lit(1.25)).alias("airport_fee"),
    )
    copies = F.when(F.col("DOLocationID") < 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return trips.select("*", F.explode(copies).alias("copy")).select(*RAW_COLUMNS)
