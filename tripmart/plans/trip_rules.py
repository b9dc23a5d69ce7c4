"""The trip configuration: column names, fixed values and thresholds in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# Labels, bucket bounds, names and thresholds that results depend on.
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
PAYMENT_DEFAULT = "Unknown"
DISPUTE_TYPES = (3, 4)
TIME_BUCKETS = [(6, 12, "Morning"), (12, 17, "Afternoon"), (17, 21, "Evening")]
TIME_DEFAULT = "Night"
TIME_ORDER = ["Morning", "Afternoon", "Evening", "Night"]
WEEKDAY_NAMES = {1: "Sun", 2: "Mon", 3: "Tue", 4: "Wed", 5: "Thu", 6: "Fri", 7: "Sat"}
WEEKDAY_ORDER = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
PASSENGER_GROUPS = {1: "Solo(1)", 2: "Pair(2)", 3: "Small(3)"}
PASSENGER_DEFAULT = "Group(4-6)"
PASSENGER_RANGE = (1, 6)
RAW_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]
FACT_COLUMNS = [
    "trip_id",
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "is_weekend",
    "time_of_day",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "trip_duration_mins",
    "RatecodeID",
    "payment_type",
    "payment_label",
    "store_and_fwd_flag",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tip_pct",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "revenue_per_mile",
]
TIME_COLUMNS = [
    "pickup_date",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "is_weekend",
    "time_of_day",
]
DISTRIBUTION_COLUMNS = [
    "fare_amount",
    "trip_distance",
    "tip_amount",
    "total_amount",
    "passenger_count",
]
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class CleaningRules:
    """Thresholds of the cleaning plan."""

    iqr_multiplier: float = 3.0
    passenger_default: int = 1
    null_defaults: dict = field(
        default_factory=lambda: {
            "RatecodeID": 1.0,
            "congestion_surcharge": 0.0,
            "airport_fee": 0.0,
        }
    )
    min_minutes: float = 0.0
    max_minutes: float = 360.0
    timestamp_type: str = "timestamp"
    quantile_method: str = "exact"
    quantile_accuracy: int = 10_000
    nudge: float = 0.0
