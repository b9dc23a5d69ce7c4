"""Clean trips -> star schema on storage."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators.star import dimension, role_dimension, surrogate_key
from tripmart.operators.validation import KEY_COLUMNS
from tripmart.plans.trip_rules import FACT_COLUMNS, TIME_COLUMNS, CleaningRules
from tripmart.plans.trips import clean_trips, clean_trips_counted
from tripmart.sources.readers import read_available, read_table, register_views
from tripmart.sources.sinks import gather_by, told, write_counted, write_table, write_tables

FACT = "fact_trips"
DIMENSIONS = ("dim_time", "dim_location", "dim_payment", "dim_vendor")
# A month number alone would put the same month of different years into one partition.
PARTITIONS = ("pickup_year", "pickup_month")


def fact_trips(clean: DataFrame, key: str = "sequence") -> DataFrame:
    """The fact table: surrogate key, the trip columns, and the year to partition by."""
    columns = [c for c in FACT_COLUMNS if c != "trip_id"]
    return surrogate_key(clean.select(*columns, "pickup_year"), "trip_id", key)


def trip_dimensions(trips: DataFrame) -> dict[str, DataFrame]:
    """The four dimensions, from clean trips or from the stored fact table."""
    return {
        "dim_time": dimension(trips, TIME_COLUMNS),
        "dim_location": role_dimension(trips, ["PULocationID", "DOLocationID"], "location_id"),
        "dim_payment": dimension(trips, ["payment_type", "payment_label"], ["payment_type"]),
        "dim_vendor": dimension(trips, ["VendorID"]),
    }


def star_schema(clean: DataFrame, key: str = "sequence") -> dict[str, DataFrame]:
    """All five tables as lazy frames."""
    return {FACT: fact_trips(clean, key), **trip_dimensions(clean)}


@dataclass(frozen=True)
class Warehouse:
    """Paths of the stored tables and, where they are known, their schemas."""

    paths: dict[str, str]
    schemas: dict[str, StructType] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
        return read_table(spark, self.paths[name], where, self.schemas.get(name))

    def register(self, spark: SparkSession) -> list[str]:
        """Expose the tables to SQL; returns the names of dimensions that are missing."""
        register_views({FACT: self.table(spark, FACT)})
        known = {n: self.paths[n] for n in DIMENSIONS if n in self.paths}
        found, missing = read_available(spark, known)
        register_views(found)
        return [n for n in DIMENSIONS if n not in known or n in missing]


def build_warehouse(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    rules: CleaningRules = CleaningRules(),
    key: str = "sequence",
) -> Warehouse:
    """Clean, write the fact, then derive the dimensions from what was written.

    The cleaning plan runs once. The dimensions read only their own few columns back from
    Parquet, so nothing has to stay cached, and a lost executor never repeats the cleaning.
    The key is added behind the last shuffle: a running number handed out before it could be
    handed out twice if a lost task had to be repeated with its rows in another order.
    """
    fact = fact_trips(gather_by(clean_trips(raw, rules), PARTITIONS), key)
    fact_path = write_table(
        fact,
        f"{base.rstrip('/')}/{FACT}",
        PARTITIONS,
        gather=False,
        sort_within=["pickup_date"],
    )
    dimensions = trip_dimensions(read_table(spark, fact_path, schema=fact.schema))
    paths = {FACT: fact_path, **write_tables(dimensions, base)}
    schemas = {FACT: fact.schema, **{n: df.schema for n, df in dimensions.items()}}
    return Warehouse(paths, schemas)


def trips_at_times(fact: DataFrame, dim_time: DataFrame, where: str) -> DataFrame:
    """Trips whose hour satisfies a condition on ``dim_time``.

    The year and month of the dimension's date are part of the join, so the months that the condition
    leaves are known before the fact is read, and the others are not opened. Hours are unique in ``dim_time``.
    """
    trips, times = fact.alias("trips"), dim_time.filter(where).alias("times")
    condition = (
        (F.col("trips.pickup_date") == F.col("times.pickup_date"))
        & (F.col("trips.pickup_hour") == F.col("times.pickup_hour"))
        & (F.col("trips.pickup_year") == F.year("times.pickup_date"))
        & (F.col("trips.pickup_month") == F.month("times.pickup_date"))
    )
    return trips.join(times, condition).select("trips.*")


@dataclass(frozen=True)
class BuildCounts:
    """What the jobs of one build have counted on their way.

    ``load`` holds ``raw_rows``, ``unmeasured_rows`` and ``distinct_rows``; ``tables`` holds by table the
    ``row_count`` and, by key column, the nulls.
    """

    load: dict[str, int]
    tables: dict[str, dict[str, int]]

    def removed(self) -> dict[str, int]:
        """Rows that went, by reason: repeated, without a measure, of implausible duration."""
        stored = self.tables[FACT]["row_count"]
        load = self.load
        return {
            "no_distance": load["unmeasured_rows"],
            "repeated": load["raw_rows"] - load["unmeasured_rows"] - load["distinct_rows"],
            "implausible_duration": load["distinct_rows"] - stored,
        }


def build_warehouse_counted(
    spark: SparkSession,
    raw: DataFrame,
    base: str,
    rules: CleaningRules = CleaningRules(),
    key: str = "sequence",
) -> tuple[Warehouse, BuildCounts]:
    """``build_warehouse``, with all counts for the load summary, the checks and the reconciliation.

    Raw trips are read once and no stored table is read to count it. Counts hold when executors are lost:
    those of the load are made behind the shuffle of the duplicate removal, those of a table in the tasks that write it.
    Only where no trip is left, so that nothing runs which could count, the load is counted by a job of its own.
    """
    loaded = Observation()
    clean, load = clean_trips_counted(raw, rules, loaded)
    fact = fact_trips(gather_by(clean, PARTITIONS), key)
    paths = {FACT: f"{base.rstrip('/')}/{FACT}"}
    counts = {
        FACT: write_counted(fact, paths[FACT], KEY_COLUMNS[FACT], PARTITIONS, gather=False, sort_within=["pickup_date"])
    }
    found = told(loaded) or load.first().asDict()
    schemas = {FACT: fact.schema}
    for name, df in trip_dimensions(read_table(spark, paths[FACT], schema=fact.schema)).items():
        paths[name], schemas[name] = f"{base.rstrip('/')}/{name}", df.schema
        counts[name] = write_counted(df, paths[name], KEY_COLUMNS[name])
    return Warehouse(paths, schemas), BuildCounts(found, counts)
