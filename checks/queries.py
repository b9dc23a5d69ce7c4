"""Every registered query: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.trip_source import NUDGE, RULES, raw_trips, table
from tripmart.functions import (
    count_where,
    label_for,
    minutes_between,
    null_counts,
    row_count,
    rounded,
    safe_ratio,
)
from tripmart.operators import cleaning, keymap, layout, profile, scans, sketches, star, validation
from tripmart.operators.quantiles import quantiles
from tripmart.plans import charts, reports, trips, warehouse
from tripmart.plans.trip_rules import (
    DISTRIBUTION_COLUMNS,
    FACT_COLUMNS,
    PASSENGER_DEFAULT,
    PASSENGER_GROUPS,
    WEEKDAY_NAMES,
)
from tripmart.sources import landing, publish, readers, sinks
from tripmart.sources.workspace import workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Warehouses written in this application, by (application, input directory).
_WAREHOUSES: dict[tuple[str, str], warehouse.Warehouse] = {}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
TEXT_TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SHORT_TRIP = 0.5  # the smallest distance above zero in the derived trips is 0.1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stored(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The warehouse built from ``sf_dir``: written once per application, and again if the
    shared folder was cleared in between."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _WAREHOUSES:
        _, missing = readers.read_available(spark, _WAREHOUSES[key].paths)
        if missing:
            del _WAREHOUSES[key]
    if key not in _WAREHOUSES:
        base = workspace(spark, "warehouse")
        _WAREHOUSES[key] = warehouse.build_warehouse(spark, raw_trips(spark, sf_dir), base, RULES)
    return _WAREHOUSES[key]


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir).table(spark, warehouse.FACT)


def distinct_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the repair steps: no repeated rows, no empty trips."""
    return raw_trips(spark, sf_dir).transform(cleaning.drop_exact_duplicates).transform(
        cleaning.keep_positive, "trip_distance"
    )


# --- sources ----------------------------------------------------------------


@query
def scan_with_fallback(spark, sf_dir):
    paths = [f"{sf_dir}/no_such_table.parquet", f"{sf_dir}/events.parquet"]
    return readers.load_summary(readers.read_first_available(spark, paths), "events")


@query
def scan_partitioned_period(spark, sf_dir):
    period = stored(spark, sf_dir).table(
        spark, warehouse.FACT, "pickup_year = 2024 AND pickup_month = 1"
    )
    return period.groupBy("pickup_month", "pickup_date").agg(
        row_count().alias("trip_count"), rounded(F.sum("total_amount"), 2, NUDGE).alias("revenue")
    )


@query
def optional_tables_as_views(spark, sf_dir):
    names = [*TABLES, *TEXT_TABLES, "no_such_table"]
    found, missing = readers.read_available(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
    readers.register_views({f"v_{n}": df for n, df in found.items()})
    counts = [f"SELECT '{n}' AS table_name, true AS loaded, count(*) AS row_count FROM v_{n}" for n in found]
    absent = [f"SELECT '{n}', false, CAST(NULL AS BIGINT)" for n in missing]
    return spark.sql(" UNION ALL ".join(counts + absent))


@query
def landing_manifest(spark, sf_dir):
    """One text file of order keys per year."""
    path = workspace(spark, "order-keys")
    keys = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), keys.alias("value")).repartition(
        "year"
    ).sortWithinPartitions("year", "value").write.partitionBy("year").text(path)
    found = landing.landing_manifest(spark, path, glob="*.txt")
    year = F.regexp_extract("path", "year=([0-9]+)/", 1).cast("int")
    return found.select(year.alias("year"), "size_bytes", "extension", "md5", "non_empty", "extension_ok")


@query
def landing_file_verdicts(spark, sf_dir):
    """One Parquet file of orders per year, each with its verdict."""
    path = workspace(spark, "order-years")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    orders.repartition("year").write.partitionBy("year").parquet(path)
    found = landing.file_verdicts(spark, path, min_rows=2000)
    year = F.regexp_extract("path", "year=([0-9]+)/", 1).cast("int")
    return found.select(year.alias("year"), "row_count", "fault", "extension_ok", "enough_rows", "accepted")


@query
def landing_rows_per_file(spark, sf_dir):
    """Every table, and a file without rows."""
    frames = [landing.rows_per_file(table(spark, sf_dir, n)) for n in [*TABLES, *TEXT_TABLES]]
    nothing = workspace(spark, "nothing")
    table(spark, sf_dir, "region").limit(0).coalesce(1).write.parquet(nothing)
    empty = landing.rows_per_file(spark.read.parquet(nothing)).withColumn("file_name", F.lit("(no rows)"))
    return star.union_all([*frames, empty]).drop("path")


@query
def landing_by_month(spark, sf_dir):
    """Landed in two calls, one of whole years each."""
    orders, base = table(spark, sf_dir, "orders"), workspace(spark, "landing")
    even = F.year("o_orderdate") % 2 == 0
    for part in (even, ~even):
        path = landing.land_by_month(orders.filter(part), "o_orderdate", base, "orders")
    return (
        readers.read_table(spark, path)
        .groupBy("year", "month")
        .agg(
            row_count().alias("order_count"),
            rounded(F.sum("o_totalprice"), 2, NUDGE).alias("total_price"),
        )
    )


# --- sinks ------------------------------------------------------------------


@query
def landing_published_months(spark, sf_dir):
    """All months published in part, then whole; an older state beside the newest one."""
    orders, base = table(spark, sf_dir, "orders"), workspace(spark, "published")
    landing.land_published(orders.filter("o_orderkey % 2 = 0"), "o_orderdate", base, "orders")
    path = landing.land_published(orders, "o_orderdate", base, "orders")
    return star.union_all([
        publish.read_published(spark, path, version=state)
        .groupBy("year", "month")
        .agg(row_count().alias("order_count"), rounded(F.sum("o_totalprice"), 2, NUDGE).alias("total_price"))
        .withColumn("state", F.lit(state))
        for state in (1, 2)
    ])


@query
def sink_overwrite_parquet(spark, sf_dir):
    path = workspace(spark, "customer")
    sinks.write_table(table(spark, sf_dir, "nation"), path)
    sinks.write_table(table(spark, sf_dir, "customer"), path)
    return readers.read_table(spark, path)


@query
def sink_overwrite_partitioned(spark, sf_dir):
    path = sinks.write_table(
        table(spark, sf_dir, "lineitem"), workspace(spark, "lineitem"), ["l_returnflag"]
    )
    return readers.read_table(spark, path)


@query
def sink_named_tables(spark, sf_dir):
    names = ["region", "nation", "supplier"]
    written = sinks.write_tables(
        {n: table(spark, sf_dir, n) for n in names}, workspace(spark, "named")
    )
    return star.union_all(
        [
            readers.read_table(spark, p).agg(row_count().alias("row_count")).select(
                F.lit(n).alias("table_name"), "row_count"
            )
            for n, p in written.items()
        ]
    )


@query
def sink_csv_report(spark, sf_dir):
    report = reports.revenue_trend(fact(spark, sf_dir), nudge=NUDGE)
    path = sinks.write_csv(report, workspace(spark, "report"))
    return spark.read.option("header", "true").schema(report.schema).csv(path)


# --- projections and scalars ------------------------------------------------


@query
def trip_time_parts(spark, sf_dir):
    return trips.derive_measures(raw_trips(spark, sf_dir), NUDGE).select(
        "tpep_pickup_datetime",
        "pickup_hour",
        "pickup_dayofweek",
        "pickup_month",
        "pickup_date",
        "is_weekend",
        "time_of_day",
        "trip_duration_mins",
    )


@query
def trip_labels(spark, sf_dir):
    timed = trips.derive_measures(raw_trips(spark, sf_dir), NUDGE)
    return timed.select("payment_type", "payment_label", "passenger_count", "pickup_dayofweek").withColumns(
        {
            "day_name": label_for("pickup_dayofweek", WEEKDAY_NAMES),
            "pax_group": label_for("passenger_count", PASSENGER_GROUPS, PASSENGER_DEFAULT),
        }
    )


@query
def trip_guarded_ratios(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return raw.select(
        "fare_amount",
        "tip_amount",
        "trip_distance",
        safe_ratio("tip_amount", "fare_amount", 100.0, nudge=NUDGE).alias("tip_pct"),
        safe_ratio("fare_amount", "trip_distance", nudge=NUDGE).alias("revenue_per_mile"),
        rounded(F.col("total_amount") - F.col("fare_amount") - F.col("tip_amount"), 1, NUDGE).alias("other_amount"),
    )


@query
def casts_and_defaults(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        text.cast("int").alias("k"),
        F.coalesce(F.get_json_object("props", "$.none").try_cast("double"), F.lit(0.0)).alias("absent"),
        F.col("event_type").try_cast("int").alias("not_a_number"),
        F.col("ts").cast("string").try_cast("timestamp_ntz").alias("ts"),
        F.lit("events").alias("origin"),
    )


# --- filters ----------------------------------------------------------------


@query
def filter_positive_distance(spark, sf_dir):
    return cleaning.keep_positive(raw_trips(spark, sf_dir), "trip_distance").select(
        "VendorID", "tpep_pickup_datetime", "trip_distance"
    )


@query
def filter_duration_range(spark, sf_dir):
    timed = raw_trips(spark, sf_dir).select(
        "VendorID",
        "tpep_pickup_datetime",
        minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime").alias("minutes"),
    )
    return cleaning.keep_in_range(timed, "minutes", 0.0, 360.0)


@query
def filter_passengers_between(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return raw.filter(F.col("passenger_count").between(1, 6)).select(
        "VendorID", "tpep_pickup_datetime", "passenger_count"
    )


@query
def filter_payment_in_set(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return raw.filter(F.col("payment_type").isin(3, 4)).select(
        "VendorID", "tpep_pickup_datetime", "payment_type"
    )


@query
def filter_missing_passengers(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    return raw.filter(F.col("passenger_count").isNull()).select(
        "VendorID", "tpep_pickup_datetime", "passenger_count"
    )


# --- cleaning ---------------------------------------------------------------


@query
def clean_drop_duplicates(spark, sf_dir):
    return cleaning.drop_exact_duplicates(raw_trips(spark, sf_dir))


@query
def clean_drop_empty_trips(spark, sf_dir):
    return distinct_trips(spark, sf_dir)


@query
def clean_limits(spark, sf_dir):
    limits = trips.trip_limits(distinct_trips(spark, sf_dir), RULES)
    return limits.select(*[rounded(c, 4, NUDGE).alias(c) for c in limits.columns])


@query
def clean_repair_negative_fares(spark, sf_dir):
    rows = distinct_trips(spark, sf_dir)
    median = quantiles(rows, {"m": (F.when(F.col("fare_amount") > 0, F.col("fare_amount")), 0.5)})
    return (
        cleaning.repair_negative(rows, "fare_amount", median.scalar())
        .withColumn("fare_amount", rounded("fare_amount", 4, NUDGE))
        .select("VendorID", "tpep_pickup_datetime", "DOLocationID", "fare_amount")
    )


@query
def clean_winsorise_totals(spark, sf_dir):
    rows = distinct_trips(spark, sf_dir)
    limits = cleaning.repair_limits(rows, "fare_amount", "total_amount", 3.0)
    at = limits.select(F.struct("*").alias("l")).scalar()
    return (
        cleaning.winsorise(rows, "total_amount", at["cap_low"], at["cap_high"])
        .withColumn("total_amount", rounded("total_amount", 4, NUDGE))
        .select("VendorID", "tpep_pickup_datetime", "DOLocationID", "total_amount")
    )


@query
def clean_impute_passengers(spark, sf_dir):
    return cleaning.impute_missing_or_zero(raw_trips(spark, sf_dir), "passenger_count", 1).select(
        "VendorID", "tpep_pickup_datetime", "passenger_count"
    )


@query
def clean_flag_to_boolean(spark, sf_dir):
    return cleaning.flag_to_boolean(raw_trips(spark, sf_dir), "store_and_fwd_flag").select(
        "VendorID", "tpep_pickup_datetime", "store_and_fwd_flag"
    )


@query
def clean_fill_nulls(spark, sf_dir):
    return cleaning.fill_nulls(raw_trips(spark, sf_dir), RULES.null_defaults).select(
        "VendorID", "tpep_pickup_datetime", *RULES.null_defaults
    )


@query
def clean_standard_timestamps(spark, sf_dir):
    texts = raw_trips(spark, sf_dir).select(
        "VendorID", F.col("tpep_pickup_datetime").cast("string").alias("tpep_pickup_datetime")
    )
    return cleaning.standardise_timestamps(texts, ["tpep_pickup_datetime"], "timestamp_ntz")


@query
def clean_trips_whole(spark, sf_dir):
    clean = trips.clean_trips(raw_trips(spark, sf_dir), RULES)
    columns = [c for c in FACT_COLUMNS if c != "trip_id"]
    return clean.select(*columns).withColumns(
        {c: rounded(c, 4, NUDGE) for c in ("fare_amount", "total_amount", "trip_duration_mins")}
    )


@query
def clean_repair_by_distance_share(spark, sf_dir):
    return (
        trips.repair_by_share(distinct_trips(spark, sf_dir))
        .withColumn("fare_amount", rounded("fare_amount", 4, NUDGE))
        .select("VendorID", "tpep_pickup_datetime", "DOLocationID", "trip_distance", "share", "fare_amount")
    )


# --- star schema ------------------------------------------------------------


@query
def star_stable_keys(spark, sf_dir):
    """Keys of part and supplier from two builds: the first over early lines, the second over all."""
    lines, path = table(spark, sf_dir, "lineitem"), workspace(spark, "pair-keys")
    natural = ["l_partkey", "l_suppkey"]
    for rows in (lines.filter("l_shipdate < '1995-01-01'"), lines):
        keymap.extend_key_map(rows, natural, path, "pair_key")
    keyed = keymap.with_keys(lines.select(*natural, "l_quantity"), publish.read_published(spark, path), natural, "pair_key")
    return keyed.groupBy("pair_key", *natural).agg(
        row_count().alias("line_count"), F.sum("l_quantity").cast("double").alias("quantity")
    )


@query
def star_bucketed_join(spark, sf_dir):
    """Order lines and orders stored in the same buckets, joined side by side."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    joined = layout.co_bucket(lines, orders, "l_orderkey", "o_orderkey").join(spark, "left")
    return joined.groupBy("o_orderpriority", F.year("o_orderdate").alias("order_year")).agg(
        row_count().alias("line_count"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
    )


@query
def star_period_pruned(spark, sf_dir):
    """Trips of hours chosen in the time dimension; the months they lie in are found while running."""
    built = stored(spark, sf_dir)
    chosen = "is_weekend AND pickup_hour < 12 AND pickup_date < '2024-01-20'"
    trips_then = warehouse.trips_at_times(fact(spark, sf_dir), built.table(spark, "dim_time"), chosen)
    return trips_then.groupBy("pickup_date", "pickup_hour").agg(row_count().alias("trip_count"))


@query
def star_fact_stored(spark, sf_dir):
    columns = [c for c in FACT_COLUMNS if c != "trip_id"]
    return fact(spark, sf_dir).select(*columns).withColumns(
        {c: rounded(c, 4, NUDGE) for c in ("fare_amount", "total_amount", "trip_duration_mins")}
    )


@query
def star_dim_time(spark, sf_dir):
    return stored(spark, sf_dir).table(spark, "dim_time")


@query
def star_dim_location(spark, sf_dir):
    return stored(spark, sf_dir).table(spark, "dim_location")


@query
def star_dim_payment(spark, sf_dir):
    return stored(spark, sf_dir).table(spark, "dim_payment")


@query
def star_dim_vendor(spark, sf_dir):
    return stored(spark, sf_dir).table(spark, "dim_vendor")


@query
def star_table_sizes(spark, sf_dir):
    tables = warehouse.star_schema(trips.clean_trips(raw_trips(spark, sf_dir), RULES))
    return star.union_all(
        [
            df.agg(row_count().alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
            for n, df in tables.items()
        ]
    )


@query
def star_key_uniqueness(spark, sf_dir):
    rows = cleaning.drop_exact_duplicates(raw_trips(spark, sf_dir))
    frames = []
    for kind in ("sequence", "hash64", "hash128"):
        keyed = star.surrogate_key(rows, "trip_id", kind).select(F.col("trip_id").cast("string"))
        frames.append(
            keyed.agg(
                row_count().alias("row_count"), F.count_distinct("trip_id").alias("key_count")
            ).select(F.lit(kind).alias("key_kind"), "row_count", "key_count")
        )
    return star.union_all(frames)


@query
def union_all_zone_roles(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    mentions = star.union_all(
        [raw.select(F.col("PULocationID").alias("location_id")), raw.select("DOLocationID")]
    )
    return mentions.groupBy("location_id").agg(row_count().alias("mentions"))


@query
def distinct_zone_pairs(spark, sf_dir):
    return star.dimension(raw_trips(spark, sf_dir), ["PULocationID", "DOLocationID"])


@query
def star_join_orders(spark, sf_dir):
    per_customer = star.aggregate_by_key(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        {"order_count": row_count(), "price": F.sum("o_totalprice")},
    )
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    joined = star.star_join(
        per_customer,
        {
            "customer": (customer, per_customer["o_custkey"] == customer["c_custkey"]),
            "nation": (nation, customer["c_nationkey"] == nation["n_nationkey"]),
            "region": (region, nation["n_regionkey"] == region["r_regionkey"]),
        },
    )
    return joined.groupBy("r_name", "c_mktsegment").agg(
        F.sum("order_count").alias("order_count"),
        rounded(F.sum("price"), 2, NUDGE).alias("total_price"),
    )


@query
def star_join_lineitem(spark, sf_dir):
    sold = star.aggregate_by_key(
        table(spark, sf_dir, "lineitem"),
        ["l_partkey", "l_suppkey"],
        {"line_count": row_count(), "quantity": F.sum("l_quantity")},
    )
    part, supplier, nation = (table(spark, sf_dir, n) for n in ("part", "supplier", "nation"))
    joined = star.star_join(
        sold,
        {
            "part": (part, sold["l_partkey"] == part["p_partkey"]),
            "supplier": (supplier, sold["l_suppkey"] == supplier["s_suppkey"]),
            "nation": (nation, supplier["s_nationkey"] == nation["n_nationkey"]),
        },
        "left",
    )
    return joined.groupBy("p_brand", "n_name").agg(
        F.sum("line_count").alias("line_count"), F.sum("quantity").alias("quantity")
    )


# --- aggregates -------------------------------------------------------------


@query
def agg_row_count(spark, sf_dir):
    return raw_trips(spark, sf_dir).agg(row_count().alias("row_count"))


@query
def agg_conditional_counts(spark, sf_dir):
    return raw_trips(spark, sf_dir).groupBy("VendorID").agg(
        row_count().alias("row_count"),
        count_where(F.col("payment_type").isin(3, 4)).alias("disputed"),
        rounded(F.avg("total_amount"), 2, NUDGE).alias("avg_total"),
        rounded(F.sum("total_amount"), 2, NUDGE).alias("total"),
    )


@query
def agg_null_counts(spark, sf_dir):
    return null_counts(raw_trips(spark, sf_dir))


@query
def agg_exact_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quantiles(
        lines,
        {
            "price_p01": ("l_extendedprice", 0.01),
            "price_q1": ("l_extendedprice", 0.25),
            "price_median": ("l_extendedprice", 0.5),
            "price_p99": ("l_extendedprice", 0.99),
            "quantity_median": ("l_quantity", 0.5),
        },
    ).select(
        *[
            rounded(c, 4, NUDGE).alias(c)
            for c in ("price_p01", "price_q1", "price_median", "price_p99", "quantity_median")
        ]
    )


@query
def agg_approx_quantiles(spark, sf_dir):
    """Whether each sketched quantile lies within its relative rank error."""
    lines = table(spark, sf_dir, "lineitem")
    error = 0.01
    shares = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = quantiles(
        lines, {n: ("l_extendedprice", p) for n, p in shares.items()}, "approx", int(1 / error)
    )
    at = found.select(F.struct("*").alias("q")).scalar()
    price = F.col("l_extendedprice")
    return lines.agg(
        *[
            (
                (F.count_if(price < at[n]) <= (p + error) * row_count())
                & (F.count_if(price <= at[n]) >= (p - error) * row_count())
            ).alias(n)
            for n, p in shares.items()
        ]
    )


# --- reports ----------------------------------------------------------------


@query
def report_hour_weekday_revenue(spark, sf_dir):
    return reports.hour_weekday_revenue(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_zone_demand(spark, sf_dir):
    return reports.zone_demand(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_payment_tips(spark, sf_dir):
    return reports.payment_tips(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_daily_fares(spark, sf_dir):
    return reports.daily_fares(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_segment_anomalies(spark, sf_dir):
    return reports.segment_anomalies(fact(spark, sf_dir), SHORT_TRIP, nudge=NUDGE)


@query
def report_passenger_groups(spark, sf_dir):
    return reports.passenger_groups(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_passenger_tiles(spark, sf_dir):
    return reports.passenger_groups(fact(spark, sf_dir), nudge=NUDGE, revenue_tiles=2)


@query
def report_vendor_performance(spark, sf_dir):
    return reports.vendor_performance(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_revenue_trend(spark, sf_dir):
    return reports.revenue_trend(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_fare_alerts(spark, sf_dir):
    return reports.fare_alerts(fact(spark, sf_dir), nudge=NUDGE)


@query
def report_audit_segments(spark, sf_dir):
    segments = reports.segment_anomalies(fact(spark, sf_dir), SHORT_TRIP, nudge=NUDGE)
    path = sinks.write_audit(
        segments, F.col("dispute_pct") > 3, workspace(spark, "audit"), ["time_of_day"]
    )
    return readers.read_table(spark, path)


# --- chart datasets ---------------------------------------------------------


@query
def chart_hour_weekday_grid(spark, sf_dir):
    return charts.hour_weekday_grid(fact(spark, sf_dir), NUDGE)


@query
def chart_top_zones(spark, sf_dir):
    return charts.top_zones(fact(spark, sf_dir))


@query
def chart_bucket_volume(spark, sf_dir):
    return charts.bucket_volume(fact(spark, sf_dir))


@query
def chart_anomaly_volume(spark, sf_dir):
    return charts.anomaly_volume(fact(spark, sf_dir), SHORT_TRIP)


@query
def chart_fare_trend_line(spark, sf_dir):
    return charts.fare_trend_line(fact(spark, sf_dir), nudge=NUDGE)


@query
def chart_vendor_grid(spark, sf_dir):
    return charts.vendor_grid(fact(spark, sf_dir), NUDGE)


@query
def chart_payment_tips_sorted(spark, sf_dir):
    tips = reports.payment_tips(fact(spark, sf_dir), nudge=NUDGE)
    return charts.display_sorted(tips, "avg_tip_pct", "payment_label").select(
        "payment_label", "avg_tip_pct", "avg_tip_amount"
    )


# --- running values and ranks over all rows -----------------------------------


@query
def rows_running_values(spark, sf_dir):
    """Running total, lag, change and 7-row mean of every event, in the order of time."""
    found = scans.scan_rows(
        table(spark, sf_dir, "events").select("event_id", "ts", "value"),
        F.col("value").cast("decimal(18,2)"), ["ts", "event_id"],
        "running", "previous", "change", "moving", nudge=NUDGE,
    )
    money = [F.col(c).cast("double").alias(c) for c in ("running", "previous", "change", "moving")]
    return found.select("event_id", "ts", *money)


@query
def rows_global_ranks(spark, sf_dir):
    """Ranks of all order lines by flag and quantity: each flag's ties fill several slices."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    orders = {"flag": ["l_returnflag"], "quantity": [("l_quantity", "desc")]}
    return star.union_all([
        scans.rank_rows(lines, by, "place", "dense_place").withColumn("ranked_by", F.lit(name))
        for name, by in orders.items()
    ])


@query
def rows_global_tiles(spark, sf_dir):
    """Row numbers and tiles of all order lines in an order without ties."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [("l_extendedprice", "desc"), "l_orderkey", "l_linenumber"]
    return scans.rank_rows(lines, order, row_number="place", ntile={"quartile": 4, "hundredth": 100})


# --- stored sketches ----------------------------------------------------------

SKETCHED = {"price": "l_extendedprice", "quantity": "l_quantity"}
SKETCHED_SHARES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
SKETCH_ERROR = 0.01


def landed_sketches(spark, sf_dir):
    """Order lines with their ship month, and sketches by month. Some months land in part first; when
    they land again, their sketches are replaced."""
    month = {"year": F.year("l_shipdate"), "month": F.month("l_shipdate")}
    lines = table(spark, sf_dir, "lineitem").withColumns(month)
    base = workspace(spark, "sketches")
    for rows in (lines.filter("l_linenumber = 1 AND month % 2 = 0"), lines):
        path = sketches.land_sketches(rows, SKETCHED, ["year", "month"], base)
    return lines, sketches.read_sketches(spark, path)


def rank_checked(lines, found, by=()):
    """Whether the rank of each quantile in ``found`` is off by no more than the error, from the rows."""
    names = [c for c in found.columns if c in SKETCHED_SHARES]
    asked = found.unpivot([*by, "series", "n"], names, "share_name", "at")  # one row per quantile
    share = F.element_at(F.create_map(*[F.lit(x) for kv in SKETCHED_SHARES.items() for x in kv]), F.col("share_name"))
    long = lines.select(*by, *[F.col(c).cast("double").alias(n) for n, c in SKETCHED.items()]).unpivot(
        [*by], list(SKETCHED), "series", "value"
    )
    counted = long.join(F.broadcast(asked), [*by, "series"]).groupBy(*by, "series", "n", "share_name").agg(
        F.count_if(F.col("value") < F.col("at")).alias("below"), F.count_if(F.col("value") <= F.col("at")).alias("upto")
    )
    within = (F.col("below") <= (share + SKETCH_ERROR) * F.col("n")) & (F.col("upto") >= (share - SKETCH_ERROR) * F.col("n"))
    return counted.select(*by, "series", "n", "share_name", within.alias("within_error"))


@query
def sketch_quantiles_merged(spark, sf_dir):
    """Quantiles of all months together: rows that the sketches stand for, and whether the ranks hold."""
    lines, stored_sketches = landed_sketches(spark, sf_dir)
    return rank_checked(lines, sketches.merged_quantiles(stored_sketches, SKETCHED_SHARES))


@query
def sketch_quantiles_by_year(spark, sf_dir):
    """The same per year, with the year's range."""
    lines, stored_sketches = landed_sketches(spark, sf_dir)
    found = sketches.merged_quantiles(stored_sketches, {"p50": 0.5}, ["year"])
    checked = rank_checked(lines, found, ["year"]).drop("n", "share_name")
    return found.drop("p50").join(checked, ["year", "series"])


# --- profile ----------------------------------------------------------------


@query
def profile_schema(spark, sf_dir):
    return profile.schema_table(raw_trips(spark, sf_dir), samples=0, nudge=NUDGE)


@query
def profile_schema_samples(spark, sf_dir):
    return profile.schema_table(table(spark, sf_dir, "orders"), "o_orderkey", nudge=NUDGE)


@query
def profile_missing(spark, sf_dir):
    return profile.missing_table(raw_trips(spark, sf_dir), NUDGE)


@query
def profile_missing_chart(spark, sf_dir):
    return profile.missing_chart(raw_trips(spark, sf_dir), NUDGE)


@query
def profile_missing_chart_none(spark, sf_dir):
    return profile.missing_chart(table(spark, sf_dir, "lineitem"), NUDGE)


@query
def profile_numeric_summary(spark, sf_dir):
    return profile.numeric_summary(raw_trips(spark, sf_dir), nudge=NUDGE)


@query
def profile_numeric_lineitem(spark, sf_dir):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), columns, nudge=NUDGE)


@query
def profile_duplicates(spark, sf_dir):
    return profile.duplicate_summary(raw_trips(spark, sf_dir))


@query
def profile_issues(spark, sf_dir):
    return profile.quality_issues(raw_trips(spark, sf_dir), nudge=NUDGE)


@query
def profile_histograms(spark, sf_dir):
    return profile.histograms(raw_trips(spark, sf_dir), DISTRIBUTION_COLUMNS, nudge=NUDGE)


@query
def profile_densities(spark, sf_dir):
    return profile.densities(raw_trips(spark, sf_dir), DISTRIBUTION_COLUMNS, nudge=NUDGE)


# --- validation -------------------------------------------------------------


@query
def validate_stored_tables(spark, sf_dir):
    built = stored(spark, sf_dir)
    tables = {n: built.table(spark, n) for n in built.paths}
    summary = validation.validate_tables(tables, paths=built.paths)
    return summary.drop("path")


@query
def validate_key_nulls(spark, sf_dir):
    built = stored(spark, sf_dir)
    return star.union_all(
        [
            validation.key_nulls(built.table(spark, n), n, keys)
            for n, keys in validation.KEY_COLUMNS.items()
        ]
    )


@query
def validate_reconciliation(spark, sf_dir):
    return validation.reconcile(raw_trips(spark, sf_dir), fact(spark, sf_dir), NUDGE)


def counted_build(spark, sf_dir):
    """Counts of a build of its own, taken while its tables were written."""
    base = workspace(spark, "counted-warehouse")
    _, counts = warehouse.build_warehouse_counted(spark, raw_trips(spark, sf_dir), base, RULES)
    return counts


@query
def build_counted_tables(spark, sf_dir):
    return validation.counted_checks(spark, counted_build(spark, sf_dir).tables).drop("path")


@query
def build_counted_steps(spark, sf_dir):
    """Rows that came in, that went by reason, and that were stored."""
    counts = counted_build(spark, sf_dir)
    stored_rows = counts.tables[warehouse.FACT]["row_count"]
    rows = [("raw", counts.load["raw_rows"]), *counts.removed().items(), ("stored", stored_rows)]
    return spark.createDataFrame(rows, "step string, step_rows long")
