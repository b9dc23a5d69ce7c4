"""The same results as plain SQL, for comparison in another engine.

Written from the meaning of each query, over the given tables only. The common parts are
named subqueries that each statement puts in front.
"""

from __future__ import annotations

from tripmart.operators.profile import ACTIONS
from tripmart.plans.trip_rules import (
    PASSENGER_DEFAULT,
    PASSENGER_GROUPS,
    PAYMENT_DEFAULT,
    PAYMENT_LABELS,
    TIME_BUCKETS,
    TIME_DEFAULT,
    TIME_ORDER,
    WEEKDAY_NAMES,
    WEEKDAY_ORDER,
)

RAW_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee",
]

RAW = """
source AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_type = 'view' THEN round(value * 0.2, 2) ELSE 0.0 END AS tip
  FROM events
),
once AS (
  SELECT CAST(1 + user_id % 2 AS BIGINT) AS "VendorID",
         ts AS tpep_pickup_datetime,
         ts + to_seconds(k * 300 - 600) AS tpep_dropoff_datetime,
         CASE WHEN user_id % 8 <> 7 THEN CAST(user_id % 8 AS DOUBLE) END AS passenger_count,
         k / 10.0 AS trip_distance,
         CASE WHEN user_id % 8 <> 7 THEN CAST(2.0 AS DOUBLE) END AS "RatecodeID",
         CASE WHEN user_id % 8 = 7 THEN NULL WHEN user_id % 5 = 0 THEN 'Y' ELSE 'N' END
           AS store_and_fwd_flag,
         user_id AS "PULocationID",
         CAST((user_id * 7 + event_id) % 150 AS BIGINT) AS "DOLocationID",
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                              WHEN 'error' THEN 4 ELSE 0 END AS BIGINT) AS payment_type,
         round(value - 2, 2) AS fare_amount,
         CAST(0.5 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         CAST(tip AS DOUBLE) AS tip_amount,
         CAST(0.0 AS DOUBLE) AS tolls_amount,
         CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         round(value + 1 + tip, 2) AS total_amount,
         CASE WHEN user_id % 8 <> 7 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
         CASE WHEN user_id % 8 <> 7 THEN CAST(1.25 AS DOUBLE) END AS airport_fee
  FROM source
),
raw AS (
  SELECT * FROM once
  UNION ALL
  SELECT * FROM once WHERE "DOLocationID" < 3
)"""

VALID = """
unique_rows AS (SELECT DISTINCT * FROM raw),
valid AS (SELECT * FROM unique_rows WHERE trip_distance > 0),
quartiles AS (
  SELECT quantile_cont(fare_amount, 0.5) FILTER (WHERE fare_amount > 0) AS repair_value,
         quantile_cont(total_amount, 0.25) AS q1,
         quantile_cont(total_amount, 0.75) AS q3
  FROM valid
),
limits AS (
  SELECT repair_value, q1 - 3.0 * (q3 - q1) AS cap_low, q3 + 3.0 * (q3 - q1) AS cap_high
  FROM quartiles
)"""



def case_of(column: str, labels: dict, default: str | None = None) -> str:
    """CASE expression of a fixed label table."""
    arms = " ".join(f"WHEN {key} THEN '{label}'" for key, label in labels.items())
    return f"CASE {column} {arms}" + (f" ELSE '{default}'" if default else "") + " END"


def case_between(expression: str, buckets: list, default: str) -> str:
    """CASE expression of fixed half-open ranges of whole numbers."""
    arms = " ".join(
        f"WHEN {expression} BETWEEN {low} AND {high - 1} THEN '{label}'" for low, high, label in buckets
    )
    return f"CASE {arms} ELSE '{default}' END"


MINUTES = "(floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60.0"


def derived(source: str) -> str:
    """Time parts, labels and ratios over a relation with the trip columns."""
    return f"""
SELECT *,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
       CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_dayofweek,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
       CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
       dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend,
       {case_between("hour(tpep_pickup_datetime)", TIME_BUCKETS, TIME_DEFAULT)} AS time_of_day,
       {MINUTES} AS trip_duration_mins,
       {case_of("payment_type", PAYMENT_LABELS, PAYMENT_DEFAULT)} AS payment_label,
       CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100 + 1e-9, 2)
            ELSE 0.0 END AS tip_pct,
       CASE WHEN trip_distance > 0 THEN round(fare_amount / trip_distance + 1e-9, 2)
            ELSE 0.0 END AS revenue_per_mile
FROM {source}"""


CLEAN = f"""
repaired AS (
  SELECT v."VendorID", v.tpep_pickup_datetime, v.tpep_dropoff_datetime,
         CASE WHEN v.passenger_count IS NULL OR v.passenger_count = 0 THEN 1
              ELSE CAST(v.passenger_count AS INTEGER) END AS passenger_count,
         v.trip_distance,
         coalesce(v."RatecodeID", 1.0) AS "RatecodeID",
         coalesce(v.store_and_fwd_flag = 'Y', false) AS store_and_fwd_flag,
         v."PULocationID", v."DOLocationID", v.payment_type,
         CASE WHEN v.fare_amount < 0 THEN l.repair_value ELSE v.fare_amount END AS fare_amount,
         v.extra, v.mta_tax, v.tip_amount, v.tolls_amount, v.improvement_surcharge,
         CASE WHEN v.total_amount > l.cap_high THEN l.cap_high
              WHEN v.total_amount < l.cap_low THEN l.cap_low
              ELSE v.total_amount END AS total_amount,
         coalesce(v.congestion_surcharge, 0.0) AS congestion_surcharge,
         coalesce(v.airport_fee, 0.0) AS airport_fee
  FROM valid v, limits l
),
measured AS ({derived("repaired")}),
fact AS (SELECT * FROM measured WHERE trip_duration_mins > 0 AND trip_duration_mins <= 360)"""


def over_raw(body: str, *extra: str) -> str:
    return "WITH " + ", ".join([RAW, *extra]) + " " + body


def over_valid(body: str, *extra: str) -> str:
    return over_raw(body, VALID, *extra)


def over_fact(body: str, *extra: str) -> str:
    return over_raw(body, VALID, CLEAN, *extra)


def r(expression: str, digits: int = 2) -> str:
    return f"round({expression} + 1e-9, {digits})"


COUNT = "CAST(count(*) AS BIGINT)"
DISPUTED = "payment_type IN (3, 4)"
FACT_ROWS = f"""
SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, pickup_date, pickup_hour,
       pickup_dayofweek, pickup_month, is_weekend, time_of_day, "PULocationID", "DOLocationID",
       passenger_count, trip_distance, {r("trip_duration_mins", 4)} AS trip_duration_mins,
       "RatecodeID", payment_type, payment_label, store_and_fwd_flag,
       {r("fare_amount", 4)} AS fare_amount, extra, mta_tax, tip_amount, tip_pct, tolls_amount,
       improvement_surcharge, {r("total_amount", 4)} AS total_amount, congestion_surcharge,
       airport_fee, revenue_per_mile
FROM fact"""

DAILY = f"""
daily AS (
  SELECT pickup_date, {COUNT} AS trip_count, {r("avg(fare_amount)")} AS avg_fare,
         {r("sum(total_amount)")} AS daily_revenue
  FROM fact GROUP BY pickup_date
)"""
DAILY_FARES = f"""
fares AS (
  SELECT pickup_date, {r("avg(trip_distance)")} AS avg_distance,
         {r("avg(trip_duration_mins)")} AS avg_duration, {r("avg(fare_amount)")} AS avg_fare,
         {r("avg(revenue_per_mile)")} AS avg_rev_per_mile, {COUNT} AS trip_count
  FROM fact GROUP BY pickup_date
)"""
TREND = f"""
SELECT pickup_date, trip_count, avg_fare, daily_revenue,
       {r("sum(daily_revenue) OVER (ORDER BY pickup_date ROWS UNBOUNDED PRECEDING)")}
         AS running_total_revenue,
       {r("avg(avg_fare) OVER (ORDER BY pickup_date ROWS 6 PRECEDING)")} AS moving_avg_7d,
       {r("100.0 * daily_revenue / sum(daily_revenue) OVER ()")} AS pct_of_monthly_revenue
FROM daily"""
SEGMENTS = f"""
segments AS (
  SELECT time_of_day, payment_label, {COUNT} AS total_trips,
         CAST(count(*) FILTER (WHERE trip_distance < 0.5 AND fare_amount > 50) AS BIGINT) AS suspicious,
         CAST(count(*) FILTER (WHERE {DISPUTED}) AS BIGINT) AS disputed
  FROM fact GROUP BY time_of_day, payment_label
),
ranked_segments AS (
  SELECT *, {r("100.0 * disputed / total_trips")} AS dispute_pct,
         CAST(rank() OVER (ORDER BY disputed DESC) AS INTEGER) AS anomaly_rank
  FROM segments
)"""
TIPS = f"""
tips AS (
  SELECT payment_label, {COUNT} AS trip_count, {r("avg(tip_pct)")} AS avg_tip_pct,
         {r("avg(tip_amount)")} AS avg_tip_amount, {r("avg(fare_amount)")} AS avg_fare,
         {r("avg(total_amount)")} AS avg_total
  FROM fact GROUP BY payment_label
)"""
GROUPS = f"""
pax AS (
  SELECT *, {case_of("passenger_count", PASSENGER_GROUPS, PASSENGER_DEFAULT)} AS pax_group
  FROM fact WHERE passenger_count BETWEEN 1 AND 6
),
pax_sums AS (
  SELECT pax_group, {COUNT} AS trip_count, avg(fare_amount) AS fare, avg(tip_pct) AS tip,
         avg(trip_distance) AS distance, sum(total_amount) AS revenue
  FROM pax GROUP BY pax_group
)"""
PAX_COLUMNS = f"""
pax_group, trip_count, {r("fare")} AS avg_fare, {r("tip")} AS avg_tip_pct,
{r("distance")} AS avg_distance, {r("revenue")} AS total_revenue,
{r("100.0 * revenue / sum(revenue) OVER ()")} AS revenue_share_pct,
CAST(dense_rank() OVER (ORDER BY fare DESC) AS INTEGER) AS fare_rank"""
VENDORS = f"""
vendor_sums AS (
  SELECT "VendorID", time_of_day, {COUNT} AS trip_count, avg(fare_amount) AS fare,
         avg(tip_pct) AS tip, avg(trip_duration_mins) AS minutes,
         count(*) FILTER (WHERE {DISPUTED}) AS disputed
  FROM fact GROUP BY "VendorID", time_of_day
)"""
ZONES = f"""
zones AS (
  SELECT "PULocationID" AS zone_id, time_of_day, {COUNT} AS trip_count,
         {r("avg(total_amount)")} AS avg_revenue
  FROM fact GROUP BY "PULocationID", time_of_day
),
ranked_zones AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY time_of_day ORDER BY trip_count DESC, zone_id)
                 AS INTEGER) AS zone_rank
  FROM zones
)"""

NULL_COUNTS = ", ".join(f'CAST(count(*) - count("{c}") AS BIGINT) AS "{c}"' for c in RAW_COLUMNS)
COLUMN_NULLS = (
    "column_nulls AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count(*) AS n, count(*) - count(\"{c}\") AS nulls FROM raw"
        for i, c in enumerate(RAW_COLUMNS, start=1)
    )
    + ")"
)
TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "store_and_fwd_flag": "string",
    "VendorID": "bigint",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
}
TYPE_CASE = (
    "CASE column_name "
    + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in TYPES.items())
    + " ELSE 'double' END"
)
NUMERIC = [c for c in RAW_COLUMNS if TYPES.get(c, "double") in ("double", "bigint")]


def summary_of(relation: str, column: str) -> str:
    value = f'"{column}"'
    parts = {
        "mean": f"avg({value})",
        "median": f"quantile_cont(CAST({value} AS DOUBLE), 0.5)",
        "std_dev": f"stddev_samp({value})",
        "min": f"CAST(min({value}) AS DOUBLE)",
        "max": f"CAST(max({value}) AS DOUBLE)",
    }
    columns = ", ".join(f'{r(e, 4)} AS "{n}"' for n, e in parts.items())
    return f"SELECT '{column}' AS column_name, {columns} FROM {relation}"


DISTRIBUTIONS = ["fare_amount", "trip_distance", "tip_amount", "total_amount", "passenger_count"]
CAPPED = (
    "long_values AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, \"{c}\" AS v FROM raw WHERE \"{c}\" IS NOT NULL" for c in DISTRIBUTIONS
    )
    + """),
caps AS (SELECT column_name, quantile_cont(v, 0.99) AS cap FROM long_values GROUP BY column_name),
capped AS (SELECT column_name, v FROM long_values JOIN caps USING (column_name) WHERE v <= cap),
ranges AS (
  SELECT column_name, min(v) AS low, max(v) AS high, count(*) AS n, avg(v) AS mean,
         stddev_samp(v) AS sd
  FROM capped GROUP BY column_name
)"""
)


def samples_of(relation: str, order: str, column: str) -> str:
    return f"""
SELECT '{column}' AS column_name,
       (SELECT left(string_agg(v, ', ' ORDER BY o, v), 60)
        FROM (SELECT CAST("{column}" AS VARCHAR) AS v, {order} AS o FROM {relation}
              WHERE "{column}" IS NOT NULL ORDER BY {order}, v LIMIT 5)) AS samples"""


ORDER_COLUMNS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
STORED = {
    "fact_trips": ("fact", ["trip_distance", "fare_amount", "total_amount", "payment_type"]),
    "dim_time": ("dim_time", ["pickup_date", "pickup_hour"]),
    "dim_location": ("dim_location", ["location_id"]),
    "dim_payment": ("dim_payment", ["payment_type", "payment_label"]),
    "dim_vendor": ("dim_vendor", ["VendorID"]),
}
DIM_TIME = """SELECT DISTINCT pickup_date, pickup_hour, pickup_dayofweek, pickup_month, is_weekend,
time_of_day FROM fact"""
DIM_LOCATION = """SELECT "PULocationID" AS location_id FROM fact
UNION SELECT "DOLocationID" FROM fact"""
DIM_PAYMENT = "SELECT DISTINCT payment_type, payment_label FROM fact"
DIM_VENDOR = 'SELECT DISTINCT "VendorID" FROM fact'
DIMS = f"""dim_time AS ({DIM_TIME}), dim_location AS ({DIM_LOCATION}),
dim_payment AS ({DIM_PAYMENT}), dim_vendor AS ({DIM_VENDOR})"""

KEY = '"VendorID", tpep_pickup_datetime'
PRICE = "l_extendedprice"

ORACLE: dict[str, str] = {
    # sources
    "scan_with_fallback": f"""
        SELECT 'events' AS table_name, {COUNT} AS row_count, 6 AS column_count,
               'event_id,ts,user_id,event_type,value,props' AS column_names FROM events""",
    "scan_partitioned_period": over_fact(f"""
        SELECT pickup_month, pickup_date, {COUNT} AS trip_count, {r("sum(total_amount)")} AS revenue
        FROM fact WHERE year(pickup_date) = 2024 AND pickup_month = 1
        GROUP BY pickup_month, pickup_date"""),
    "optional_tables_as_views": " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, true AS loaded, {COUNT} AS row_count FROM {t}" for t in ALL_TABLES]
        + ["SELECT 'no_such_table', false, CAST(NULL AS BIGINT)"]
    ),
    "landing_rows_per_file": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, {COUNT} AS row_count, count(*) >= 500000 AS enough_rows FROM {t}"
        for t in ALL_TABLES
    )
    + " UNION ALL SELECT '(no rows)', CAST(0 AS BIGINT), false",
    "landing_manifest": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(13 * count(*) AS BIGINT) AS size_bytes,
               '.txt' AS extension,
               md5(string_agg(lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || chr(10), '' ORDER BY o_orderkey)) AS md5,
               true AS non_empty, false AS extension_ok
        FROM orders GROUP BY 1""",
    "landing_file_verdicts": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {COUNT} AS row_count, CAST(NULL AS VARCHAR) AS fault,
               true AS extension_ok, count(*) >= 2000 AS enough_rows, count(*) >= 2000 AS accepted
        FROM orders GROUP BY 1""",
    "landing_by_month": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               {COUNT} AS order_count, {r("sum(o_totalprice)")} AS total_price
        FROM orders GROUP BY 1, 2""",
    # sinks
    "sink_overwrite_parquet": "SELECT * FROM customer",
    "sink_overwrite_partitioned": "SELECT * FROM lineitem",
    "sink_named_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {COUNT} AS row_count FROM {t}" for t in ("region", "nation", "supplier")
    ),
    "sink_csv_report": over_fact(TREND, DAILY),
    # projections and scalars
    "trip_time_parts": over_raw(
        """SELECT tpep_pickup_datetime, pickup_hour, pickup_dayofweek, pickup_month, pickup_date,
                  is_weekend, time_of_day, trip_duration_mins FROM derived""",
        f"derived AS ({derived('raw')})",
    ),
    "trip_labels": over_raw(
        f"""SELECT payment_type, payment_label, passenger_count, pickup_dayofweek,
                  {case_of("pickup_dayofweek", WEEKDAY_NAMES)} AS day_name,
                  {case_of("passenger_count", PASSENGER_GROUPS, PASSENGER_DEFAULT)} AS pax_group
           FROM derived""",
        f"derived AS ({derived('raw')})",
    ),
    "trip_guarded_ratios": over_raw(
        f"""SELECT fare_amount, tip_amount, trip_distance, tip_pct, revenue_per_mile,
                   {r("total_amount - fare_amount - tip_amount", 1)} AS other_amount FROM derived""",
        f"derived AS ({derived('raw')})",
    ),
    "casts_and_defaults": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               coalesce(TRY_CAST(json_extract_string(props, '$.none') AS DOUBLE), 0.0) AS absent,
               TRY_CAST(event_type AS INTEGER) AS not_a_number,
               TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts, 'events' AS origin
        FROM events""",
    # filters
    "filter_positive_distance": over_raw(f"SELECT {KEY}, trip_distance FROM raw WHERE trip_distance > 0"),
    "filter_duration_range": over_raw(
        "SELECT * FROM timed WHERE minutes > 0 AND minutes <= 360",
        f"timed AS (SELECT {KEY}, {MINUTES} AS minutes FROM raw)",
    ),
    "filter_passengers_between": over_raw(
        f"SELECT {KEY}, passenger_count FROM raw WHERE passenger_count BETWEEN 1 AND 6"
    ),
    "filter_payment_in_set": over_raw(f"SELECT {KEY}, payment_type FROM raw WHERE payment_type IN (3, 4)"),
    "filter_missing_passengers": over_raw(
        f"SELECT {KEY}, passenger_count FROM raw WHERE passenger_count IS NULL"
    ),
    # cleaning
    "clean_drop_duplicates": over_raw("SELECT DISTINCT * FROM raw"),
    "clean_drop_empty_trips": over_valid("SELECT * FROM valid"),
    "clean_limits": over_valid(f"""
        SELECT {r("repair_value", 4)} AS repair_value, {r("cap_low", 4)} AS cap_low,
               {r("cap_high", 4)} AS cap_high, round(0.0, 4) AS min_minutes,
               CAST(360.0 AS DOUBLE) AS max_minutes FROM limits"""),
    "clean_repair_negative_fares": over_valid(f"""
        SELECT {KEY}, "DOLocationID",
               {r("CASE WHEN fare_amount < 0 THEN repair_value ELSE fare_amount END", 4)} AS fare_amount
        FROM valid, limits"""),
    "clean_winsorise_totals": over_valid(f"""
        SELECT {KEY}, "DOLocationID",
               {r("least(greatest(total_amount, cap_low), cap_high)", 4)} AS total_amount
        FROM valid, limits"""),
    "clean_impute_passengers": over_raw(f"""
        SELECT {KEY}, CAST(coalesce(nullif(passenger_count, 0), 1) AS INTEGER) AS passenger_count FROM raw"""),
    "clean_flag_to_boolean": over_raw(f"""
        SELECT {KEY}, coalesce(store_and_fwd_flag = 'Y', false) AS store_and_fwd_flag FROM raw"""),
    "clean_fill_nulls": over_raw(f"""
        SELECT {KEY}, coalesce("RatecodeID", 1.0) AS "RatecodeID",
               coalesce(congestion_surcharge, 0.0) AS congestion_surcharge,
               coalesce(airport_fee, 0.0) AS airport_fee FROM raw"""),
    "clean_standard_timestamps": over_raw(f"SELECT {KEY} FROM raw"),
    "clean_trips_whole": over_fact(FACT_ROWS),
    "clean_repair_by_distance_share": over_valid(
        f"""SELECT {KEY}, "DOLocationID", trip_distance, share,
                   {r("CASE WHEN fare_amount < 0 THEN share_median ELSE fare_amount END", 4)} AS fare_amount
            FROM placed LEFT JOIN medians USING (share)""",
        """edges AS (
             SELECT quantile_cont(trip_distance, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e FROM valid
           ),
           placed AS (
             SELECT valid.*, CAST(1 + len(list_filter(e, lambda x: x < trip_distance)) AS INTEGER) AS share
             FROM valid, edges
           ),
           medians AS (
             SELECT share, quantile_cont(fare_amount, 0.5) AS share_median
             FROM placed WHERE fare_amount > 0 GROUP BY share
           )""",
    ),
    # star schema
    "star_fact_stored": over_fact(FACT_ROWS),
    "star_dim_time": over_fact(DIM_TIME),
    "star_dim_location": over_fact(DIM_LOCATION),
    "star_dim_payment": over_fact(DIM_PAYMENT),
    "star_dim_vendor": over_fact(DIM_VENDOR),
    "star_table_sizes": over_fact(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, {COUNT} AS row_count FROM {rel}" for n, (rel, _) in STORED.items()
        ),
        DIMS,
    ),
    "star_key_uniqueness": over_valid(
        " UNION ALL ".join(
            f"SELECT '{k}' AS key_kind, {COUNT} AS row_count, {COUNT} AS key_count FROM unique_rows"
            for k in ("sequence", "hash64", "hash128")
        )
    ),
    "union_all_zone_roles": over_raw(f"""
        SELECT location_id, {COUNT} AS mentions
        FROM (SELECT "PULocationID" AS location_id FROM raw UNION ALL SELECT "DOLocationID" FROM raw)
        GROUP BY location_id"""),
    "distinct_zone_pairs": over_raw('SELECT DISTINCT "PULocationID", "DOLocationID" FROM raw'),
    "star_join_orders": f"""
        SELECT r_name, c_mktsegment, {COUNT} AS order_count, {r("sum(o_totalprice)")} AS total_price
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, c_mktsegment""",
    "star_join_lineitem": f"""
        SELECT p_brand, n_name, {COUNT} AS line_count, sum(l_quantity) AS quantity
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
             LEFT JOIN nation ON s_nationkey = n_nationkey
        GROUP BY p_brand, n_name""",
    # aggregates
    "agg_row_count": over_raw(f"SELECT {COUNT} AS row_count FROM raw"),
    "agg_conditional_counts": over_raw(f"""
        SELECT "VendorID", {COUNT} AS row_count,
               CAST(sum(CASE WHEN {DISPUTED} THEN 1 ELSE 0 END) AS BIGINT) AS disputed,
               {r("avg(total_amount)")} AS avg_total, {r("sum(total_amount)")} AS total
        FROM raw GROUP BY "VendorID\""""),
    "agg_null_counts": over_raw(f"SELECT {NULL_COUNTS} FROM raw"),
    "agg_exact_quantiles": f"""
        SELECT {r(f"quantile_cont({PRICE}, 0.01)", 4)} AS price_p01,
               {r(f"quantile_cont({PRICE}, 0.25)", 4)} AS price_q1,
               {r(f"quantile_cont({PRICE}, 0.5)", 4)} AS price_median,
               {r(f"quantile_cont({PRICE}, 0.99)", 4)} AS price_p99,
               {r("quantile_cont(l_quantity, 0.5)", 4)} AS quantity_median
        FROM lineitem""",
    "agg_approx_quantiles": """
        SELECT count(*) > 0 AS p25, count(*) > 0 AS p50, count(*) > 0 AS p75 FROM lineitem""",
    # reports
    "report_hour_weekday_revenue": over_fact(
        f"""SELECT pickup_hour, pickup_dayofweek,
                   {case_of("pickup_dayofweek", WEEKDAY_NAMES)} AS day_name,
                   trip_count, {r("fare")} AS avg_fare, {r("total")} AS avg_total,
                   {r("per_mile")} AS avg_rev_per_mile,
                   CAST(rank() OVER (PARTITION BY pickup_dayofweek ORDER BY total DESC) AS INTEGER)
                     AS hour_rank
            FROM by_hour""",
        f"""by_hour AS (
              SELECT pickup_hour, pickup_dayofweek, {COUNT} AS trip_count, avg(fare_amount) AS fare,
                     avg(total_amount) AS total, avg(revenue_per_mile) AS per_mile
              FROM fact GROUP BY pickup_hour, pickup_dayofweek
            )""",
    ),
    "report_zone_demand": over_fact("SELECT * FROM ranked_zones WHERE zone_rank <= 10", ZONES),
    "report_payment_tips": over_fact(
        f"""SELECT *, {r("100.0 * trip_count / sum(trip_count) OVER ()")} AS pct_of_all_trips FROM tips""",
        TIPS,
    ),
    "report_daily_fares": over_fact(
        """SELECT *, lag(avg_fare) OVER (ORDER BY pickup_date) AS prev_day_avg_fare,
                  round(avg_fare - lag(avg_fare) OVER (ORDER BY pickup_date), 2) AS fare_change
           FROM fares""",
        DAILY_FARES,
    ),
    "report_segment_anomalies": over_fact("SELECT * FROM ranked_segments", SEGMENTS),
    "report_passenger_groups": over_fact(f"SELECT {PAX_COLUMNS} FROM pax_sums", GROUPS),
    "report_passenger_tiles": over_fact(
        f"""SELECT {PAX_COLUMNS},
                   CAST(ntile(2) OVER (ORDER BY revenue DESC, pax_group) AS INTEGER) AS revenue_tile
            FROM pax_sums""",
        GROUPS,
    ),
    "report_vendor_performance": over_fact(
        f"""SELECT "VendorID", time_of_day, trip_count, {r("fare")} AS avg_fare, {r("tip")} AS avg_tip_pct,
                   {r("minutes")} AS avg_duration, {r("100.0 * disputed / trip_count")} AS dispute_rate,
                   CAST(dense_rank() OVER (PARTITION BY time_of_day ORDER BY fare DESC) AS INTEGER)
                     AS vendor_fare_rank
            FROM vendor_sums""",
        VENDORS,
    ),
    "report_revenue_trend": over_fact(TREND, DAILY),
    "report_fare_alerts": over_fact(
        f"""SELECT pickup_date, avg_fare, {r("m", 4)} AS moving_mean, {r("sd", 4)} AS moving_sd,
                   coalesce(abs(avg_fare - m) > 2.0 * sd, false) AS alert
            FROM (SELECT pickup_date, avg_fare,
                         avg(avg_fare) OVER w AS m, stddev_samp(avg_fare) OVER w AS sd
                  FROM daily WINDOW w AS (ORDER BY pickup_date ROWS 6 PRECEDING))""",
        DAILY,
    ),
    "report_audit_segments": over_fact("SELECT * FROM ranked_segments WHERE dispute_pct > 3", SEGMENTS),
    # chart datasets
    "chart_hour_weekday_grid": over_fact(
        "SELECT pickup_hour, "
        + ", ".join(
            f'{r(f"avg(total_amount) FILTER (WHERE pickup_dayofweek = {d})")} AS "{n}"'
            for n in WEEKDAY_ORDER
            for d in [key for key, name in WEEKDAY_NAMES.items() if name == n]
        )
        + " FROM fact GROUP BY pickup_hour"
    ),
    "chart_top_zones": over_fact(f"""
        SELECT "PULocationID" AS zone_id, {COUNT} AS trip_count FROM fact
        GROUP BY zone_id ORDER BY trip_count DESC, zone_id LIMIT 10"""),
    "chart_bucket_volume": over_fact(f"""
        SELECT time_of_day, {COUNT} AS trip_count,
               list_position({TIME_ORDER}, time_of_day) AS position
        FROM fact GROUP BY time_of_day"""),
    "chart_anomaly_volume": over_fact(f"""
        SELECT time_of_day, CAST(count(*) FILTER (WHERE {DISPUTED}) AS BIGINT) AS disputed,
               CAST(count(*) FILTER (WHERE trip_distance < 0.5 AND fare_amount > 50) AS BIGINT) AS suspicious
        FROM fact GROUP BY time_of_day"""),
    "chart_fare_trend_line": over_fact(
        f"""SELECT CAST(point AS INTEGER) AS point, {r("x", 4)} AS avg_distance,
                   {r("slope * x + intercept", 4)} AS fitted_fare, {r("slope", 4)} AS slope
            FROM (SELECT p.point, slope, intercept, low + (high - low) * p.point / 49.0 AS x
                  FROM line, (SELECT unnest(range(50)) AS point) p)""",
        DAILY_FARES,
        """line AS (
             SELECT regr_slope(avg_fare, avg_distance) AS slope,
                    regr_intercept(avg_fare, avg_distance) AS intercept,
                    min(avg_distance) AS low, max(avg_distance) AS high FROM fares
           )""",
    ),
    "chart_vendor_grid": over_fact(
        f"""SELECT v."VendorID", g.time_of_day, g.position, {r("fare")} AS avg_fare, {r("tip")} AS avg_tip_pct
            FROM (SELECT DISTINCT "VendorID" FROM fact) v
            CROSS JOIN (SELECT unnest({TIME_ORDER}) AS time_of_day, unnest(range(1, 5)) AS position) g
            LEFT JOIN vendor_sums s ON s."VendorID" = v."VendorID" AND s.time_of_day = g.time_of_day""",
        VENDORS,
    ),
    "chart_payment_tips_sorted": over_fact(
        "SELECT payment_label, avg_tip_pct, avg_tip_amount FROM tips", TIPS
    ),
    # profile
    "profile_schema": over_raw(
        f"""SELECT CAST(position AS INTEGER) AS position, column_name, {TYPE_CASE} AS data_type,
                   CAST(n - nulls AS BIGINT) AS non_null, {r("100.0 * nulls / n", 1)} AS null_pct
            FROM column_nulls""",
        COLUMN_NULLS,
    ),
    "profile_schema_samples": "WITH s AS ("
    + " UNION ALL ".join(samples_of("orders", "o_orderkey", c) for c in ORDER_COLUMNS)
    + ") SELECT position, column_name, data_type, non_null, null_pct, samples FROM ("
    + " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type,
                   CAST(count({c}) AS BIGINT) AS non_null,
                   {r(f"100.0 * (count(*) - count({c})) / count(*)", 1)} AS null_pct FROM orders"""
        for i, (c, t) in enumerate(ORDER_COLUMNS.items(), start=1)
    )
    + ") JOIN s USING (column_name)",
    "profile_missing": over_raw(
        f"""SELECT column_name, CAST(nulls AS BIGINT) AS missing_count,
                   {r("100.0 * nulls / n")} AS missing_pct FROM column_nulls WHERE nulls > 0""",
        COLUMN_NULLS,
    ),
    "profile_missing_chart": over_raw(
        f"""SELECT CAST(position AS INTEGER) AS position, column_name, {r("100.0 * nulls / n")} AS missing_pct
            FROM column_nulls WHERE nulls > 0""",
        COLUMN_NULLS,
    ),
    "profile_missing_chart_none": """
        SELECT 0 AS position, '(no nulls)' AS column_name, CAST(0.0 AS DOUBLE) AS missing_pct
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE """
    + " OR ".join(f"{c} IS NULL" for c in LINEITEM_COLUMNS)
    + ")",
    "profile_numeric_summary": over_raw(" UNION ALL ".join(summary_of("raw", c) for c in NUMERIC)),
    "profile_numeric_lineitem": " UNION ALL ".join(
        summary_of("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "profile_duplicates": over_raw("""
        SELECT CAST(count(*) AS BIGINT) AS row_count,
               CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT)
                 AS duplicate_rows FROM raw"""),
    "profile_issues": over_raw(
        f"""SELECT issue, column_name, CAST(c AS BIGINT) AS issue_count,
                   {r("100.0 * c / (SELECT count(*) FROM raw)")} AS pct, CASE issue
                   {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ACTIONS.items())} END AS action
            FROM (
              SELECT 'duplicate rows' AS issue, '(entire row)' AS column_name,
                     count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS c FROM raw
              UNION ALL SELECT 'negative values', 'fare_amount', count(*) FROM raw WHERE fare_amount < 0
              UNION ALL SELECT 'non-positive values', 'trip_distance', count(*) FROM raw
                        WHERE trip_distance <= 0
              UNION ALL SELECT 'outliers', 'total_amount', count(*) FROM raw, q
                        WHERE total_amount < q1 - 1.5 * (q3 - q1) OR total_amount > q3 + 1.5 * (q3 - q1)
              UNION ALL SELECT 'missing values', 'passenger_count', count(*) FROM raw
                        WHERE passenger_count IS NULL HAVING count(*) > 0
              UNION ALL SELECT 'missing flag', 'store_and_fwd_flag', count(*) FROM raw
                        WHERE store_and_fwd_flag IS NULL
              UNION ALL SELECT 'unexpected flag values', 'store_and_fwd_flag', count(*) FROM raw
                        WHERE store_and_fwd_flag NOT IN ('Y', 'N')
            )""",
        """q AS (SELECT quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.75) AS q3
                 FROM raw)""",
    ),
    # stored sketches
    "sketch_quantiles_merged": f"""
        SELECT series, (SELECT {COUNT} FROM lineitem) AS n, share_name, true AS within_error
        FROM (VALUES ('price'), ('quantity')) s(series),
             (VALUES ('p01'), ('p25'), ('p50'), ('p75'), ('p99')) p(share_name)""",
    "sketch_quantiles_by_year": " UNION ALL ".join(
        f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, '{name}' AS series, {COUNT} AS n,
                   min(CAST({c} AS DOUBLE)) AS low, max(CAST({c} AS DOUBLE)) AS high, true AS within_error
            FROM lineitem GROUP BY 1"""
        for name, c in (("price", "l_extendedprice"), ("quantity", "l_quantity"))
    ),
    # running values and ranks over all rows
    "rows_running_values": f"""
        WITH e AS (SELECT event_id, ts, CAST(value AS DECIMAL(18,2)) AS v FROM events)
        SELECT event_id, ts, CAST({r("CAST(sum(v) OVER w AS DOUBLE)")} AS DOUBLE) AS running,
               CAST(lag(v) OVER o AS DOUBLE) AS previous, CAST(v - lag(v) OVER o AS DOUBLE) AS change,
               {r("CAST(sum(v) OVER s AS DOUBLE) / count(v) OVER s")} AS moving
        FROM e
        WINDOW o AS (ORDER BY ts, event_id),
               w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
               s AS (ORDER BY ts, event_id ROWS 6 PRECEDING)""",
    "rows_global_ranks": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, 'flag' AS ranked_by,
               rank() OVER (ORDER BY l_returnflag) AS place,
               dense_rank() OVER (ORDER BY l_returnflag) AS dense_place
        FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, 'quantity',
               rank() OVER (ORDER BY l_quantity DESC), dense_rank() OVER (ORDER BY l_quantity DESC)
        FROM lineitem""",
    "rows_global_tiles": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER o AS place,
               CAST(ntile(4) OVER o AS BIGINT) AS quartile, CAST(ntile(100) OVER o AS BIGINT) AS hundredth
        FROM lineitem WINDOW o AS (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber)""",
    "profile_histograms": over_raw(
        f"""SELECT g.column_name, CAST(g.bin AS INTEGER) AS bin, {r("low + width * g.bin", 4)} AS bin_low,
                   {r("low + width * g.bin + width", 4)} AS bin_high,
                   CAST(coalesce(c, 0) AS BIGINT) AS bin_count, {r("mean", 4)} AS mean
            FROM (SELECT *, (high - low) / 50.0 AS width, unnest(range(50)) AS bin FROM ranges) g
            LEFT JOIN (
              SELECT column_name, least(floor((v - low) / ((high - low) / 50.0)), 49) AS bin, count(*) AS c
              FROM capped JOIN ranges USING (column_name) GROUP BY 1, 2
            ) f ON f.column_name = g.column_name AND f.bin = g.bin""",
        CAPPED,
    ),
    "profile_densities": over_raw(
        f"""SELECT column_name, CAST(point AS INTEGER) AS point, {r("x", 4)} AS x,
                   {r("sum(w * exp(-0.5 * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))", 6)}
                     AS density
            FROM weighted JOIN points USING (column_name) GROUP BY column_name, point, x""",
        CAPPED,
        """weighted AS (SELECT column_name, v, count(*) AS w FROM capped GROUP BY column_name, v),
           points AS (
             SELECT column_name, point, n, sd * pow(n, -0.2) AS h, low + (high - low) * point / 199.0 AS x
             FROM (SELECT *, unnest(range(200)) AS point FROM ranges)
           )""",
    ),
    # validation
    "validate_stored_tables": over_fact(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, {COUNT} AS row_count, CAST("
            + " + ".join(f'count(*) - count("{k}")' for k in keys)
            + f""" AS BIGINT) AS null_keys,
            CASE WHEN count(*) = 0 THEN 'FAIL' WHEN """
            + " + ".join(f'count(*) - count("{k}")' for k in keys)
            + f" > 0 THEN 'WARN' ELSE 'OK' END AS status FROM {rel}"
            for n, (rel, keys) in STORED.items()
        ),
        DIMS,
    ),
    "validate_key_nulls": over_fact(
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, '{k}' AS column_name, CAST(count(*) - count(\"{k}\") AS BIGINT)"
            f" AS null_count FROM {rel}"
            for n, (rel, keys) in STORED.items()
            for k in keys
        ),
        DIMS,
    ),
    "validate_reconciliation": over_fact(f"""
        SELECT a.n AS raw_rows, b.n AS stored_rows, a.n - b.n AS removed_rows,
               {r("100.0 * (a.n - b.n) / a.n")} AS removed_pct
        FROM (SELECT {COUNT} AS n FROM raw) a, (SELECT {COUNT} AS n FROM fact) b"""),
}

ORACLE["build_counted_tables"] = ORACLE["validate_stored_tables"]
ORACLE["build_counted_steps"] = over_fact(f"""
    SELECT 'raw' AS step, {COUNT} AS step_rows FROM raw
    UNION ALL SELECT 'no_distance', {COUNT} FROM raw WHERE trip_distance IS NULL OR NOT trip_distance > 0
    UNION ALL
    SELECT 'repeated', CAST((SELECT count(*) FROM raw WHERE trip_distance > 0) - (SELECT count(*) FROM valid) AS BIGINT)
    UNION ALL
    SELECT 'implausible_duration', CAST((SELECT count(*) FROM valid) - (SELECT count(*) FROM fact) AS BIGINT)
    UNION ALL SELECT 'stored', {COUNT} FROM fact""")

ORACLE["landing_published_months"] = " UNION ALL ".join(
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               {COUNT} AS order_count, {r("sum(o_totalprice)")} AS total_price, {state} AS state
        FROM orders WHERE {part} GROUP BY ALL"""
    for state, part in ((1, "o_orderkey % 2 = 0"), (2, "true"))
)
ORACLE["star_stable_keys"] = f"""
    WITH early AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < DATE '1995-01-01'),
    late AS (SELECT l_partkey, l_suppkey FROM lineitem EXCEPT SELECT * FROM early),
    keys AS (
      SELECT *, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_key FROM early
      UNION ALL
      SELECT *, (SELECT count(*) FROM early) + row_number() OVER (ORDER BY l_partkey, l_suppkey) FROM late
    )
    SELECT CAST(pair_key AS BIGINT) AS pair_key, l_partkey, l_suppkey, {COUNT} AS line_count,
           CAST(sum(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem JOIN keys USING (l_partkey, l_suppkey) GROUP BY 1, 2, 3"""

ORACLE["star_bucketed_join"] = f"""
    SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, {COUNT} AS line_count,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
ORACLE["star_period_pruned"] = over_fact(f"""
    SELECT pickup_date, pickup_hour, {COUNT} AS trip_count FROM fact
    WHERE is_weekend AND pickup_hour < 12 AND pickup_date < DATE '2024-01-20' GROUP BY 1, 2""")
