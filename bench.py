"""Headline timings; prints one JSON line.

``BENCH_SF_DIR``  input tables (default /root/testdata/sf0.1)
``BENCH_CPUS``    local cores (default 8)

The stored fact table is built once (``build_warehouse``), then each report is run over it to
completion. A first pass over all reports warms the JVM up; the value of each query is the
better of two timed passes. ``scaled`` runs the eight reports over the same trips repeated up to
about three million, each repetition one to 33 days later, in a table partitioned by year and
month; ``scaled_pruned`` is the daily report over one month of it.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.trip_source import NUDGE, RULES, raw_trips
from tripmart.operators import profile
from tripmart.operators.validation import validate_tables
from tripmart.plans import reports, trips, warehouse
from tripmart.plans.trip_rules import DISTRIBUTION_COLUMNS
from tripmart.sources.sinks import write_table
from tripmart.sources.workspace import workspace

SCALED_ROWS = 3_018_034


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def best(build, passes: int = 2) -> float:
    """Seconds of the fastest pass, plan construction included."""
    return min(timed(lambda: run(build())) for _ in range(passes))


def scaled_fact(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """The stored trips repeated, repetition ``n`` moved by ``n % 34`` days."""
    copies = -(-SCALED_ROWS // fact.count())
    shifted = fact.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
        "pickup_date", F.col("pickup_date") + F.col("copy") % 34
    )
    dated = shifted.drop("copy").withColumns(
        {"pickup_year": F.year("pickup_date"), "pickup_month": F.month("pickup_date")}
    )
    path = write_table(dated, workspace(spark, "scaled"), ["pickup_year", "pickup_month"])
    return spark.read.parquet(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    start = time.perf_counter()
    spark = session(cpus)
    times: dict[str, float] = {"session_start": round(time.perf_counter() - start, 3)}

    raw = raw_trips(spark, sf_dir)
    built: list[warehouse.Warehouse] = []

    def build() -> None:
        built.append(warehouse.build_warehouse(spark, raw, workspace(spark, "bench"), RULES))

    cold_build = timed(build)
    times["build_warehouse"] = min(timed(build) for _ in range(2))
    fact = built[-1].table(spark, warehouse.FACT)

    for report in reports.REPORTS.values():
        run(report(fact, nudge=NUDGE))
    queries = {
        name: best(lambda r=report: r(fact, nudge=NUDGE)) for name, report in reports.REPORTS.items()
    }

    tables = {n: built[-1].table(spark, n) for n in built[-1].paths}
    times["clean_trips"] = best(lambda: trips.clean_trips(raw, RULES))
    times["validate_tables"] = best(lambda: validate_tables(tables))
    times["profile_numeric_summary"] = best(lambda: profile.numeric_summary(raw, nudge=NUDGE))
    times["profile_issues"] = best(lambda: profile.quality_issues(raw, nudge=NUDGE))
    times["profile_histograms"] = best(lambda: profile.histograms(raw, DISTRIBUTION_COLUMNS, nudge=NUDGE))
    times["profile_densities"] = best(lambda: profile.densities(raw, DISTRIBUTION_COLUMNS, nudge=NUDGE))

    large = scaled_fact(spark, fact)
    scaled = {name: best(lambda r=report: r(large, nudge=NUDGE)) for name, report in reports.REPORTS.items()}
    one_month = large.filter("pickup_year = 2024 AND pickup_month = 1")
    times["scaled_pruned"] = best(lambda: reports.daily_fares(one_month, nudge=NUDGE))

    print(
        json.dumps(
            {
                "metric": "eight_reports_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": {**queries, **times},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "fact_rows": fact.count(),
                "cold_build_warehouse": cold_build,
                "scaled": {
                    "rows": large.count(),
                    "value": round(sum(scaled.values()), 3),
                    "queries": scaled,
                },
            }
        )
    )


if __name__ == "__main__":
    main()
